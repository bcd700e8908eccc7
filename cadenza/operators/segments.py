"""Segments of whole timelines by selection profile: criteria, breaks, masks, runs, pieces, measures and ranks in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.functions import half_even
from cadenza.operators import intervals, masks

#: Identity of a segment.
KEY = ["profile", "source_id", "start_index", "end_index_exclusive"]
ANGLES = ("pitch", "yaw", "roll")


def judged(frames: DataFrame, profiles: DataFrame, fps: float) -> DataFrame:
    """Every frame under every profile: c_<criterion>, raw_pass, blocked and eligible, and the profile's thresholds.

    frames: source_id, idx (from 0, without holes) and the measurements that the criteria read. Breaks and the eye
    reference don't depend on the profile, and are worked out once. All windows after them are partitioned by profile
    and source, so they share one shuffle.
    """
    rows = masks.hard_breaks(frames, "source_id").withColumn("openness", masks.eye_openness(F.col("left_open"), F.col("right_open")))
    rows = rows.withColumn("reference", F.percentile("openness", 0.8).over(W.partitionBy("source_id")))
    both = rows.crossJoin(F.broadcast(profiles.withColumnRenamed("name", "profile")))  # a few rows
    eye = masks.eye_open(F.col("openness"), F.col("reference"), F.col("eye_open_fraction"))
    both = both.withColumns({f"c_{k}": v for k, v in masks.criteria(F.col, F.col, eye).items()})
    both = both.withColumn("raw_pass", masks.all_of([F.col(c) for c in both.columns if c.startswith("c_")]))
    key = ["profile", "source_id"]
    both = masks.dilate(both, key, "hard_break", half_even(F.col("cut_buffer_seconds") * fps), "blocked")
    both = both.withColumn("free_pass", F.col("raw_pass") & ~F.col("blocked"))
    return masks.fill_gaps(both, key, "free_pass", "blocked", half_even(F.col("fill_gap_seconds") * fps), "eligible")


def measured(rows: DataFrame, fps: float, source_fps: Column) -> DataFrame:
    """One row for each segment of judged frames that keeps enough raw frames: bounds, times, coverages, medians, tails and score."""
    frames = lambda c: half_even(F.col(c) * fps)
    tagged = masks.tag_pieces(rows, ["profile", "source_id"], "eligible", frames("min_seconds"), frames("target_seconds"), frames("max_seconds"))
    c = F.col
    head = intervals.closeness([(c(a), c(f"max_{a}")) for a in ANGLES])
    gaze = intervals.closeness([(c("gaze_h"), c("max_gaze_horizontal")), (c("gaze_v"), F.greatest(F.abs("min_gaze_vertical"), F.abs("max_gaze_vertical")))])
    tails = {f"p95_abs_{a}": intervals.quantile(F.abs(a), 0.95) for a in ANGLES} | {"p05_gaze_v": intervals.quantile(c("gaze_v"), 0.05), "p95_gaze_v": intervals.quantile(c("gaze_v"), 0.95)}
    middles = {f"median_{m}": intervals.median(c(m)) for m in ("face_scale", *ANGLES, "gaze_h", "gaze_v")}
    shares = {"raw_pass_ratio": "raw_pass", "face_coverage": "face_detected", "pose_coverage": "pose_detected", "eye_open_coverage": "c_eye_open"}
    out = tagged.groupBy(*KEY).agg(
        *(intervals.ratio(c(v)).alias(k) for k, v in shares.items()), intervals.ratio(~c("blocked")).alias("unblocked"),
        *(v.alias(k) for k, v in (middles | tails).items()), head.alias("head"), gaze.alias("gaze"), F.first("min_raw_ratio").alias("least"),
        F.min_by("source_time_s", "idx").alias("source_start_s"), (F.max_by("source_time_s", "idx") + 1 / F.first(source_fps)).alias("source_end_s"),
        F.min_by("source_frame", "idx").alias("source_start_frame"), F.max_by("source_frame", "idx").alias("source_end_frame_inclusive"),
    )
    score = intervals.composite(c("raw_pass_ratio"), c("face_coverage"), c("pose_coverage"), c("head"), c("gaze"), c("unblocked"))
    seconds = lambda x: F.col(x) / F.lit(float(fps))
    out = out.where(c("raw_pass_ratio") >= c("least")).withColumns({
        "score": score, "shot": intervals.shot(c("median_face_scale")), "target_start_s": seconds("start_index"), "target_end_s": seconds("end_index_exclusive"),
        "duration_s": (c("end_index_exclusive") - c("start_index")) / F.lit(float(fps)),
    })
    return out.drop("least", "head", "gaze", "unblocked")
