"""Timelines to ranked intervals, over the events table (a user is a source, an event a frame)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.functions import holds
from cadenza.operators import intervals, masks, timeline, traces
from cadenza.operators.numbering import numbered
from cadenza.plans._registry import FRAMES, frames, query, table
from cadenza.storage import Scratch

SOURCES = "sources AS (SELECT user_id AS source_id, count(*) AS n FROM events GROUP BY user_id)"
TARGETS = "targets AS (SELECT source_id, n, unnest(generate_series(0, CAST(floor((n - 1) * 24.0 / 30.0) AS BIGINT))) AS target_idx FROM sources)"


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("source_id")).agg(F.count("*").alias("n"))


@query("w01_resample", f"WITH {SOURCES}, {TARGETS} SELECT source_id, target_idx, CAST(floor(target_idx * 30.0 / 24.0 + 0.5) AS BIGINT) AS source_idx FROM targets")
def w01(spark, sf_dir):
    return timeline.resample(_sources(spark, sf_dir), "n", 30.0, 24.0).select("source_id", "target_idx", "source_idx")


@query("j08_resampled_join", f"WITH {SOURCES}, {TARGETS}, {FRAMES} SELECT t.source_id, t.target_idx, f.event_id, round(f.value, 6) AS value FROM targets t JOIN frames f ON f.source_id = t.source_id AND f.idx = floor(t.target_idx * 30.0 / 24.0 + 0.5)")
def j08(spark, sf_dir):
    targets = timeline.resample(_sources(spark, sf_dir), "n", 30.0, 24.0)
    rows = frames(spark, sf_dir).select("source_id", F.col("idx").alias("source_idx"), "event_id", "value")
    return targets.join(rows, ["source_id", "source_idx"]).select("source_id", "target_idx", "event_id", F.round("value", 6).alias("value"))


@query("w02_periodic_pattern", "WITH r AS (SELECT * FROM (VALUES (100.0, 24.0, 25, 6), (30.0, 24.0, 5, 4), (60.0, 24.0, 5, 2), (24.0, 24.0, 1, 1)) t(source_fps, target_fps, p, q)), k AS (SELECT *, unnest(generate_series(0, q - 1)) AS i FROM r) SELECT CAST(source_fps AS DOUBLE) AS source_fps, CAST(p AS BIGINT) AS period, CAST(i AS BIGINT) AS place, CAST((2 * i * p + q) // (2 * q) AS BIGINT) AS frame_offset FROM k")
def w02(spark, sf_dir):
    rows = [(s, period, k, o) for s, t in ((100.0, 24.0), (30.0, 24.0), (60.0, 24.0), (24.0, 24.0)) for period, offsets in [timeline.periodic_pattern(s, t)] for k, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "source_fps double, period long, place long, frame_offset long")


@query("w03_select_filter", f"WITH {SOURCES}, {TARGETS}, {FRAMES} SELECT f.source_id, f.idx, f.event_id FROM frames f JOIN targets t ON f.source_id = t.source_id AND f.idx = floor(t.target_idx * 30.0 / 24.0 + 0.5)")
def w03(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumn("n", F.count("*").over(W.partitionBy("source_id")))
    return rows.where(timeline.selected(F.col("idx"), F.col("n"), 30.0, 24.0)).select("source_id", "idx", "event_id")


@query("w04_differences", f"WITH {FRAMES} SELECT source_id, idx, round(value - lag(value) OVER w, 6) AS d_value, round(yaw - lag(yaw) OVER w, 6) AS d_yaw FROM frames WINDOW w AS (PARTITION BY source_id ORDER BY idx)")
def w04(spark, sf_dir):
    return masks.differences(frames(spark, sf_dir), "source_id", ["value", "yaw"]).select("source_id", "idx", F.round("d_value", 6).alias("d_value"), F.round("d_yaw", 6).alias("d_yaw"))


BREAKS = f"""{FRAMES}, steps AS (SELECT *, lag(face_detected) OVER w AS was, center_x - lag(center_x) OVER w AS dx, center_y - lag(center_y) OVER w AS dy,
  ln(greatest(face_scale, 1e-6)) - lag(ln(greatest(face_scale, 1e-6))) OVER w AS ds, pitch - lag(pitch) OVER w AS dp, yaw - lag(yaw) OVER w AS dyaw, roll - lag(roll) OVER w AS dr
  FROM frames WINDOW w AS (PARTITION BY source_id ORDER BY idx)),
breaks AS (SELECT *, coalesce(face_detected AND was AND (sqrt(dx * dx + dy * dy) > 0.55 OR abs(ds) > 1.2 OR abs(dp) > 45 OR abs(dyaw) > 75 OR abs(dr) > 38), FALSE) AS hard_break FROM steps)"""
#: The measurements here jump at random from frame to frame, so the limits are wider than those for faces.
LIMITS = (0.55, 1.2, 45.0, 75.0, 38.0)


def _breaks(spark, sf_dir):
    return masks.hard_breaks(frames(spark, sf_dir), "source_id", limits=LIMITS)


@query("p11_hard_breaks", f"WITH {BREAKS} SELECT source_id, idx, hard_break FROM breaks")
def p11(spark, sf_dir):
    return _breaks(spark, sf_dir).select("source_id", "idx", "hard_break")


ERRORS = f"{FRAMES}, marked AS (SELECT *, event_type = 'error' AS bad FROM frames)"


@query("w05_dilation", f"WITH {ERRORS} SELECT source_id, idx, bool_or(bad) OVER (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near_bad, bool_or(bad) OVER (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near_bad_2 FROM marked")
def w05(spark, sf_dir):
    rows = masks.dilate(frames(spark, sf_dir).withColumn("bad", F.col("event_type") == "error"), "source_id", "bad", 1, "near_bad")
    return masks.dilate(rows, "source_id", "bad", F.lit(2), "near_bad_2").select("source_id", "idx", "near_bad", "near_bad_2")


FILLED = f"""{FRAMES}, v AS (SELECT source_id, idx, event_type <> 'error' AS v, event_type = 'refund' OR value > 400 AS blocked FROM frames),
r AS (SELECT *, sum(CASE WHEN v <> was THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY idx) AS run FROM (SELECT *, lag(v) OVER (PARTITION BY source_id ORDER BY idx) AS was FROM v)),
g AS (SELECT *, count(*) OVER q AS len, bool_or(blocked) OVER q AS any_blocked, max(run) OVER (PARTITION BY source_id) AS last_run FROM r WINDOW q AS (PARTITION BY source_id, run)),
filled AS (SELECT source_id, idx, (v OR (run > 0 AND run < last_run AND len <= 1 AND NOT any_blocked)) AND NOT blocked AS ok FROM g)"""


def _filled(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumn("v", F.col("event_type") != "error").withColumn("blocked", (F.col("event_type") == "refund") | (F.col("value") > 400))
    return masks.fill_gaps(rows, "source_id", "v", "blocked", 1, "ok")


@query("w06_gap_fill", f"WITH {FILLED} SELECT source_id, idx, ok FROM filled")
def w06(spark, sf_dir):
    return _filled(spark, sf_dir).select("source_id", "idx", "ok")


@query("p12_eligible", f"WITH {BREAKS} SELECT source_id, idx, face_detected AND NOT bool_or(hard_break) OVER (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS eligible FROM breaks")
def p12(spark, sf_dir):
    rows = masks.dilate(_breaks(spark, sf_dir), "source_id", "hard_break", 1, "near_break")
    return rows.select("source_id", "idx", (F.col("face_detected") & ~F.col("near_break")).alias("eligible"))


RUNS = f"{FILLED}, runs AS (SELECT source_id, min(idx) AS start_index, max(idx) + 1 AS end_index_exclusive FROM (SELECT source_id, idx, idx - row_number() OVER (PARTITION BY source_id ORDER BY idx) AS g FROM filled WHERE ok) GROUP BY source_id, g)"


@query("w07_true_runs", f"WITH {RUNS} SELECT source_id, start_index, end_index_exclusive FROM runs")
def w07(spark, sf_dir):
    return masks.true_runs(_filled(spark, sf_dir), "source_id", "ok")


PIECES = f"""{RUNS}, n AS (SELECT *, end_index_exclusive - start_index AS len FROM runs WHERE end_index_exclusive - start_index >= 4),
m AS (SELECT *, CAST(least(greatest(1, round_even(len / 6.0, 0), ceil(len / 9.0)), floor(len / 4.0)) AS BIGINT) AS k FROM n),
p AS (SELECT *, unnest(generate_series(0, k - 1)) AS i FROM m),
pieces AS (SELECT * FROM (SELECT source_id, CAST(start_index + round_even(i * len / k, 0) AS BIGINT) AS start_index, CAST(start_index + round_even((i + 1) * len / k, 0) AS BIGINT) AS end_index_exclusive FROM p) WHERE end_index_exclusive - start_index >= 4)"""


@query("w08_split_runs", f"WITH {PIECES} SELECT source_id, start_index, end_index_exclusive FROM pieces")
def w08(spark, sf_dir):
    return masks.split_runs(masks.true_runs(_filled(spark, sf_dir), "source_id", "ok"), 4, 6, 9)


@query("w09_rolling_median", f"WITH {FRAMES} SELECT source_id, idx, round(CASE WHEN count(value) OVER w >= 3 THEN quantile_cont(value, 0.5) OVER w END, 6) AS value_smooth FROM frames WINDOW w AS (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)")
def w09(spark, sf_dir):
    return traces.rolling_quantiles(frames(spark, sf_dir), "source_id", "value", 9, {"q": 0.5}, 3).select("source_id", "idx", F.round("q", 6).alias("value_smooth"))


@query("w10_rolling_envelope", f"WITH {FRAMES} SELECT source_id, idx, round(CASE WHEN count(value) OVER w >= 5 THEN quantile_cont(value, 0.1) OVER w END, 6) AS p10, round(CASE WHEN count(value) OVER w >= 5 THEN quantile_cont(value, 0.9) OVER w END, 6) AS p90 FROM frames WINDOW w AS (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)")
def w10(spark, sf_dir):
    rows = traces.rolling_quantiles(frames(spark, sf_dir), "source_id", "value", 25, {"p10": 0.1, "p90": 0.9}, 5)
    return rows.select("source_id", "idx", F.round("p10", 6).alias("p10"), F.round("p90", 6).alias("p90"))


@query("w11_interpolated_quantile", "SELECT user_id AS source_id, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.95), 6) AS q95 FROM events GROUP BY user_id")
def w11(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("source_id")).agg(F.percentile("value", 0.25).alias("q25"), F.percentile("value", 0.95).alias("q95"))
    return rows.select("source_id", F.round("q25", 6).alias("q25"), F.round("q95", 6).alias("q95"))


@query("w12_delta_traces", f"WITH {FRAMES}, d AS (SELECT source_id, idx, gaze_h - (SELECT quantile_cont(gaze_h, 0.5) FROM frames) AS delta FROM frames) SELECT source_id, idx, round(CASE WHEN count(delta) OVER s >= 3 THEN quantile_cont(delta, 0.5) OVER s END, 6) AS delta_smooth, round(CASE WHEN count(delta) OVER l >= 5 THEN quantile_cont(delta, 0.1) OVER l END, 6) AS delta_p10, round(CASE WHEN count(delta) OVER l >= 5 THEN quantile_cont(delta, 0.9) OVER l END, 6) AS delta_p90 FROM d WINDOW s AS (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING), l AS (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)")
def w12(spark, sf_dir):
    rows = frames(spark, sf_dir)
    baseline = intervals.global_quantile(rows, F.col("gaze_h"), 0.5, "base")  # one row
    rows = traces.smooth(rows.crossJoin(F.broadcast(baseline)).withColumn("delta", F.col("gaze_h") - F.col("base")), "source_id", "delta")
    return rows.select("source_id", "idx", *(F.round(c, 6).alias(c) for c in ("delta_smooth", "delta_p10", "delta_p90")))


PROFILE_VALUES = ", ".join("('" + p.name + "', " + ", ".join(f"{float(getattr(p, f))!r}" for f in masks.Profile.__dataclass_fields__ if f != "name") + ")" for p in masks.PROFILES)
CRITERIA = f"""{FRAMES}, profiles AS (SELECT * FROM (VALUES {PROFILE_VALUES}) t({', '.join('profile' if f == 'name' else f for f in masks.Profile.__dataclass_fields__)})),
opened AS (SELECT *, CASE WHEN left_open IS NOT NULL AND right_open IS NOT NULL THEN least(left_open, right_open) END AS openness FROM frames),
ref AS (SELECT *, quantile_cont(openness, 0.8) OVER (PARTITION BY source_id) AS reference FROM opened),
crit AS (SELECT source_id, profile, idx, p.min_raw_ratio, face_scale, pitch, yaw, roll, gaze_h, gaze_v, event_id,
  coalesce(face_detected, FALSE) AS c_face, coalesce(face_score >= min_face_score, FALSE) AS c_face_score, coalesce(rigidity <= max_rigidity, FALSE) AS c_rigidity,
  coalesce(abs(pitch) <= max_pitch, FALSE) AS c_pitch, coalesce(abs(yaw) <= max_yaw, FALSE) AS c_yaw, coalesce(abs(roll) <= max_roll, FALSE) AS c_roll,
  coalesce(abs(gaze_h) <= max_gaze_horizontal, FALSE) AS c_gaze_horizontal, coalesce(gaze_v BETWEEN min_gaze_vertical AND max_gaze_vertical, FALSE) AS c_gaze_vertical,
  coalesce(openness IS NOT NULL AND (coalesce(reference, 0) <= 0 OR openness >= reference * eye_open_fraction), FALSE) AS c_eye_open,
  coalesce(face_scale >= min_face_scale, FALSE) AS c_face_scale,
  coalesce(center_x BETWEEN min_center_x AND max_center_x AND center_y BETWEEN min_center_y AND max_center_y, FALSE) AS c_framing
  FROM ref CROSS JOIN profiles p)"""
NAMES = ("face", "face_score", "rigidity", "pitch", "yaw", "roll", "gaze_horizontal", "gaze_vertical", "eye_open", "face_scale", "framing")


def _criteria(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumn("openness", masks.eye_openness(F.col("left_open"), F.col("right_open")))
    rows = rows.withColumn("reference", F.percentile("openness", 0.8).over(W.partitionBy("source_id")))
    both = rows.crossJoin(F.broadcast(masks.profiles(spark).withColumnRenamed("name", "profile")))  # three rows
    eye = masks.eye_open(F.col("openness"), F.col("reference"), F.col("eye_open_fraction"))
    return both.withColumns({f"c_{k}": v for k, v in masks.criteria(F.col, F.col, eye).items()})


@query("p08_criteria", f"WITH {CRITERIA} SELECT source_id, profile, idx, {', '.join('c_' + n for n in NAMES)} FROM crit")
def p08(spark, sf_dir):
    return _criteria(spark, sf_dir).select("source_id", "profile", "idx", *(f"c_{n}" for n in NAMES))


@query("p09_raw_pass", f"WITH {CRITERIA} SELECT source_id, profile, idx FROM crit WHERE {' AND '.join('c_' + n for n in NAMES)}")
def p09(spark, sf_dir):
    return _criteria(spark, sf_dir).where(masks.all_of([F.col(f"c_{n}") for n in NAMES])).select("source_id", "profile", "idx")


@query("p10_eye_open", f"WITH {CRITERIA} SELECT source_id, idx, profile, c_eye_open FROM crit")
def p10(spark, sf_dir):
    return _criteria(spark, sf_dir).select("source_id", "idx", "profile", "c_eye_open")


@query("j12_frame_profiles", f"WITH {CRITERIA} SELECT profile, count(*) AS frames, count(*) FILTER (WHERE {' AND '.join('c_' + n for n in NAMES)}) AS passing FROM crit GROUP BY profile")
def j12(spark, sf_dir):
    return _criteria(spark, sf_dir).groupBy("profile").agg(F.count("*").alias("frames"), F.count_if(masks.all_of([F.col(f"c_{n}") for n in NAMES])).alias("passing"))


@query("a10_eye_reference", f"WITH {FRAMES} SELECT source_id, round(quantile_cont(CASE WHEN left_open IS NOT NULL AND right_open IS NOT NULL THEN least(left_open, right_open) END, 0.8), 6) AS reference FROM frames GROUP BY source_id")
def a10(spark, sf_dir):
    return frames(spark, sf_dir).groupBy("source_id").agg(F.round(F.percentile(masks.eye_openness(F.col("left_open"), F.col("right_open")), 0.8), 6).alias("reference"))


@query("a12_source_summary", f"WITH {CRITERIA} SELECT source_id, profile, count(*) AS frames, count(*) FILTER (WHERE {' AND '.join('c_' + n for n in NAMES)}) AS raw_pass_frames, {', '.join(f'count(*) FILTER (WHERE NOT c_{n}) AS rejected_{n}' for n in NAMES)} FROM crit GROUP BY source_id, profile")
def a12(spark, sf_dir):
    rejected = [F.count_if(~F.col(f"c_{n}")).alias(f"rejected_{n}") for n in NAMES]
    return _criteria(spark, sf_dir).groupBy("source_id", "profile").agg(F.count("*").alias("frames"), F.count_if(masks.all_of([F.col(f"c_{n}") for n in NAMES])).alias("raw_pass_frames"), *rejected)


# --- intervals

MEASURED = f"""{PIECES}, tagged AS (SELECT f.*, p.start_index, p.end_index_exclusive, f.value < 120 AND f.face_detected AS raw FROM frames f JOIN pieces p ON f.source_id = p.source_id AND f.idx >= p.start_index AND f.idx < p.end_index_exclusive),
measured AS (SELECT source_id, start_index, end_index_exclusive, avg(CAST(raw AS INT)) AS raw_pass_ratio, avg(CAST(face_detected AS INT)) AS face_coverage,
  quantile_cont(face_scale, 0.5) AS median_face_scale, quantile_cont(yaw, 0.5) AS median_yaw, quantile_cont(abs(pitch), 0.95) AS p95_abs_pitch, quantile_cont(gaze_v, 0.05) AS p05_gaze_vertical, quantile_cont(gaze_v, 0.95) AS p95_gaze_vertical,
  arg_min(event_id, idx) AS first_frame, arg_max(event_id, idx) AS last_frame,
  coalesce((sum(greatest(0, least(1, 1 - abs(pitch) / 24.0))) + sum(greatest(0, least(1, 1 - abs(yaw) / 40.0))) + sum(greatest(0, least(1, 1 - abs(roll) / 18.0)))) / (count(pitch) + count(yaw) + count(roll)), 0) AS head,
  coalesce((sum(greatest(0, least(1, 1 - abs(gaze_h) / 0.14))) + sum(greatest(0, least(1, 1 - abs(gaze_v) / 0.12)))) / (count(gaze_h) + count(gaze_v)), 0) AS gaze
  FROM tagged GROUP BY source_id, start_index, end_index_exclusive)"""


def _measured(spark, sf_dir):
    filled = _filled(spark, sf_dir)
    pieces = masks.split_runs(masks.true_runs(filled, "source_id", "ok"), 4, 6, 9)
    rows = intervals.tag_intervals(frames(spark, sf_dir), pieces, "source_id")
    raw = (F.col("value") < 120) & F.col("face_detected")
    head = intervals.closeness([(F.col("pitch"), 24), (F.col("yaw"), 40), (F.col("roll"), 18)])
    gaze = intervals.closeness([(F.col("gaze_h"), 0.14), (F.col("gaze_v"), 0.12)])
    return rows.groupBy("source_id", "start_index", "end_index_exclusive").agg(
        intervals.ratio(raw).alias("raw_pass_ratio"), intervals.ratio(F.col("face_detected")).alias("face_coverage"),
        intervals.median(F.col("face_scale")).alias("median_face_scale"), intervals.median(F.col("yaw")).alias("median_yaw"),
        intervals.quantile(F.abs("pitch"), 0.95).alias("p95_abs_pitch"), intervals.quantile(F.col("gaze_v"), 0.05).alias("p05_gaze_vertical"), intervals.quantile(F.col("gaze_v"), 0.95).alias("p95_gaze_vertical"),
        F.min_by("event_id", "idx").alias("first_frame"), F.max_by("event_id", "idx").alias("last_frame"), head.alias("head"), gaze.alias("gaze"),
    )


A07 = ("raw_pass_ratio", "face_coverage", "median_face_scale", "median_yaw", "p95_abs_pitch", "p05_gaze_vertical", "p95_gaze_vertical")


@query("a07_interval_measures", f"WITH {MEASURED} SELECT source_id, start_index, end_index_exclusive, first_frame, last_frame, {', '.join(f'round({c}, 6) AS {c}' for c in A07)} FROM measured")
def a07(spark, sf_dir):
    return _measured(spark, sf_dir).select("source_id", "start_index", "end_index_exclusive", "first_frame", "last_frame", *(F.round(c, 6).alias(c) for c in A07))


@query("j04_interval_join", f"WITH {MEASURED} SELECT source_id, start_index, idx, event_id FROM tagged")
def j04(spark, sf_dir):
    pieces = masks.split_runs(masks.true_runs(_filled(spark, sf_dir), "source_id", "ok"), 4, 6, 9)
    return intervals.tag_intervals(frames(spark, sf_dir), pieces, "source_id").select("source_id", "start_index", "idx", "event_id")


@query("p13_raw_ratio_filter", f"WITH {MEASURED} SELECT source_id, start_index FROM measured WHERE raw_pass_ratio >= 0.84")
def p13(spark, sf_dir):
    return _measured(spark, sf_dir).where(F.col("raw_pass_ratio") >= 0.84).select("source_id", "start_index")


SHOT = "CASE WHEN median_face_scale IS NULL THEN 'unknown' WHEN median_face_scale >= 0.20 THEN 'close' WHEN median_face_scale >= 0.15 THEN 'medium' ELSE 'wide' END"


@query("p14_shot", f"WITH {MEASURED} SELECT source_id, start_index, {SHOT} AS shot FROM measured")
def p14(spark, sf_dir):
    return _measured(spark, sf_dir).select("source_id", "start_index", intervals.shot(F.col("median_face_scale")).alias("shot"))


SCORE = "100.0 * (0.30 * raw_pass_ratio + 0.20 * face_coverage + 0.10 * 1.0 + 0.20 * head + 0.15 * gaze + 0.05 * 1.0)"
SCORED = f"{MEASURED}, scored AS (SELECT *, round({SCORE}, 6) AS score, {SHOT} AS shot, start_index / 24.0 AS target_start_s, end_index_exclusive / 24.0 AS target_end_s FROM measured)"


def _scored(spark, sf_dir):
    one = F.lit(1.0)
    score = intervals.composite(F.col("raw_pass_ratio"), F.col("face_coverage"), one, F.col("head"), F.col("gaze"), one)
    return _measured(spark, sf_dir).withColumns({"score": F.round(score, 6), "shot": intervals.shot(F.col("median_face_scale")), "target_start_s": F.col("start_index") / 24.0, "target_end_s": F.col("end_index_exclusive") / 24.0})


@query("a08_composite_score", f"WITH {SCORED} SELECT source_id, start_index, score FROM scored")
def a08(spark, sf_dir):
    return _scored(spark, sf_dir).select("source_id", "start_index", "score")


@query("a09_finite_statistics", "SELECT event_type, round(quantile_cont(CASE WHEN event_id % 7 <> 0 THEN value END, 0.5), 6) AS median_value, round(coalesce(avg(CASE WHEN event_id % 7 <> 0 THEN 1.0 ELSE 0.0 END), 0), 6) AS known FROM events GROUP BY event_type")
def a09(spark, sf_dir):
    x = F.when(F.col("event_id") % 7 != 0, F.col("value")).otherwise(F.lit(float("nan")))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(intervals.median(x), 6).alias("median_value"), F.round(intervals.ratio(F.col("event_id") % 7 != 0), 6).alias("known"))


@query("w13_segment_rank", f"WITH {SCORED} SELECT source_id, start_index, score, row_number() OVER (ORDER BY score DESC, source_id, target_start_s) AS rank, printf('%s_%010d_%010d', CAST(source_id AS VARCHAR), CAST(round_even(target_start_s * 1000, 0) AS BIGINT), CAST(round_even(target_end_s * 1000, 0) AS BIGINT)) AS segment_id FROM scored")
def w13(spark, sf_dir):
    return intervals.ranked(_scored(spark, sf_dir).withColumn("profile", F.lit("events")), ["profile"]).select("source_id", "start_index", "score", "rank", "segment_id")


@query("a13_profile_summary", f"WITH {SCORED} SELECT count(*) AS segments, CAST(sum(end_index_exclusive - start_index) AS BIGINT) AS selected_frames, round(sum(target_end_s - target_start_s), 6) AS selected_seconds, round(min(target_end_s - target_start_s), 6) AS min_s, round(quantile_cont(target_end_s - target_start_s, 0.5), 6) AS median_s, round(max(target_end_s - target_start_s), 6) AS max_s, {', '.join(f'''count(*) FILTER (WHERE shot = '{s}') AS {s}''' for s in ('close', 'medium', 'wide', 'unknown'))} FROM scored")
def a13(spark, sf_dir):
    seconds = F.col("target_end_s") - F.col("target_start_s")  # at the source's own rate
    shots = [F.count_if(F.col("shot") == s).alias(s) for s in ("close", "medium", "wide", "unknown")]
    return _scored(spark, sf_dir).agg(F.count("*").alias("segments"), F.sum(F.col("end_index_exclusive") - F.col("start_index")).alias("selected_frames"), F.round(F.sum(seconds), 6).alias("selected_seconds"), F.round(F.min(seconds), 6).alias("min_s"), F.round(F.percentile(seconds, 0.5), 6).alias("median_s"), F.round(F.max(seconds), 6).alias("max_s"), *shots)


# --- the whole: rolling median, mask, breaks, dilation, gap fill, runs, split, measures, rank

WHOLE = f"""WITH {BREAKS},
smooth AS (SELECT *, CASE WHEN count(value) OVER s >= 3 THEN quantile_cont(value, 0.5) OVER s END AS trend, bool_or(hard_break AND value > 250) OVER d AS cut FROM breaks
  WINDOW s AS (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING), d AS (PARTITION BY source_id ORDER BY idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
v AS (SELECT *, coalesce(face_detected AND trend < 90, FALSE) AND NOT cut AS v FROM smooth),
r AS (SELECT *, sum(CASE WHEN v <> was_v THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY idx) AS run FROM (SELECT *, lag(v) OVER (PARTITION BY source_id ORDER BY idx) AS was_v FROM v)),
g AS (SELECT *, count(*) OVER q AS len, bool_or(cut) OVER q AS any_cut, max(run) OVER (PARTITION BY source_id) AS last_run FROM r WINDOW q AS (PARTITION BY source_id, run)),
f AS (SELECT *, (v OR (run > 0 AND run < last_run AND len <= 1 AND NOT any_cut)) AND NOT cut AS ok FROM g),
runs AS (SELECT source_id, min(idx) AS a, max(idx) + 1 AS b FROM (SELECT source_id, idx, idx - row_number() OVER (PARTITION BY source_id ORDER BY idx) AS k FROM f WHERE ok) GROUP BY source_id, k),
n AS (SELECT *, b - a AS len FROM runs WHERE b - a >= 6),
m AS (SELECT *, CAST(least(greatest(1, round_even(len / 10.0, 0), ceil(len / 16.0)), floor(len / 6.0)) AS BIGINT) AS k FROM n),
p AS (SELECT *, unnest(generate_series(0, k - 1)) AS i FROM m),
pieces AS (SELECT source_id, CAST(a + round_even(i * len / k, 0) AS BIGINT) AS start_index, CAST(a + round_even((i + 1) * len / k, 0) AS BIGINT) AS end_index_exclusive FROM p),
t AS (SELECT s.source_id, s.start_index, s.end_index_exclusive, count(*) AS frames, round(quantile_cont(f.value, 0.5), 6) AS median_value, round(quantile_cont(f.value, 0.95), 6) AS p95_value, round(avg(CAST(f.face_detected AS INT)), 6) AS face_coverage, round(100.0 * avg(CAST(f.v AS INT)) - quantile_cont(f.value, 0.5) / 10.0, 6) AS score
  FROM pieces s JOIN f ON f.source_id = s.source_id AND f.idx >= s.start_index AND f.idx < s.end_index_exclusive WHERE s.end_index_exclusive - s.start_index >= 6 GROUP BY ALL)
SELECT *, row_number() OVER (ORDER BY score DESC, source_id, start_index) AS rank FROM t"""


@query("segmentation", WHOLE)
def segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain on one partitioning by source: one shuffle serves all windows and the aggregation of the intervals."""
    rows = traces.rolling_quantiles(_breaks(spark, sf_dir), "source_id", "value", 9, {"trend": 0.5}, 3)
    rows = rows.withColumn("jump", F.col("hard_break") & (F.col("value") > 250))
    rows = masks.dilate(rows, "source_id", "jump", 1, "cut")
    rows = rows.withColumn("v", holds(F.col("face_detected") & (F.col("trend") < 90)) & ~F.col("cut"))
    rows = masks.fill_gaps(rows, "source_id", "v", "cut", 1, "ok").select("source_id", "idx", "value", "face_detected", "v", "ok")
    of = masks.tag_pieces(rows, "source_id", "ok", 6, 10, 16).groupBy("source_id", "start_index", "end_index_exclusive")
    middle = F.percentile("value", 0.5)
    out = of.agg(F.count("*").alias("frames"), F.round(middle, 6).alias("median_value"), F.round(F.percentile("value", 0.95), 6).alias("p95_value"), F.round(intervals.ratio(F.col("face_detected")), 6).alias("face_coverage"), F.round(100.0 * intervals.ratio(F.col("v")) - middle / 10.0, 6).alias("score"))
    out = Scratch(spark, "segments").keep(out, "segments")  # read twice for the ranks
    return numbered(out, [], -F.floor("score"), [F.desc("score"), "source_id", "start_index"], "rank")
