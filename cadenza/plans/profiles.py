"""The whole segmenter: three profiles over smooth tracks made from the events, to ranked segments and source summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import intervals, masks, segments
from cadenza.plans._registry import query, table
from cadenza.plans.segmentation import NAMES, PROFILE_VALUES
from cadenza.storage import Scratch

#: Target frames a second of these tracks (their sources have some 70 rows), and source frames.
FPS, SOURCE_FPS = 2.5, 5.0
#: Measurements that move slowly along a track, with jumps, as expressions that Spark and SQL read alike.
TRACK = {
    "face_detected": "event_id % 83 <> 0",
    "pose_detected": "event_id % 7 <> 0",
    "center_x": "CAST(35 + abs((idx + source_id * 7) % 60 - 30) + CASE WHEN (idx + source_id * 13) % 41 > 30 THEN 15 ELSE 0 END AS DOUBLE) / 100",
    "center_y": "CAST(15 + abs((idx + source_id * 5) % 100 - 50) AS DOUBLE) / 100",
    "face_scale": "CAST(20 + abs((idx + source_id * 3) % 60 - 30) AS DOUBLE) / 160",
    "face_score": "CASE WHEN idx % 23 = 5 THEN CAST(985 AS DOUBLE) / 1000 ELSE CAST(995 AS DOUBLE) / 1000 END",
    "rigidity": "CASE WHEN event_id % 37 <> 0 THEN CAST(4 + (idx + source_id) % 8 AS DOUBLE) / 1000 END",
    "pitch": "CAST(abs((idx + source_id * 3) % 160 - 80) - 40 AS DOUBLE) / 2",
    "yaw": "CAST(abs((idx + source_id * 11) % 200 - 100) - 50 AS DOUBLE) * 3 / 4",
    "roll": "CAST(abs((idx + source_id) % 120 - 60) - 30 AS DOUBLE) / 2",
    "gaze_h": "CAST(abs((idx + source_id * 17) % 60 - 30) - 15 AS DOUBLE) / 150",
    "gaze_v": "CAST(abs((idx + source_id * 2) % 100 - 50) - 20 AS DOUBLE) / 400",
    "left_open": "CASE WHEN event_id % 43 <> 0 THEN CAST(3 + (idx + source_id) % 9 AS DOUBLE) / 12 END",
    "right_open": "CASE WHEN event_id % 47 <> 0 THEN CAST(1 AS DOUBLE) / 2 END",
}
TRACKS = f"""placed AS (SELECT user_id AS source_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, event_id FROM events),
frames AS (SELECT source_id, idx, idx * 2 AS source_frame, idx * 2 / CAST({SOURCE_FPS} AS DOUBLE) AS source_time_s, {', '.join(f"{e} AS {n}" for n, e in TRACK.items())} FROM placed)"""
_FIELDS = [f for f in masks.Profile.__dataclass_fields__]
JUDGED = f"""{TRACKS}, profiles AS (SELECT * FROM (VALUES {PROFILE_VALUES}) t({', '.join('profile' if f == 'name' else f for f in _FIELDS)})),
lengths AS (SELECT *, round_even(cut_buffer_seconds * {FPS}, 0) AS radius, round_even(fill_gap_seconds * {FPS}, 0) AS gap, round_even(min_seconds * {FPS}, 0) AS shortest, round_even(target_seconds * {FPS}, 0) AS target, round_even(max_seconds * {FPS}, 0) AS longest FROM profiles),
steps AS (SELECT *, lag(face_detected) OVER w AS was, center_x - lag(center_x) OVER w AS dx, center_y - lag(center_y) OVER w AS dy, ln(face_scale) - lag(ln(face_scale)) OVER w AS ds, pitch - lag(pitch) OVER w AS dp, yaw - lag(yaw) OVER w AS dyaw, roll - lag(roll) OVER w AS dr,
  CASE WHEN left_open IS NOT NULL AND right_open IS NOT NULL THEN least(left_open, right_open) END AS openness FROM frames WINDOW w AS (PARTITION BY source_id ORDER BY idx)),
breaks AS (SELECT *, coalesce(face_detected AND was AND (sqrt(dx * dx + dy * dy) > 0.08 OR abs(ds) > 0.25 OR abs(dp) > 15 OR abs(dyaw) > 20 OR abs(dr) > 20), FALSE) AS hard_break, quantile_cont(openness, 0.8) OVER (PARTITION BY source_id) AS reference FROM steps),
crit AS (SELECT *, face_detected AS c_face, coalesce(face_score >= min_face_score, FALSE) AS c_face_score, coalesce(rigidity <= max_rigidity, FALSE) AS c_rigidity, abs(pitch) <= max_pitch AS c_pitch, abs(yaw) <= max_yaw AS c_yaw, abs(roll) <= max_roll AS c_roll,
  abs(gaze_h) <= max_gaze_horizontal AS c_gaze_horizontal, gaze_v BETWEEN min_gaze_vertical AND max_gaze_vertical AS c_gaze_vertical,
  coalesce(openness IS NOT NULL AND (coalesce(reference, 0) <= 0 OR openness >= reference * eye_open_fraction), FALSE) AS c_eye_open, face_scale >= min_face_scale AS c_face_scale,
  center_x BETWEEN min_center_x AND max_center_x AND center_y BETWEEN min_center_y AND max_center_y AS c_framing FROM breaks CROSS JOIN lengths),
near AS (SELECT *, {' AND '.join('c_' + n for n in NAMES)} AS raw_pass, max(CASE WHEN hard_break THEN idx END) OVER (PARTITION BY profile, source_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_break,
  min(CASE WHEN hard_break THEN idx END) OVER (PARTITION BY profile, source_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_break FROM crit),
v AS (SELECT *, raw_pass AND NOT blocked AS v FROM (SELECT *, coalesce(idx - last_break <= radius, FALSE) OR coalesce(next_break - idx <= radius, FALSE) AS blocked FROM near)),
r AS (SELECT *, sum(CASE WHEN v <> was_v THEN 1 ELSE 0 END) OVER (PARTITION BY profile, source_id ORDER BY idx) AS run FROM (SELECT *, lag(v) OVER (PARTITION BY profile, source_id ORDER BY idx) AS was_v FROM v)),
g AS (SELECT *, count(*) OVER q AS len, bool_or(blocked) OVER q AS any_blocked, max(run) OVER (PARTITION BY profile, source_id) AS last_run FROM r WINDOW q AS (PARTITION BY profile, source_id, run)),
judged AS (SELECT *, (v OR (run > 0 AND run < last_run AND len <= gap AND NOT any_blocked)) AND NOT blocked AS eligible FROM g)"""
SEGMENTS = f"""{JUDGED}, runs AS (SELECT profile, source_id, min(idx) AS a, max(idx) + 1 AS b, min(shortest) AS shortest, min(target) AS target, min(longest) AS longest FROM (SELECT *, idx - row_number() OVER (PARTITION BY profile, source_id ORDER BY idx) AS k FROM judged WHERE eligible) GROUP BY profile, source_id, k),
cut AS (SELECT *, b - a AS len, CAST(least(greatest(1, round_even((b - a) / target, 0), ceil((b - a) / longest)), floor((b - a) / shortest)) AS BIGINT) AS k FROM runs WHERE b - a >= shortest),
p AS (SELECT *, unnest(generate_series(0, k - 1)) AS i FROM cut),
pieces AS (SELECT profile, source_id, shortest, CAST(a + round_even(i * len / k, 0) AS BIGINT) AS start_index, CAST(a + round_even((i + 1) * len / k, 0) AS BIGINT) AS end_index_exclusive FROM p),
tagged AS (SELECT f.*, s.start_index, s.end_index_exclusive FROM judged f JOIN pieces s ON f.profile = s.profile AND f.source_id = s.source_id AND f.idx >= s.start_index AND f.idx < s.end_index_exclusive WHERE s.end_index_exclusive - s.start_index >= s.shortest),
m AS (SELECT profile, source_id, start_index, end_index_exclusive, min(min_raw_ratio) AS least, avg(CAST(raw_pass AS INT)) AS raw_pass_ratio, avg(CAST(face_detected AS INT)) AS face_coverage, avg(CAST(pose_detected AS INT)) AS pose_coverage, avg(CAST(c_eye_open AS INT)) AS eye_open_coverage, avg(CAST(NOT blocked AS INT)) AS unblocked,
  {', '.join(f'quantile_cont({c}, 0.5) AS median_{c}' for c in ('face_scale', 'pitch', 'yaw', 'roll', 'gaze_h', 'gaze_v'))}, {', '.join(f'quantile_cont(abs({c}), 0.95) AS p95_abs_{c}' for c in ('pitch', 'yaw', 'roll'))}, quantile_cont(gaze_v, 0.05) AS p05_gaze_v, quantile_cont(gaze_v, 0.95) AS p95_gaze_v,
  (sum(greatest(0, 1 - abs(pitch) / max_pitch)) + sum(greatest(0, 1 - abs(yaw) / max_yaw)) + sum(greatest(0, 1 - abs(roll) / max_roll))) / (3 * count(*)) AS head,
  (sum(greatest(0, 1 - abs(gaze_h) / max_gaze_horizontal)) + sum(greatest(0, 1 - abs(gaze_v) / greatest(abs(min_gaze_vertical), abs(max_gaze_vertical))))) / (2 * count(*)) AS gaze,
  min(source_time_s) AS source_start_s, max(source_time_s) + 1 / CAST({SOURCE_FPS} AS DOUBLE) AS source_end_s, min(source_frame) AS source_start_frame, max(source_frame) AS source_end_frame_inclusive
  FROM tagged GROUP BY profile, source_id, start_index, end_index_exclusive),
scored AS (SELECT *, round(100.0 * (0.30 * raw_pass_ratio + 0.20 * face_coverage + 0.10 * pose_coverage + 0.20 * head + 0.15 * gaze + 0.05 * unblocked), 6) AS score,
  CASE WHEN median_face_scale IS NULL THEN 'unknown' WHEN median_face_scale >= 0.20 THEN 'close' WHEN median_face_scale >= 0.15 THEN 'medium' ELSE 'wide' END AS shot,
  start_index / CAST({FPS} AS DOUBLE) AS target_start_s, end_index_exclusive / CAST({FPS} AS DOUBLE) AS target_end_s, (end_index_exclusive - start_index) / CAST({FPS} AS DOUBLE) AS duration_s FROM m WHERE raw_pass_ratio >= least)"""
EXACT = ("profile", "source_id", "start_index", "end_index_exclusive", "source_start_frame", "source_end_frame_inclusive", "score", "shot")
ROUNDED = (
    "raw_pass_ratio", "face_coverage", "pose_coverage", "eye_open_coverage", "median_face_scale", "median_pitch", "median_yaw", "median_roll", "median_gaze_h", "median_gaze_v",
    "p95_abs_pitch", "p95_abs_yaw", "p95_abs_roll", "p05_gaze_v", "p95_gaze_v", "target_start_s", "target_end_s", "duration_s", "source_start_s", "source_end_s",
)


def _tracks(spark, sf_dir):
    place = F.expr("row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1").cast("long")
    placed = table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), place.alias("idx"), "event_id")
    own = [F.expr(e).alias(n) for n, e in TRACK.items()]
    return placed.select("source_id", "idx", (F.col("idx") * 2).alias("source_frame"), (F.col("idx") * 2 / F.lit(SOURCE_FPS)).alias("source_time_s"), *own)


def _judged(spark, sf_dir):
    return segments.judged(_tracks(spark, sf_dir), masks.profiles(spark), FPS)


@query("segments_by_profile", f"WITH {SEGMENTS} SELECT {', '.join(EXACT)}, {', '.join(f'round({c}, 6) AS {c}' for c in ROUNDED)}, row_number() OVER (PARTITION BY profile ORDER BY score DESC, source_id, target_start_s) AS rank, printf('%s_%010d_%010d', CAST(source_id AS VARCHAR), CAST(round_even(target_start_s * 1000, 0) AS BIGINT), CAST(round_even(target_end_s * 1000, 0) AS BIGINT)) AS segment_id FROM scored")
def segments_by_profile(spark, sf_dir):
    """Every profile's segments with all measures, ranked within the profile."""
    out = segments.measured(_judged(spark, sf_dir), FPS, F.lit(SOURCE_FPS)).withColumn("score", F.round("score", 6))
    out = Scratch(spark, "segments").keep(out, "segments")  # read twice for the ranks
    return intervals.ranked(out, ["profile"]).select(*EXACT, *(F.round(c, 6).alias(c) for c in ROUNDED), "rank", "segment_id")


@query("sources_by_profile", f"WITH {SEGMENTS}, s AS (SELECT profile, source_id, count(*) AS segments, CAST(sum(end_index_exclusive - start_index) AS BIGINT) AS selected_frames FROM scored GROUP BY profile, source_id), j AS (SELECT profile, source_id, count(*) AS frames, count(*) FILTER (WHERE raw_pass) AS raw_pass_frames, count(*) FILTER (WHERE eligible) AS eligible_frames, count(*) FILTER (WHERE hard_break) AS hard_breaks, round(max(reference), 6) AS eye_open_reference, {', '.join(f'count(*) FILTER (WHERE NOT c_{n}) AS rejected_{n}' for n in NAMES)} FROM judged GROUP BY profile, source_id) SELECT j.*, coalesce(segments, 0) AS segments, coalesce(selected_frames, 0) AS selected_frames FROM j LEFT JOIN s ON j.profile = s.profile AND j.source_id = s.source_id")
def sources_by_profile(spark, sf_dir):
    """What each profile found in each source, and how many frames each criterion rejects; sources without segments too."""
    key = ["profile", "source_id"]
    rows = _judged(spark, sf_dir)
    found = segments.measured(rows, FPS, F.lit(SOURCE_FPS)).groupBy(*key).agg(F.count("*").alias("segments"), F.sum(F.col("end_index_exclusive") - F.col("start_index")).alias("selected_frames"))
    rejected = [F.count_if(~F.col(f"c_{n}")).alias(f"rejected_{n}") for n in NAMES]
    whole = rows.groupBy(*key).agg(F.count("*").alias("frames"), F.count_if("raw_pass").alias("raw_pass_frames"), F.count_if("eligible").alias("eligible_frames"), F.count_if("hard_break").alias("hard_breaks"), F.round(F.max("reference"), 6).alias("eye_open_reference"), *rejected)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return whole.join(found, key, "left").select(*whole.columns, zero("segments"), zero("selected_frames"))
