"""Scheduling and geometry queries over suppliers, parts, line items and embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cadenza.operators import geometry, schedule
from cadenza.plans._registry import query, table

# --- schedule

ITEMS = "items AS (SELECT s_suppkey, greatest(1, CAST(round_even((s_acctbal + 1000) * 2.4, 0) AS BIGINT)) AS frames, CAST(s_nationkey * 40000000 + s_suppkey AS BIGINT) AS size FROM supplier)"
COSTS = f"{ITEMS}, costs AS (SELECT *, frames / 454.6 AS local_cost, size / (38.9 * 1048576) + frames / 614.5 AS remote_cost FROM items)"


def _items(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    return rows.select("s_suppkey", schedule.estimated_frames(F.col("s_acctbal") + 1000, F.lit(2.4), F.lit(30.0)).alias("frames"), (F.col("s_nationkey") * 40000000 + F.col("s_suppkey")).cast("long").alias("size"))


def _costs(spark, sf_dir):
    return schedule.with_costs(_items(spark, sf_dir), "frames", "size", 454.6, 614.5, 38.9)


@query("x00_cost_estimate", f"WITH {COSTS} SELECT s_suppkey, frames, round(CAST(local_cost AS DOUBLE), 6) AS local_cost, round(CAST(remote_cost AS DOUBLE), 6) AS remote_cost FROM costs")
def x00(spark, sf_dir):
    return _costs(spark, sf_dir).select("s_suppkey", "frames", F.round("local_cost", 6).alias("local_cost"), F.round("remote_cost", 6).alias("remote_cost"))


@query("x01_node_partition", f"""WITH RECURSIVE {COSTS}, o AS (SELECT *, row_number() OVER (ORDER BY greatest(CAST(local_cost AS DOUBLE), CAST(remote_cost AS DOUBLE)) DESC, s_suppkey) AS k FROM costs),
f(k, l, r, key, node) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
UNION ALL SELECT o.k, CASE WHEN f.l + o.local_cost <= f.r + o.remote_cost THEN f.l + o.local_cost ELSE f.l END, CASE WHEN f.l + o.local_cost <= f.r + o.remote_cost THEN f.r ELSE f.r + o.remote_cost END, o.s_suppkey, CASE WHEN f.l + o.local_cost <= f.r + o.remote_cost THEN 'local' ELSE 'remote' END FROM f JOIN o ON o.k = f.k + 1)
SELECT key AS s_suppkey, node, row_number() OVER (PARTITION BY node ORDER BY k) - 1 AS position FROM f WHERE k > 0""")
def x01(spark, sf_dir):
    return schedule.assign_nodes(_costs(spark, sf_dir), "s_suppkey")


def _best(n: int) -> str:
    return "CASE " + " ".join(f"WHEN f.e{i} <= least({', '.join(f'f.e{j}' for j in range(n))}) THEN {i}" for i in range(n)) + " END"


def lanes_sql(rates: tuple[float, ...]) -> str:
    n = range(len(rates))
    ends = ", ".join(f"CASE WHEN {_best(len(rates))} = {i} THEN f.e{i} + o.frames / CAST({r} AS DOUBLE) ELSE f.e{i} END" for i, r in enumerate(rates))
    return f"""WITH RECURSIVE {ITEMS}, o AS (SELECT *, row_number() OVER (ORDER BY frames DESC, s_suppkey) AS k FROM items),
f(k, key, lane, {', '.join(f'e{i}' for i in n)}) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS INT), {', '.join('CAST(0 AS DOUBLE)' for _ in n)}
UNION ALL SELECT o.k, o.s_suppkey, CAST({_best(len(rates))} AS INT), {ends} FROM f JOIN o ON o.k = f.k + 1)
SELECT key AS s_suppkey, lane, row_number() OVER (PARTITION BY lane ORDER BY k) - 1 AS position FROM f WHERE k > 0"""


@query("x02_weighted_lanes", lanes_sql((227.3, 227.3, 118.0)))
def x02(spark, sf_dir):
    return schedule.assign_lanes(_items(spark, sf_dir), "s_suppkey", "frames", [227.3, 227.3, 118.0])


@query("x03_plain_lanes", lanes_sql((1.0, 1.0)))
def x03(spark, sf_dir):
    return schedule.assign_lanes(_items(spark, sf_dir), "s_suppkey", "frames", [1.0, 1.0])


@query("w15_lane_position", lanes_sql((120.0, 78.0)))
def w15(spark, sf_dir):
    return schedule.assign_lanes(_items(spark, sf_dir), "s_suppkey", "frames", [120.0, 78.0])


@query("x04_lane_specs", "SELECT * FROM (VALUES ('local', 0, 'nvdec', 227.3), ('local', 1, 'nvdec', 227.3), ('local', 2, 'software', 118.0), ('local', 3, 'igpu', 120.0), ('remote', 0, 'nvdec', 614.5)) t(node, lane, backend, rate)".replace("227.3", "CAST(227.3 AS DOUBLE)").replace("118.0", "CAST(118.0 AS DOUBLE)").replace("120.0", "CAST(120.0 AS DOUBLE)").replace("614.5", "CAST(614.5 AS DOUBLE)"))
def x04(spark, sf_dir):
    nodes = {"local": {"fps": 454.6, "workers": 2, "software_fps": 118.0, "software_workers": 1, "igpu_fps": 120.0}, "remote": {"fps": 614.5, "workers": 1}}
    return schedule.lane_specs(spark, nodes).select("node", "lane", "backend", F.round("rate", 4).alias("rate"))


@query("x05_plan_only", f"WITH {COSTS} SELECT count(*) AS sources, CAST(sum(frames) AS BIGINT) AS frames, round(CAST(sum(local_cost) AS DOUBLE), 4) AS local_seconds FROM costs")
def x05(spark, sf_dir):
    """The plan's totals, without executing it."""
    return _costs(spark, sf_dir).agg(F.count("*").alias("sources"), F.sum("frames").alias("frames"), F.round(F.sum("local_cost"), 4).alias("local_seconds"))


# --- geometry; a vector of 64 values stands for 32 points

POINTS = "points AS (SELECT vec_id, embedding AS e FROM embeddings)"


def _xy(k: int) -> str:
    return f"{{'x': CAST(e[{2 * k + 1}] AS DOUBLE) * 100, 'y': CAST(e[{2 * k + 2}] AS DOUBLE) * 100}}"


def _points(spark, sf_dir):
    e = F.transform("embedding", lambda v: v.cast("double") * 100)
    points = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(F.get(F.col("e"), 2 * i).alias("x"), F.get(F.col("e"), 2 * i + 1).alias("y")))
    return table(spark, sf_dir, "embeddings").select("vec_id", e.alias("e")).withColumn("points", points)


def _p(k: int):
    return F.get("points", F.lit(k))


@query("a11_robust_box", "WITH v AS (SELECT vec_id, unnest(range(0, 32)) AS i, embedding FROM embeddings), q AS (SELECT vec_id, CAST(embedding[2 * i + 1] AS DOUBLE) * 100 AS x, CAST(embedding[2 * i + 2] AS DOUBLE) * 100 AS y FROM v), b AS (SELECT vec_id, quantile_cont(x, 0.02) AS x0, quantile_cont(x, 0.98) AS x1, quantile_cont(y, 0.02) AS y0, quantile_cont(y, 0.98) AS y1 FROM q GROUP BY vec_id) SELECT vec_id, round((x0 + x1) / 2, 6) AS center_x, round((y0 + y1) / 2, 6) AS center_y, round(sqrt(greatest(x1 - x0, 0) * greatest(y1 - y0, 0)), 6) AS scale FROM b")
def a11(spark, sf_dir):
    rows = _points(spark, sf_dir)
    box = geometry.robust_box(F.transform("points", lambda p: p["x"]), F.transform("points", lambda p: p["y"]))
    return rows.select("vec_id", box.alias("b")).select("vec_id", *(F.round(f"b.{c}", 6).alias(c) for c in ("center_x", "center_y", "scale")))


EYE = f"""WITH {POINTS}, p AS (SELECT vec_id, {_xy(0)} AS l, {_xy(1)} AS r, {_xy(2)} AS u, {_xy(3)} AS d, {_xy(4)} AS i FROM points),
a AS (SELECT *, sqrt((r.x - l.x) * (r.x - l.x) + (r.y - l.y) * (r.y - l.y)) AS w FROM p), b AS (SELECT *, (r.x - l.x) / w AS ux, (r.y - l.y) / w AS uy FROM a),
c AS (SELECT *, (d.x - u.x) * -uy + (d.y - u.y) * ux AS raw FROM b), s AS (SELECT *, CASE WHEN raw < 0 THEN -1 ELSE 1 END AS sg, i.x - (l.x + r.x) / 2 AS px, i.y - (l.y + r.y) / 2 AS py FROM c)
SELECT vec_id, round((px * ux + py * uy) / w, 6) AS horizontal, round((px * -uy + py * ux) * sg / w, 6) AS vertical, round(raw * sg / w, 6) AS openness FROM s WHERE w >= 2 AND raw * sg >= 0.5"""


@query("g01_normalized_eye", EYE)
def g01(spark, sf_dir):
    eye = geometry.normalized_eye(_p(0), _p(1), _p(2), _p(3), _p(4))
    return _points(spark, sf_dir).select("vec_id", eye.alias("eye")).where("eye is not null").select("vec_id", *(F.round(f"eye.{c}", 6).alias(c) for c in ("horizontal", "vertical", "openness")))


@query("g02_similarity_fit")
def g02(spark, sf_dir):
    """The first 21 points of each vector as 14 points in space, fitted to a fixed figure."""
    source = np.stack([np.cos(np.arange(14)), np.sin(np.arange(14) * 1.7), np.cos(np.arange(14) * 0.6 + 1)], axis=1)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 42), lambda v: v.cast("double")).alias("xyz"))
    fitted = geometry.head_poses(rows, "xyz", source, np.ones(14))
    return fitted.select("vec_id", *(F.round(c, 4).alias(c) for c in ("head_pitch_deg", "head_yaw_deg", "head_roll_deg", "rigidity_error")))


@query("g03_anchors", "SELECT i AS anchor_id, (CAST(c % 16 AS DOUBLE) + 0.5) / 16 AS x, (CAST(c // 16 AS DOUBLE) + 0.5) / 16 AS y FROM (SELECT i, i // 2 AS c FROM generate_series(0, 511) t(i)) UNION ALL SELECT 512 + i, (CAST(c % 8 AS DOUBLE) + 0.5) / 8, (CAST(c // 8 AS DOUBLE) + 0.5) / 8 FROM (SELECT i, i // 6 AS c FROM generate_series(0, 383) t(i))")
def g03(spark, sf_dir):
    return geometry.anchors(spark)


@query("g04_letterbox", "SELECT p_partkey, round(128.0 / greatest(w, h), 6) AS scale, floor((128 - greatest(1, round_even(w * (CAST(128 AS DOUBLE) / greatest(w, h)), 0))) / 2) AS pad_x, floor((128 - greatest(1, round_even(h * (CAST(128 AS DOUBLE) / greatest(w, h)), 0))) / 2) AS pad_y FROM (SELECT p_partkey, p_size * 16 AS w, p_size * 9 + 7 AS h FROM part)")
def g04(spark, sf_dir):
    box = geometry.letterbox(F.col("p_size") * 16, F.col("p_size") * 9 + 7, 128)
    return table(spark, sf_dir, "part").select("p_partkey", box.alias("b")).select("p_partkey", F.round("b.scale", 6).alias("scale"), "b.pad_x", "b.pad_y")


BOX = f"WITH {POINTS}, p AS (SELECT vec_id, {_xy(0)} AS a, {_xy(1)} AS b, {_xy(2)} AS k0, {_xy(3)} AS k1, {_xy(4)} AS k2, {_xy(5)} AS k3 FROM points), box AS (SELECT *, least(a.x, b.x) AS x1, least(a.y, b.y) AS y1, greatest(a.x, b.x) AS x2, greatest(a.y, b.y) AS y2 FROM p)"


def _box():
    a, b = _p(0), _p(1)
    return F.struct(F.least(a["x"], b["x"]).alias("x1"), F.least(a["y"], b["y"]).alias("y1"), F.greatest(a["x"], b["x"]).alias("x2"), F.greatest(a["y"], b["y"]).alias("y2"))


def _rounded(df, key: str, value, names):
    return df.select(key, value.alias("v")).where("v is not null").select(key, *(F.round(f"v.{n}", 6).alias(n) for n in names))


@query("g05_face_roi", f"{BOX} SELECT vec_id, round((x1 + x2) / 2, 6) AS cx, round((y1 + y2) / 2, 6) AS cy, round(1.5 * greatest(x2 - x1, y2 - y1), 6) AS side, round(degrees(atan2(k1.y - k0.y, k1.x - k0.x)), 6) AS angle FROM box")
def g05(spark, sf_dir):
    return _rounded(_points(spark, sf_dir), "vec_id", geometry.face_roi(_box(), _p(2), _p(3)), ("cx", "cy", "side", "angle"))


@query("g06_pose_roi", f"{BOX} SELECT vec_id, round((x1 + x2) / 2, 6) AS cx, round((y1 + y2) / 2 + 0.25 * greatest(60 * 0.95, (y2 - y1) * 5), 6) AS cy, round(CAST(greatest(60 * 0.95, (y2 - y1) * 5) AS DOUBLE), 6) AS side FROM box")
def g06(spark, sf_dir):
    return _rounded(_points(spark, sf_dir), "vec_id", geometry.pose_roi(_box(), F.lit(60.0), F.lit(80.0)), ("cx", "cy", "side"))


HAND = f"""{BOX}, h AS (SELECT vec_id, k0 AS elbow, k1 AS wrist, (k2.x + k3.x) / 2 - k1.x AS fx, (k2.y + k3.y) / 2 - k1.y AS fy, k1.x - k0.x AS ex, k1.y - k0.y AS ey FROM box),
d AS (SELECT *, CASE WHEN sqrt(fx * fx + fy * fy) < 4 THEN ex ELSE fx END AS dx, CASE WHEN sqrt(fx * fx + fy * fy) < 4 THEN ey ELSE fy END AS dy, greatest(sqrt(ex * ex + ey * ey) * 1.1, 12 * 0.32, 80) AS side FROM h),
n AS (SELECT *, sqrt(dx * dx + dy * dy) AS norm FROM d)
SELECT vec_id, round(wrist.x + dx / norm * side * 0.28, 6) AS cx, round(wrist.y + dy / norm * side * 0.28, 6) AS cy, round(CAST(side AS DOUBLE), 6) AS side, round(degrees(atan2(dy, dx)) + 90, 6) AS angle FROM n WHERE norm >= 4"""


@query("g07_hand_roi", HAND)
def g07(spark, sf_dir):
    sure = lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(0.9).alias("c0"), F.lit(0.5).alias("c1"))
    roi = geometry.hand_roi(sure(_p(2)), sure(_p(3)), _p(4), _p(5), F.lit(12.0))
    return _rounded(_points(spark, sf_dir), "vec_id", roi, ("cx", "cy", "side", "angle"))


@query("g08_crop_to_frame", f"WITH {POINTS}, p AS (SELECT vec_id, {_xy(0)} AS a, {_xy(1)} AS b FROM points) SELECT vec_id, round(50 + cos(radians(b.x)) * 0.5 * (a.x - 64) - sin(radians(b.x)) * 0.5 * (a.y - 64), 6) AS x, round(40 + sin(radians(b.x)) * 0.5 * (a.x - 64) + cos(radians(b.x)) * 0.5 * (a.y - 64), 6) AS y, round(b.y * 0.5, 6) AS z FROM p")
def g08(spark, sf_dir):
    roi = F.struct(F.lit(50.0).alias("cx"), F.lit(40.0).alias("cy"), F.lit(64.0).alias("side"), _p(1)["x"].alias("angle"))
    return _rounded(_points(spark, sf_dir), "vec_id", geometry.from_crop(_p(0)["x"], _p(0)["y"], _p(1)["y"], roi, 128), ("x", "y", "z"))


# --- detections: the line items of an order are the candidates of a frame

DETECTIONS = "det AS (SELECT l_orderkey AS frame_id, CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey AS detection_id, l_discount * 8 + 0.2 AS score, CAST(l_quantity AS DOUBLE) AS cx, 25 + l_tax * 100 AS cy, CAST(30 AS DOUBLE) AS w, 20 + l_tax * 50 AS h FROM lineitem)"


def _detections(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(F.col("l_orderkey").alias("frame_id"), (F.col("l_linenumber").cast("long") * 1000000 + F.col("l_partkey")).alias("detection_id"), (F.col("l_discount") * 8 + 0.2).alias("score"), F.col("l_quantity").alias("cx"), (F.lit(25.0) + F.col("l_tax") * 100).alias("cy"), F.lit(30.0).alias("w"), (F.lit(20.0) + F.col("l_tax") * 50).alias("h"))


PRIMARY = f"""WITH {DETECTIONS}, sure AS (SELECT * FROM det WHERE score >= 0.5), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY score DESC, detection_id) AS k FROM sure) WHERE k = 1),
o AS (SELECT s.*, greatest(0, least(s.cx + s.w / 2, b.cx + b.w / 2) - greatest(s.cx - s.w / 2, b.cx - b.w / 2)) * greatest(0, least(s.cy + s.h / 2, b.cy + b.h / 2) - greatest(s.cy - s.h / 2, b.cy - b.h / 2)) AS common, s.w * s.h + b.w * b.h AS areas FROM sure s JOIN best b USING (frame_id)),
near AS (SELECT * FROM o WHERE common / greatest(areas - common, 1e-9) > 0.3)"""


@query("a31_primary_detection", f"{PRIMARY} SELECT frame_id, round(sum(cx * score) / sum(score), 6) AS cx, round(sum(cy * score) / sum(score), 6) AS cy, count(*) AS members FROM near GROUP BY frame_id")
def a31(spark, sf_dir):
    return geometry.primary_detection(_detections(spark, sf_dir), "frame_id").select("frame_id", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"), "members")


@query("j15_overlap_join", f"{PRIMARY} SELECT frame_id, detection_id FROM near")
def j15(spark, sf_dir):
    rows = _detections(spark, sf_dir).where("score >= 0.5")
    box = F.struct("cx", "cy", "w", "h")
    best = rows.groupBy("frame_id").agg(F.max_by(box, F.struct("score", -F.col("detection_id"))).alias("best"))
    return rows.join(best, "frame_id").where(geometry.overlap(box, F.col("best")) > 0.3).select("frame_id", "detection_id")


@query("a30_all_detections")
def a30(spark, sf_dir):
    found = geometry.all_detections(_detections(spark, sf_dir).where("score >= 0.5"), "frame_id")
    return found.select("frame_id", "rank", *(F.round(c, 4).alias(c) for c in ("score", "cx", "cy", "w", "h")))


# eight vectors are a frame, and each gives four candidates around one of 64 cells: sixteen numbers, the last also as the logit
HEADS = "heads AS (SELECT vec_id // 8 AS frame_id, 512 + (vec_id * 4 + j) % 6 + 6 * (vec_id // 8 % 64) AS anchor_id, vec_id, j, CAST(embedding[16 * j + 16] AS DOUBLE) * 20 AS logit, [CAST(embedding[16 * j + k + 1] AS DOUBLE) * 64 + CASE WHEN k IN (2, 3) THEN 40 ELSE 0 END for k in range(0, 16)] AS raw FROM embeddings, generate_series(0, 3) t(j))"
ANCHOR_SQL = "anchors AS (SELECT 512 + i AS anchor_id, (CAST(c % 8 AS DOUBLE) + 0.5) / 8 AS x, (CAST(c // 8 AS DOUBLE) + 0.5) / 8 AS y FROM (SELECT i, i // 6 AS c FROM generate_series(0, 383) t(i)))"
FACE = f"""WITH {HEADS}, {ANCHOR_SQL}, det AS (SELECT frame_id, vec_id * 4 + j AS detection_id, CASE WHEN logit BETWEEN 0 AND 1 THEN logit ELSE 1 / (1 + exp(-logit)) END AS score, raw[1] / 128 + x AS cx, raw[2] / 128 + y AS cy, raw[3] / 128 AS w, raw[4] / 128 AS h,
  {', '.join(f"raw[{5 + k}] / 128 + {'xy'[k % 2]} AS {n}" for k, n in enumerate(geometry.KEYPOINTS))} FROM heads JOIN anchors USING (anchor_id)),
sure AS (SELECT * FROM det WHERE score >= 0.5), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY score DESC, detection_id) AS k FROM sure) WHERE k = 1),
o AS (SELECT s.*, greatest(0, least(s.cx + s.w / 2, b.cx + b.w / 2) - greatest(s.cx - s.w / 2, b.cx - b.w / 2)) * greatest(0, least(s.cy + s.h / 2, b.cy + b.h / 2) - greatest(s.cy - s.h / 2, b.cy - b.h / 2)) AS common, s.w * s.h + b.w * b.h AS areas FROM sure s JOIN best b USING (frame_id)),
m AS (SELECT frame_id, count(*) AS members, {', '.join(f'sum({c} * score) / sum(score) AS {c}' for c in ('cx', 'cy', 'w', 'h', *geometry.KEYPOINTS))} FROM o WHERE common / greatest(areas - common, 1e-9) > 0.3 GROUP BY frame_id)
SELECT frame_id, members, {', '.join(f"round(greatest({-0.25 * e}, least({1.25 * e}, (c{a} * 128 - {p}) / 0.2 {s} {d} * 128 / 0.2 / 2)), 4) AS {a}{i}" for i, s in ((1, '-'), (2, '+')) for a, d, p, e in (('x', 'w', 0, 640), ('y', 'h', 28, 360)))},
  {', '.join(f"round(({n} * 128 - {28 if n[1] == 'y' else 0}) / 0.2, 4) AS {n}" for n in geometry.KEYPOINTS)} FROM m"""
FITTED = (0.2, 0.0, 28.0, 640.0, 360.0)  # scale, pads, width and height of a frame of 640 x 360 in the square of 128


def _heads(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"), F.explode(F.array(*map(F.lit, range(4)))).alias("j"))
    raw = F.transform(F.slice("e", F.col("j") * 16 + 1, F.lit(16)), lambda v, k: v * 64 + F.when(k.isin(2, 3), 40.0).otherwise(0.0))
    cell, own = F.floor(F.col("vec_id") / 8), F.col("vec_id") * 4 + F.col("j")
    return rows.select(cell.alias("frame_id"), own.alias("own"), (512 + own % 6 + 6 * (cell % 64)).alias("anchor_id"), (F.get("e", F.col("j") * 16 + 15) * 20).alias("logit"), raw.alias("raw"))


@query("g09_detection_decode", FACE)
def g09(spark, sf_dir):
    """Heads to the primary face of each frame: scores, boxes and six keypoints from anchors, blended around the best, in pixels."""
    heads = _heads(spark, sf_dir)
    # a detector has one candidate for each anchor; here several vectors share one, so candidates are told apart by their own number
    rows = geometry.face_candidates(heads.withColumnRenamed("frame_id", "f").withColumn("frame_id", F.struct("f", "own")), "frame_id")
    rows = rows.withColumn("detection_id", F.col("frame_id.own")).withColumn("frame_id", F.col("frame_id.f"))
    found = geometry.primary_detection(rows, "frame_id", values=(*geometry.BOX, *geometry.KEYPOINTS))
    names = ("x1", "y1", "x2", "y2", *geometry.KEYPOINTS)
    return geometry.in_frame(found, "frame_id", *map(F.lit, FITTED)).select("frame_id", "members", *(F.round(c, 4).alias(c) for c in names))


@query("g09_largest_face")
def g09_largest(spark, sf_dir):
    """The same heads with every face kept apart, and the largest of them."""
    found = geometry.largest_face(_heads(spark, sf_dir), "frame_id", *map(F.lit, FITTED))
    return found.select("frame_id", "faces", *(F.round(c, 4).alias(c) for c in ("score", "x1", "y1", "x2", "y2", "kx0", "ky0", "kx5", "ky5")))


def _channel(expr: str) -> str:
    return f"CAST(greatest(0, least(255, floor({expr}))) AS INT)"


@query("g10_yuv_to_rgb", f"WITH s AS (SELECT p_partkey, CAST(p_size * 5 % 256 AS DOUBLE) AS y, CAST(p_partkey * 7 % 256 AS DOUBLE) AS u, CAST(p_partkey * 13 % 256 AS DOUBLE) AS v FROM part) SELECT p_partkey, {_channel('(y - 16) * CAST(1.164383 AS DOUBLE) + (v - 128) * CAST(1.792741 AS DOUBLE)')} AS r, {_channel('(y - 16) * CAST(1.164383 AS DOUBLE) - (u - 128) * CAST(0.213249 AS DOUBLE) - (v - 128) * CAST(0.532909 AS DOUBLE)')} AS g, {_channel('(y - 16) * CAST(1.164383 AS DOUBLE) + (u - 128) * CAST(2.112402 AS DOUBLE)')} AS b FROM s")
def g10(spark, sf_dir):
    d = lambda e: e.cast("double")
    rgb = geometry.rgb_of_yuv(d(F.col("p_size") * 5 % 256), d(F.col("p_partkey") * 7 % 256), d(F.col("p_partkey") * 13 % 256))
    return table(spark, sf_dir, "part").select("p_partkey", rgb.alias("c")).select("p_partkey", "c.r", "c.g", "c.b")


@query("g11_rotation", "SELECT p_partkey, r AS turn, CAST(CASE r WHEN 0 THEN p_size WHEN 90 THEN 99 - p_size // 2 WHEN 180 THEN 199 - p_size ELSE p_size // 2 END AS INT) AS x, CAST(CASE r WHEN 0 THEN p_size // 2 WHEN 90 THEN p_size WHEN 180 THEN 99 - p_size // 2 ELSE 199 - p_size END AS INT) AS y FROM part, (VALUES (0), (90), (180), (270)) t(r)")
def g11(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("px"), F.floor(F.col("p_size") / 2).cast("int").alias("py"), F.explode(F.array(*map(F.lit, (0, 90, 180, 270)))).alias("turn"))
    return rows.select("p_partkey", "turn", geometry.rotated(F.col("px"), F.col("py"), F.lit(200), F.lit(100), F.col("turn")).alias("p")).select("p_partkey", "turn", "p.x", "p.y")


@query("g12_network_points", "SELECT vec_id, k, round(CAST(embedding[k * 5 + 1] AS DOUBLE), 6) AS x, round(CASE WHEN v BETWEEN 0 AND 1 THEN v ELSE 1 / (1 + exp(-v)) END, 6) AS c FROM (SELECT vec_id, k, embedding, CAST(embedding[k * 5 + 4] AS DOUBLE) AS v FROM embeddings, generate_series(0, 11) t(k))")
def g12(spark, sf_dir):
    points = geometry.network_points(F.transform("embedding", lambda v: v.cast("double")), 5, 12)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(points).alias("k", "p"))
    return rows.select("vec_id", F.col("k").cast("long").alias("k"), F.round(F.get("p", F.lit(0)), 6).alias("x"), F.round(F.get("p", F.lit(3)), 6).alias("c"))
