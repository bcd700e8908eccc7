import math

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza import functions as own
from cadenza.operators.numbering import numbered
from cadenza.operators import catalog, geometry, intervals, learn, masks, ranking, schedule, timeline, traces


def line(spark, values, extra=None):
    rows = [("a", i, v) + ((extra[i],) if extra else ()) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, idx long, v boolean" + (", b boolean" if extra else ""))


def indices(spark, n, source, target):
    df = spark.createDataFrame([(n,)], "n long")
    return [r.source_idx for r in timeline.resample(df, "n", source, target).orderBy("target_idx").collect()]


def test_resample_100_to_24(spark):
    got = indices(spark, 1001, 100.0, 24.0)
    assert len(got) == 241 and got[:7] == [0, 4, 8, 13, 17, 21, 25] and got[-1] == 1000
    assert {b - a for a, b in zip(got, got[1:])} == {4, 5}


def test_resample_ntsc(spark):
    got = indices(spark, 301, 30000 / 1001, 24.0)
    assert len(got) == 241 and {b - a for a, b in zip(got, got[1:])} == {1, 2}


def test_resample_identity_and_upsampling(spark):
    assert indices(spark, 241, 24.0, 24.0) == list(range(241))
    with pytest.raises(ValueError):
        timeline.check_rates(23.976, 24.0)


def test_pattern():
    assert timeline.periodic_pattern(100.0, 24.0) == (25, (0, 4, 8, 13, 17, 21))
    assert timeline.periodic_pattern(30.0, 24.0) == (5, (0, 1, 3, 4))


@pytest.mark.parametrize("source,target", [(100.0, 24.0), (30000 / 1001, 24.0), (60.0, 24.0), (30.0, 24.0), (24.0, 24.0)])
def test_filter_form_selects_the_same_frames(spark, source, target):
    n = 1234
    frames = spark.range(n).where(timeline.selected(F.col("id"), F.lit(n), source, target))
    assert sorted(r.id for r in frames.collect()) == indices(spark, n, source, target)


def test_runs(spark):
    got = masks.true_runs(line(spark, [False, True, True, False, True]), "k", "v").orderBy("start_index").collect()
    assert [(r.start_index, r.end_index_exclusive) for r in got] == [(1, 3), (4, 5)]


def filled(spark, values, blocked, longest):
    df = masks.fill_gaps(line(spark, values, blocked), "k", "v", "b", longest, "o")
    return [r.o for r in df.orderBy("idx").collect()]


def test_gap_fill_and_blocker(spark):
    values = [True, True, False, False, True, True]
    assert filled(spark, values, [False] * 6, 2) == [True] * 6
    assert filled(spark, values, [False] * 3 + [True] + [False] * 2, 2) == values


def reference_fill(values, blocked, longest):
    out, i = list(values), 0
    while i < len(values):
        if values[i]:
            i += 1
            continue
        j = i
        while j < len(values) and not values[j]:
            j += 1
        if i > 0 and j < len(values) and j - i <= longest and not any(blocked[i:j]):
            out[i:j] = [True] * (j - i)
        i = j
    return [o and not b for o, b in zip(out, blocked)]


def test_gap_fill_against_a_loop(spark):
    rng = np.random.RandomState(3)
    for longest in (0, 1, 3):
        values, blocked = (rng.rand(300) < 0.6).tolist(), (rng.rand(300) < 0.1).tolist()
        assert filled(spark, values, blocked, longest) == reference_fill(values, blocked, longest)


def test_dilation_of_a_short_source_and_by_distance(spark):
    df = line(spark, [False, True, False])
    df = masks.dilate(masks.dilate(df, "k", "v", 5, "w"), "k", "v", F.lit(1), "x")
    assert [(r.w, r.x) for r in df.orderBy("idx").collect()] == [(True, True)] * 3


def test_split_tiles_runs(spark):
    runs = spark.createDataFrame([(n, 10, 10 + n) for n in [5, 200, 399, 400, 401, 1000, 1777]], "n long, start_index long, end_index_exclusive long")
    got = {}
    for r in masks.split_runs(runs, 200, 300, 400).orderBy("start_index").collect():
        got.setdefault(r.n, []).append((r.start_index, r.end_index_exclusive))
    assert 5 not in got
    for n, pieces in got.items():
        assert pieces[0][0] == 10 and pieces[-1][1] == 10 + n and all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        assert all(200 <= b - a <= 400 or n == 401 for a, b in pieces)
    with pytest.raises(ValueError):
        masks.split_runs(runs, 300, 200, 400)


def test_rows_tagged_with_pieces_equal_the_joined_form(spark):
    rng = np.random.RandomState(6)
    values = np.repeat(rng.rand(60) < 0.7, rng.randint(1, 40, 60)).tolist()
    df = line(spark, values)
    for lengths in ((4, 6, 9), (6, 10, 16), (5, 5, 5)):
        pieces = masks.split_runs(masks.true_runs(df, "k", "v"), *lengths)
        joined = intervals.tag_intervals(df, pieces, "k")
        form = lambda t: sorted(map(tuple, t.select("idx", "start_index", "end_index_exclusive").collect()))
        assert form(masks.tag_pieces(df, "k", "v", *lengths)) == form(joined)


def test_numbering_is_that_of_one_window(spark):
    rows = spark.range(1000).selectExpr("id", "id % 3 as g", "cast(pmod(id * 7919, 101) as double) as x").withColumn("x", F.when(F.col("id") % 50 != 0, F.col("x")))
    got = numbered(rows, ["g"], F.floor(F.col("x") / 10), ["x", "id"], "n")
    want = rows.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy("x", "id")))
    assert sorted(map(tuple, got.select("id", "n").collect())) == sorted(map(tuple, want.select("id", "n").collect()))


def test_threshold(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (8.0, False), (9.0, False), (float("nan"), True)], "x double, p boolean")
    row = learn.best_upper_threshold(df, "x", "p").first()
    assert (row.threshold, row.balanced_accuracy) == (5.0, 1.0)
    equal = spark.createDataFrame([(1.0, True), (1.0, False)], "x double, p boolean")
    assert learn.best_upper_threshold(equal, "x", "p").first().threshold is None


def test_threshold_against_brute_force(spark):
    rng = np.random.RandomState(1)
    x, p = rng.randint(0, 40, 300).astype(float), rng.rand(300) < 0.4
    values = np.unique(x)
    best = max((((p & (x <= t)).sum() / p.sum() + (~p & (x > t)).sum() / (~p).sum()) / 2, t) for t in (values[1:] + values[:-1]) / 2)
    row = learn.best_upper_threshold(spark.createDataFrame([(float(a), bool(b)) for a, b in zip(x, p)], "x double, p boolean"), "x", "p").first()
    assert row.threshold == best[1] and math.isclose(row.balanced_accuracy, best[0], abs_tol=1e-9)


def test_missing_values_fail_criteria_and_rolling_needs_enough(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, nan, 3.0, None, 5.0, nan, nan, nan])], "k string, idx long, v double")
    got = [r.q for r in traces.rolling_quantiles(df, "k", "v", 5, {"q": 0.5}, 3).orderBy("idx").collect()]
    assert got == [None, None, 3.0, None, None, None, None, None]
    holds = df.select(own.holds(own.finite(F.col("v")) > 0).alias("h"), own.least_known(F.col("v"), F.lit(2.0)).alias("l")).collect()
    assert [r.h for r in holds][:4] == [True, False, True, False] and holds[3].l is None


def test_functions(spark):
    row = spark.range(1).select(
        own.rational(F.lit("30000/1001")).alias("a"), own.rational(F.lit("1/0")).alias("b"), own.rational(F.lit("x")).alias("c"),
        own.clock(F.lit(3725.0)).alias("d"), own.wrap_degrees(F.lit(190.0)).alias("e"), own.half_even(F.lit(2.5)).alias("f"),
        own.cpu_list(F.lit("0-2, 5")).alias("g"), own.html_escape(F.lit("<a&b>")).alias("h"), traces.interpolated(F.array(F.lit(3.0), F.lit(1.0), F.lit(float("nan"))), 0.5).alias("i"),
    ).first()
    assert math.isclose(row.a, 30000 / 1001) and row.b == row.c == 0.0 and row.d == "1:02:05" and row.e == -170.0 and row.f == 2
    assert row.g == [0, 1, 2, 5] and row.h == "&lt;a&amp;b&gt;" and row.i == 2.0


def test_closeness_is_not_a_mean_of_means(spark):
    df = spark.createDataFrame([(0.0, None), (0.0, None), (10.0, 10.0)], "a double, b double")
    assert math.isclose(df.agg(intervals.closeness([(F.col("a"), 10), (F.col("b"), 10)]).alias("c")).first().c, 0.5)


def test_required_join_reports_missing_keys(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(1, "x")], "k long, v string")
    with pytest.raises(Exception, match="lost: 2"):
        catalog.required(a, b, "k", "lost").collect()


def test_best_two_keeps_order_on_ties(spark):
    df = spark.createDataFrame([("s", p, 1.0) for p in (270, 0, 90, 180)], "k string, p int, score double")
    row = ranking.best_two(df, "k", "score", "p").first()
    assert row.best == 0 and row.gap == 0.0


def test_review_order_puts_unknown_risk_last(spark):
    df = spark.createDataFrame([(1, None, 0.0, 1), (2, 0.5, 0.0, 2), (3, 0.9, 0.0, 3)], "pos long, risk double, distance double, rank int")
    assert [r.pos for r in ranking.review_order(df, "gaze", "pos").collect()] == [3, 2, 1]


def test_nodes_prefer_local_on_ties(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 1.0, 1.0)], "k string, local_cost double, remote_cost double")
    assert {r.k: r.node for r in schedule.assign_nodes(df, "k").collect()} == {"a": "local", "b": "remote"}
    with pytest.raises(ValueError):
        schedule.assign_lanes(df, "k", "local_cost", [0.0])


def turn(axis, degrees):
    a, (i, j), m = math.radians(degrees), [(1, 2), (2, 0), (0, 1)][axis], np.eye(3)
    m[i, i] = m[j, j] = math.cos(a)
    m[i, j], m[j, i] = -math.sin(a), math.sin(a)
    return m


def test_similarity_fit_finds_known_turns():
    rng = np.random.RandomState(5)
    source, weights = rng.randn(20, 3), rng.rand(20)
    turns = [turn(0, 20), turn(1, -35), turn(2, 10), turn(2, 15) @ turn(1, 25) @ turn(0, -30)]
    observed = np.array([1.7 * source @ r.T + 4 for r in turns])
    rotation, scale, residual = geometry.similarity_fit(source, observed, weights)
    assert np.allclose(rotation, turns) and np.allclose(scale, 1.7) and np.allclose(residual, 0, atol=1e-9)
    angles = geometry.rq_angles(rotation)
    assert np.allclose(np.abs(angles[0]), [20, 0, 0]) and np.allclose(np.abs(angles[1]), [0, 35, 0]) and np.allclose(np.abs(angles[2]), [0, 0, 10])


def common_share(a, b):
    x = max(0, min(a[1] + a[3] / 2, b[1] + b[3] / 2) - max(a[1] - a[3] / 2, b[1] - b[3] / 2))
    y = max(0, min(a[2] + a[4] / 2, b[2] + b[4] / 2) - max(a[2] - a[4] / 2, b[2] - b[4] / 2))
    return x * y / max(a[3] * a[4] + b[3] * b[4] - x * y, 1e-9)


def brute_faces(found):
    """Groups of (score, cx, cy, w, h), best first, each merged with all that are left and overlap its best."""
    left, out = sorted(found, key=lambda d: (-d[0], *d[1:])), []
    while left:
        own = [d for k, d in enumerate(left) if k == 0 or common_share(left[0], d) > 0.3]
        total = sum(d[0] for d in own)
        out.append((left[0][0], *(sum(d[c] * d[0] for d in own) / total for c in range(1, 5)), len(own)))
        left = [d for k, d in enumerate(left) if k and not common_share(left[0], d) > 0.3]
    return out


def test_suppression_against_brute_force(spark):
    rng = np.random.RandomState(9)
    rows = [(f, round(float(s), 2), *map(float, x), *map(float, w)) for f in range(30) for s, x, w in zip(rng.rand(f) + 0.05, rng.randint(0, 40, (f, 2)), rng.randint(0, 20, (f, 2)))]
    rows += [(40, 0.9, 10.0, 10.0, 10.0, 10.0), (40, 0.6, 11.0, 10.0, 10.0, 10.0), (40, 0.8, 50.0, 50.0, 10.0, 10.0), (41, 0.5, 1.0, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "f int, score double, cx double, cy double, w double, h double")
    got = {}
    for r in geometry.all_detections(df, "f").orderBy("f", "rank").collect():
        got.setdefault(r.f, []).append((r.score, r.cx, r.cy, r.w, r.h, r.members))
    for f in {r[0] for r in rows}:
        want = brute_faces([r[1:] for r in rows if r[0] == f])
        assert len(got[f]) == len(want) and np.allclose(got[f], want), f


def test_largest_face_against_brute_force(spark):
    rng = np.random.RandomState(10)
    cells = {r.anchor_id: (r.x, r.y) for r in geometry.anchors(spark).collect()}
    rows = [(f, int(a), float(rng.randn() * 3), [float(v) for v in np.concatenate([rng.randn(2) * 6, rng.rand(2) * 60 + 5, rng.randn(12) * 20])]) for f in range(12) for a in rng.choice(896, 40, False)]
    df = spark.createDataFrame(rows, "f int, anchor_id long, logit double, raw array<double>")
    got = {r.f: r for r in geometry.largest_face(df, "f", *map(F.lit, (0.2, 4.0, 28.0, 600.0, 360.0))).collect()}
    chance = lambda z: z if 0 <= z <= 1 else 1 / (1 + math.exp(-z))
    for f in range(12):
        sure = [(chance(z), *(v / 128 + cells[a][k % 2] for k, v in enumerate(raw[:2])), raw[2] / 128, raw[3] / 128, [v / 128 + cells[a][k % 2] for k, v in enumerate(raw[4:])]) for g, a, z, raw in rows if g == f and chance(z) >= 0.5]
        left, faces = sorted(sure, key=lambda d: -d[0]), []
        while left:
            own = [d for k, d in enumerate(left) if k == 0 or common_share(left[0], d) > 0.3]
            weights = np.array([d[0] for d in own])
            faces.append((np.average([d[1:5] for d in own], axis=0, weights=weights), np.average([d[5] for d in own], axis=0, weights=weights)))
            left = [d for k, d in enumerate(left) if k and not common_share(left[0], d) > 0.3]
        box, points = max(faces, key=lambda x: x[0][2] * x[0][3])
        cx, cy, w, h = (box[0] * 128 - 4) / 0.2, (box[1] * 128 - 28) / 0.2, box[2] * 640, box[3] * 640
        want = [np.clip(cx - w / 2, -150, 750), np.clip(cy - h / 2, -90, 450), np.clip(cx + w / 2, -150, 750), np.clip(cy + h / 2, -90, 450), *((v * 128 - (28 if k % 2 else 4)) / 0.2 for k, v in enumerate(points))]
        assert got[f].faces == len(faces) and np.allclose([got[f][c] for c in ("x1", "y1", "x2", "y2", *geometry.KEYPOINTS)], want)


def test_broken_indices_are_errors(spark):
    for bad in (None, -1):
        rows = spark.createDataFrame([(0,), (bad,)], "idx long")
        with pytest.raises(Exception, match="frame without index"):
            catalog.checked_indices(rows, "idx").collect()


def test_timeline_errors(spark):
    expected = spark.createDataFrame([(k, i, 2 * i) for k in "abcde" for i in range(3)], "k string, target_idx long, source_idx long")
    rows = [("a", i, 2 * i, i / 24) for i in range(3)] + [("b", i, 2 * i, i / 24) for i in range(2)] + [("c", i, 2 * i + (i == 2), i / 24) for i in range(3)]
    rows += [("d", i, 2 * i, i / 24 + 1e-4 * (i == 1)) for i in range(3)] + [("f", 0, 0, 0.0)]
    got = catalog.timeline_errors(expected, spark.createDataFrame(rows, "k string, target_idx long, frame long, time_s double"), "k", 24.0)
    assert {r.k: r.error for r in got.collect()} == {"a": None, "b": "rows", "c": "frame", "d": "time_s", "e": "rows", "f": "rows"}


def test_profiles(spark):
    rows = {r.name: r for r in masks.profiles(spark).collect()}
    assert rows["standard"].max_yaw == 40 and rows["strict"].min_raw_ratio == 0.92 and rows["loose"].min_center_x == -0.05


def test_every_order_has_a_place(spark, sf_dir):
    from cadenza import plans

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").collect()
    want = [r.o_orderkey for r in sorted(orders, key=lambda r: (-r.o_totalprice, r.o_custkey, r.o_orderkey))]
    got = [(r.place, r.o_orderkey) for r in plans.queries()["o01_multi_key_sort"](spark, sf_dir).collect()]
    assert len(want) > 500 and sorted(got) == list(enumerate(want, 1))


def test_slopes_of_the_reference_against_brute_force(spark, sf_dir):
    from cadenza import plans
    from cadenza.plans._registry import frames

    rows = frames(spark, sf_dir).select("source_id", "gaze_h", "yaw").toPandas()
    slopes = -0.008 + np.arange(1001) * ((0.002 - -0.008) / 1000)
    p95 = np.stack([np.quantile(np.abs(g.gaze_h.to_numpy()[:, None] - slopes[None, :] * g.yaw.to_numpy()[:, None]), 0.95, axis=0) for _, g in rows.groupby("source_id")])
    loss = np.round(np.median(p95, axis=0), 9)
    best = plans.queries()["a23_slope_search"](spark, sf_dir).first()
    assert (best.step, best.slope, best.loss) == (loss.argmin(), round(slopes[loss.argmin()], 6), round(loss.min(), 6))
    grid = plans.queries()["j14_slope_grid"](spark, sf_dir)
    assert grid.count() == 1001 * rows.source_id.nunique()


def test_global_quantiles_are_exact(spark, monkeypatch):
    rng = np.random.RandomState(11)
    values = np.concatenate([rng.standard_cauchy(4000), np.repeat([0.25, 0.5], 700), [np.nan, np.inf]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    want = {q: np.quantile(values[np.isfinite(values)], q) for q in (0.0, 0.2, 0.5, 0.95, 1.0)}
    for small in (20_000, 100):
        monkeypatch.setattr(intervals, "SMALL", small)
        monkeypatch.setattr(intervals, "MARGIN", 0.01)
        for q, x in want.items():
            assert math.isclose(intervals.global_quantile(df, F.col("v"), q, "m").first().m, x, rel_tol=1e-12), (small, q)
    assert intervals.global_quantile(df.limit(0), F.col("v"), 0.5, "m").first().m is None
