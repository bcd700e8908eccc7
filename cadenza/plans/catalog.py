"""Inventory, catalog, deduplication, join and summary queries over orders, documents and the dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.functions import probability, rational
from cadenza.operators import catalog, intervals, ranking, timeline
from cadenza.operators.numbering import numbered
from cadenza.plans._registry import FRAMES, frames, query, table
from cadenza.sources import columns, manifests
from cadenza.storage import Scratch

# --- snapshots, reuse, projections


@query("s02_stable_snapshots", "SELECT a.o_orderkey, coalesce(b.o_totalprice = CASE WHEN a.o_orderpriority = '1-URGENT' THEN a.o_totalprice + 1 ELSE a.o_totalprice END, FALSE) AS stable FROM orders a LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'O') b USING (o_orderkey)")
def s02(spark, sf_dir):
    """Before: the orders that are not open; after: all, with urgent ones changed since."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    after = orders.withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return catalog.stable(after, orders.where("o_orderstatus <> 'O'"), "o_orderkey", ["o_totalprice"]).select("o_orderkey", "stable")


@query("s03_edge_digest")
def s03(spark, sf_dir):
    from cadenza.sources.files import edge_digest

    return table(spark, sf_dir, "documents").select("doc_id", edge_digest(F.col("text").cast("binary")).alias("digest"))


@query("s04_probe_projection", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.missing') AS VARCHAR) AS missing, coalesce(nullif('', ''), '30000/1001') AS rate FROM events")
def s04(spark, sf_dir):
    parsed = F.from_json("props", "k long, missing string")
    rate = F.coalesce(F.nullif(F.lit(""), F.lit("")), F.lit("30000/1001"))
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("p"), rate.alias("rate")).select("event_id", "p.k", "p.missing", "rate")


PREVIOUS = "prev AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus AS cached FROM orders WHERE o_orderstatus <> 'O')"


def _scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    old = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    previous = orders.where("o_orderstatus <> 'O'").select("o_orderkey", old.alias("o_totalprice"), F.col("o_orderstatus").alias("cached"), F.lit(True).alias("probe_ok"))
    return catalog.reusable(orders.select("o_orderkey", "o_totalprice"), previous, ["o_orderkey", "o_totalprice"], ["cached"], "probe_ok")


@query("s05_cached_reuse", f"WITH {PREVIOUS} SELECT o.o_orderkey, p.cached, p.cached IS NULL AS to_probe FROM orders o LEFT JOIN prev p ON o.o_orderkey = p.o_orderkey AND o.o_totalprice = p.o_totalprice")
def s05(spark, sf_dir):
    reused, new = _scan(spark, sf_dir)
    return reused.select("o_orderkey", "cached", F.lit(False).alias("to_probe")).unionByName(new.select("o_orderkey", F.lit(None).cast("string").alias("cached"), F.lit(True).alias("to_probe")))


@query("s06_manifest", "SELECT event_id, item AS value FROM (SELECT event_id, unnest([CAST(json_extract_string(props, '$.k') AS BIGINT), CAST(json_extract_string(props, '$.k') AS BIGINT) + 1]) AS item FROM events)")
def s06(spark, sf_dir):
    """A document {"items": [...]} in a column, parsed by a schema and unnested."""
    k = F.get_json_object("props", "$.k")
    document = F.concat(F.lit('{"items":['), k, F.lit(","), (k.cast("long") + 1).cast("string"), F.lit("]}"))
    return table(spark, sf_dir, "events").select("event_id", F.explode(F.from_json(document, "items array<long>")["items"]).alias("value"))


@query("s08_cache_rows", f"WITH {FRAMES} SELECT source_id, idx, coalesce(face_detected, FALSE) AS face_detected, CAST(coalesce(CASE WHEN face_detected THEN 1 END, 0) AS INT) AS face_candidates, round(left_open, 6) AS left_open, round(gaze_h - 0.01, 6) AS delta_horizontal FROM frames")
def s08(spark, sf_dir):
    rows = frames(spark, sf_dir)
    return rows.select("source_id", "idx", F.coalesce("face_detected", F.lit(False)).alias("face_detected"), F.coalesce(F.when(F.col("face_detected"), 1), F.lit(0)).alias("face_candidates"), F.round("left_open", 6).alias("left_open"), F.round(F.col("gaze_h") - 0.01, 6).alias("delta_horizontal"))


@query("s15_frame_count", "SELECT p_partkey, coalesce(TRY_CAST(CASE WHEN p_type = 'ECONOMY' THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS BIGINT), CAST(round_even(p_retailprice * 0.25, 0) AS BIGINT)) AS frames FROM part")
def s15(spark, sf_dir):
    stated = F.when(F.col("p_type") == "ECONOMY", F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", catalog.frame_count(stated, F.col("p_retailprice"), F.lit(0.25)).alias("frames"))


@query("p01_eligible_files", "SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.quality = 1, TRUE) AND coalesce(l.toxic = 0, TRUE)")
def p01(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.where(F.coalesce(F.col("quality") == 1, F.lit(True)) & F.coalesce(F.col("toxic") == 0, F.lit(True))).select("doc_id")


@query("p02_catalog_filter", "SELECT d.doc_id FROM documents d JOIN labels l USING (doc_id) WHERE coalesce(l.quality = 1, FALSE) AND coalesce(l.toxic = 0, FALSE)")
def p02(spark, sf_dir):
    """Unlike p01 a missing state fails; a kept row without content is an error."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").where(F.coalesce(F.col("quality") == 1, F.lit(False)) & F.coalesce(F.col("toxic") == 0, F.lit(False)))
    return rows.where(F.when(F.col("text").isNull(), F.raise_error(F.lit("no content"))).otherwise(F.lit(True))).select("doc_id")


@query("p03_split_limit", "SELECT event_id, round(value, 6) AS value FROM events WHERE event_type = 'purchase' ORDER BY event_id LIMIT 100")
def p03(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").orderBy("event_id").limit(100).select("event_id", F.round("value", 6).alias("value"))


ROTATED = "SELECT p_partkey, CAST(CASE WHEN p_brand LIKE '%1' THEN 90 WHEN p_brand LIKE '%2' THEN 180 WHEN p_brand LIKE '%3' THEN 270 ELSE 0 END AS INT) AS rotation, p_size * 10 AS width, p_size * 6 AS height, CASE WHEN p_type = 'ECONOMY' THEN '30000/1001' WHEN p_type = 'PROMO' THEN 'x/0' ELSE CAST(p_size AS VARCHAR) END AS rate FROM part"


def _rotated(spark, sf_dir):
    rotation = F.when(F.col("p_brand").endswith("1"), 90).when(F.col("p_brand").endswith("2"), 180).when(F.col("p_brand").endswith("3"), 270).otherwise(0)
    rate = F.when(F.col("p_type") == "ECONOMY", "30000/1001").when(F.col("p_type") == "PROMO", "x/0").otherwise(F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", rotation.alias("rotation"), (F.col("p_size") * 10).alias("width"), (F.col("p_size") * 6).alias("height"), rate.alias("rate"))


@query("p04_catalog_projection", f"SELECT p_partkey, CASE WHEN rotation IN (90, 270) THEN height ELSE width END AS inference_width, CASE WHEN rotation IN (90, 270) THEN width ELSE height END AS inference_height, round(CASE rate WHEN '30000/1001' THEN 30000 / 1001 WHEN 'x/0' THEN 0.0 ELSE CAST(TRY_CAST(rate AS BIGINT) AS DOUBLE) END, 6) AS fps FROM ({ROTATED})")
def p04(spark, sf_dir):
    w, h = catalog.oriented_size(F.col("rotation"), F.col("width"), F.col("height"))
    return _rotated(spark, sf_dir).select("p_partkey", w.alias("inference_width"), h.alias("inference_height"), F.round(rational(F.col("rate")), 6).alias("fps"))


@query("p05_signature", "SELECT doc_id, sha256(source || chr(0) || CAST(n_chars AS VARCHAR) || chr(0) || coalesce(lang, '') || chr(0) || '90') AS signature FROM documents")
def p05(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", catalog.signature(F.col("source"), F.col("n_chars"), F.col("lang"), F.lit(90)).alias("signature"))


@query("p06_baseline_deltas", f"WITH {FRAMES}, b AS (SELECT quantile_cont(gaze_h, 0.5) AS gaze_h, quantile_cont(gaze_v, 0.5) AS gaze_v, quantile_cont(pitch, 0.5) AS pitch FROM frames) SELECT event_id, round(CASE WHEN f.left_open IS NOT NULL THEN f.gaze_h - b.gaze_h END, 6) AS delta_horizontal, round(CASE WHEN f.left_open IS NOT NULL THEN f.gaze_v - b.gaze_v END, 6) AS delta_vertical, round(f.pitch - b.pitch, 6) AS delta_pitch FROM frames f, b")
def p06(spark, sf_dir):
    rows = frames(spark, sf_dir)
    base = intervals.global_quantiles(rows, {f"base_{c}": (F.col(c), 0.5) for c in ("gaze_h", "gaze_v", "pitch")})  # one row
    both = rows.crossJoin(F.broadcast(base))
    eye = lambda c: F.round(F.when(F.col("left_open").isNotNull(), F.col(c) - F.col(f"base_{c}")), 6)
    return both.select("event_id", eye("gaze_h").alias("delta_horizontal"), eye("gaze_v").alias("delta_vertical"), F.round(F.col("pitch") - F.col("base_pitch"), 6).alias("delta_pitch"))


@query("p07_binocular", f"WITH {FRAMES} SELECT event_id, round((left_open + right_open) / 2, 6) AS openness FROM frames")
def p07(spark, sf_dir):
    return frames(spark, sf_dir).select("event_id", F.round((F.col("left_open") + F.col("right_open")) / 2, 6).alias("openness"))


@query("p15_orientation_score", f"WITH {FRAMES} SELECT event_id, round(4.0 * face_score + 1.5 * rigidity + greatest(0, 1 - abs(((yaw * 4 + 180) % 360 + 360) % 360 - 180) / 45) + greatest(0, gaze_v) - CASE WHEN face_detected THEN 0 ELSE 2 END - CASE WHEN value > 20 THEN 0 ELSE 0.5 END, 6) AS score FROM frames")
def p15(spark, sf_dir):
    c = F.col
    return frames(spark, sf_dir).select("event_id", F.round(ranking.orientation_score(c("face_score"), c("rigidity"), c("yaw") * 4, c("gaze_v"), c("face_detected"), c("value") > 20), 6).alias("score"))


@query("p21_probability_clamp", "SELECT event_id, round(CASE WHEN x BETWEEN 0 AND 1 THEN x ELSE 1 / (1 + exp(-greatest(least(x, 80), -80))) END, 6) AS p FROM (SELECT event_id, (value - 30) / 10 AS x FROM events)")
def p21(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(probability((F.col("value") - 30) / 10), 6).alias("p"))


@query("p22_geometry_dispatch", f"SELECT p_partkey, coalesce(engine, 'fallback') AS engine FROM ({ROTATED}) r LEFT JOIN (VALUES (100, 60, 'small'), (300, 180, 'large')) e(w, h, engine) ON r.width = e.w AND r.height = e.h")
def p22(spark, sf_dir):
    engines = spark.createDataFrame([(100, 60, "small"), (300, 180, "large")], "width int, height int, engine string")
    return _rotated(spark, sf_dir).join(F.broadcast(engines), ["width", "height"], "left").select("p_partkey", F.coalesce("engine", F.lit("fallback")).alias("engine"))


# --- joins


@query("j01_required_join", "SELECT o.o_orderkey, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
def j01(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return catalog.required(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), customers, "o_custkey", "no such customer").select("o_orderkey", "c_mktsegment")


@query("j02_optional_labels", "SELECT d.doc_id, l.quality, l.doc_id IS NOT NULL AS labelled FROM documents d LEFT JOIN labels l USING (doc_id)")
def j02(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(True).alias("labelled"))
    return table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").select("doc_id", "quality", F.coalesce("labelled", F.lit(False)).alias("labelled"))


@query("j03_absent_ids", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j03(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("j05_catalog_join", "SELECT s.s_suppkey, n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE s.s_acctbal < 0")
def j05(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return table(spark, sf_dir, "supplier").where("s_acctbal < 0").join(nations, "s_nationkey").select("s_suppkey", "n_name")


DONE = "done AS (SELECT l_orderkey, CASE WHEN max(l_linenumber) > 3 THEN 'P' ELSE 'F' END AS signature, CAST(CASE WHEN sum(l_quantity) > 60 THEN 24 ELSE 30 END AS DOUBLE) AS fps, min(l_discount) < 0.03 AS complete FROM lineitem GROUP BY l_orderkey)"


def _results(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    return rows.agg(F.when(F.max("l_linenumber") > 3, "P").otherwise("F").alias("o_orderstatus"), F.when(F.sum("l_quantity") > 60, 24.0).otherwise(30.0).alias("fps"), (F.min("l_discount") < 0.03).alias("complete"))


def _plan(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.lit(24.0).alias("fps"))


@query("j06_pending", f"WITH {DONE} SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.l_orderkey = o.o_orderkey AND d.signature = o.o_orderstatus AND abs(d.fps - 24.0) <= 1e-6 AND d.complete)")
def j06(spark, sf_dir):
    return catalog.pending(_plan(spark, sf_dir), _results(spark, sf_dir), "o_orderkey", "o_orderstatus", "fps", F.col("complete")).select("o_orderkey")


@query("j06_pending_weak", f"WITH {DONE} SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.l_orderkey = o.o_orderkey AND d.signature = o.o_orderstatus AND abs(d.fps - 24.0) <= 1e-6)")
def j06_weak(spark, sf_dir):
    return catalog.pending(_plan(spark, sf_dir), _results(spark, sf_dir), "o_orderkey", "o_orderstatus", "fps", F.col("complete"), strict=False).select("o_orderkey")


@query("j07_merge_results", f"WITH {DONE} SELECT o_orderkey, d.complete FROM orders o JOIN done d ON d.l_orderkey = o.o_orderkey AND d.signature = o.o_orderstatus AND d.fps = 24.0")
def j07(spark, sf_dir):
    return _plan(spark, sf_dir).join(_results(spark, sf_dir), ["o_orderkey", "o_orderstatus", "fps"]).orderBy("o_orderkey").select("o_orderkey", "complete")


@query("j09_block_lookup", f"WITH {FRAMES} SELECT source_id, idx // 16 AS block, count(*) AS selected FROM frames WHERE face_detected GROUP BY source_id, idx // 16")
def j09(spark, sf_dir):
    """Selected frames within blocks of 16: the block is a function of the index, so no range search is needed."""
    return frames(spark, sf_dir).where("face_detected").groupBy("source_id", F.floor(F.col("idx") / 16).alias("block")).agg(F.count("*").alias("selected"))


@query("j11_overrides", "SELECT d.doc_id, coalesce(CASE WHEN l.toxic = 1 THEN 'toxic' END, d.lang) AS lang, l.toxic IS NOT NULL AND l.toxic = 1 AS was_overridden FROM documents d LEFT JOIN labels l USING (doc_id)")
def j11(spark, sf_dir):
    verified = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit("toxic").alias("lang"))
    return catalog.overridden(table(spark, sf_dir, "documents").select("doc_id", "lang"), verified, "doc_id", "lang")


CANDIDATES = "candidates AS (SELECT s_suppkey, r AS rotation, round(s_acctbal / 1000 * CASE r WHEN 0 THEN 1 WHEN 90 THEN -1 WHEN 180 THEN 0.5 ELSE 0.5 END, 6) AS score FROM supplier, (VALUES (0), (90), (180), (270)) t(r))"


def _candidates(spark, sf_dir):
    """Each source with each of four rotations."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", F.explode(F.array(*map(F.lit, (0, 90, 180, 270)))).alias("rotation"))
    factor = F.when(F.col("rotation") == 0, 1.0).when(F.col("rotation") == 90, -1.0).otherwise(0.5)
    return rows.select("s_suppkey", "rotation", F.round(F.col("s_acctbal") / 1000 * factor, 6).alias("score"))


@query("j13_source_rotations", f"WITH {CANDIDATES} SELECT s_suppkey, rotation, score FROM candidates")
def j13(spark, sf_dir):
    return _candidates(spark, sf_dir)


@query("w14_best_two", f"WITH {CANDIDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY score DESC, rotation) AS k FROM candidates), b AS (SELECT s_suppkey, max(CASE WHEN k = 1 THEN rotation END) AS best, max(CASE WHEN k = 1 THEN score END) AS s1, max(CASE WHEN k = 2 THEN score END) AS s2 FROM r GROUP BY s_suppkey) SELECT s_suppkey, best, round(s1 - s2, 6) AS gap, CASE WHEN round(s1 - s2, 6) >= 0.75 THEN 'high' ELSE 'review' END AS confidence FROM b")
def w14(spark, sf_dir):
    two = ranking.best_two(_candidates(spark, sf_dir), "s_suppkey", "score", "rotation").withColumn("gap", F.round("gap", 6))
    return two.select("s_suppkey", "best", "gap", ranking.confidence(F.lit(False), F.lit(True), F.col("gap")).alias("confidence"))


# --- content groups and summaries

CONTENT = "content AS (SELECT doc_id, sha256(text) AS digest, length(text) AS bytes, printf('%s/%09d', source, doc_id) AS path, source, n_chars, lang FROM documents)"


def _content(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.sha2("text", 256).alias("digest"), F.length("text").cast("long").alias("bytes"), F.format_string("%s/%09d", "source", "doc_id").alias("path"), "source", "n_chars", "lang")


@query("a01_content_aliases", f"WITH {CONTENT}, g AS (SELECT bytes, digest, list_sort(list(path)) AS names FROM content GROUP BY bytes, digest) SELECT digest, names[1] AS canonical, array_to_string(names[2:], ',') AS aliases, len(names) AS members FROM g")
def a01(spark, sf_dir):
    return catalog.content_groups(_content(spark, sf_dir), ["bytes", "digest"], "path").select("digest", "canonical", F.array_join("aliases", ",").alias("aliases"), "members")


@query("a02_duplicate_totals", f"WITH {CONTENT}, g AS (SELECT count(*) AS n, max(bytes) AS b FROM content GROUP BY bytes, digest HAVING count(*) > 1) SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess, CAST(coalesce(sum((n - 1) * b), 0) AS BIGINT) AS duplicate_bytes FROM g")
def a02(spark, sf_dir):
    return catalog.duplicate_totals(_content(spark, sf_dir), ["bytes", "digest"], "bytes")


@query("a03_inventory_summary", f"WITH {CONTENT} SELECT count(*) AS files, count(*) FILTER (WHERE lang = 'en') AS probe_ok, count(*) FILTER (WHERE lang <> 'en') AS probe_failed, count(DISTINCT digest) AS unique_files, round(sum(bytes) / 1048576.0, 3) AS total_mib FROM content")
def a03(spark, sf_dir):
    rows = _content(spark, sf_dir)
    groups = rows.groupBy("digest").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == "en").alias("ok"), F.count_if(F.col("lang") != "en").alias("bad"), F.sum("bytes").alias("b"))
    return groups.agg(F.sum("n").alias("files"), F.sum("ok").alias("probe_ok"), F.sum("bad").alias("probe_failed"), F.count("*").alias("unique_files"), F.round(F.sum("b") / 1048576.0, 3).alias("total_mib"))


@query("a04_first_of_content", f"WITH {CONTENT} SELECT doc_id, path FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(digest, path) ORDER BY doc_id) AS k FROM content) WHERE k = 1")
def a04(spark, sf_dir):
    return catalog.first_of(_content(spark, sf_dir), F.coalesce("digest", "path"), "doc_id").select("doc_id", "path")


@query("a05_canonical_items", f"WITH {CONTENT}, f AS (SELECT *, first_value(path) OVER (PARTITION BY digest ORDER BY doc_id) AS canonical FROM content) SELECT doc_id, canonical, CASE WHEN path <> canonical THEN canonical END AS duplicate_of FROM f")
def a05(spark, sf_dir):
    return catalog.canonical(_content(spark, sf_dir), "digest", "doc_id", "path").select("doc_id", "canonical", "duplicate_of")


@query("a06_trajectory_fingerprint", f"WITH {FRAMES} SELECT source_id, sha256(string_agg(CAST(event_id AS VARCHAR) || ',' || event_type, ';' ORDER BY idx)) AS fingerprint FROM frames GROUP BY source_id")
def a06(spark, sf_dir):
    return catalog.fingerprint(frames(spark, sf_dir), "source_id", "idx", ["event_id", "event_type"])


@query("a26_detection_counters", f"WITH {FRAMES} SELECT source_id, count(*) AS frames, count(*) FILTER (WHERE face_detected) AS face_frames, count(*) FILTER (WHERE left_open IS NOT NULL) AS left_frames, count(*) FILTER (WHERE right_open IS NOT NULL) AS right_frames FROM frames GROUP BY source_id")
def a26(spark, sf_dir):
    return frames(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("frames"), F.count_if("face_detected").alias("face_frames"), F.count("left_open").alias("left_frames"), F.count("right_open").alias("right_frames"))


@query("a25_calibration", f"WITH {FRAMES} SELECT round(quantile_cont(gaze_h, 0.5), 6) AS gaze_h, round(quantile_cont(gaze_v, 0.5), 6) AS gaze_v, round(quantile_cont(pitch, 0.5), 6) AS pitch, round(quantile_cont(yaw, 0.5), 6) AS yaw, round(quantile_cont(roll, 0.5), 6) AS roll, count(*) AS samples FROM frames")
def a25(spark, sf_dir):
    fields = ("gaze_h", "gaze_v", "pitch", "yaw", "roll")
    rows = frames(spark, sf_dir)
    middle = intervals.global_quantiles(rows, {c: (F.col(c), 0.5) for c in fields})
    known = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"no value of {c}")).cast("double")).otherwise(F.round(c, 6)).alias(c) for c in fields]
    return middle.crossJoin(F.broadcast(rows.agg(F.count("*").alias("samples")))).select(*known, "samples")


@query("a27_run_aggregates", f"WITH {DONE}, p AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') SELECT count(*) AS sources, bool_and(complete) AS all_complete, round(sum(fps), 6) AS fps, count(*) FILTER (WHERE l_orderkey IN (SELECT o_orderkey FROM p)) AS dispatched FROM done")
def a27(spark, sf_dir):
    planned = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_orderkey", F.lit(1).alias("planned"))
    return _results(spark, sf_dir).join(planned, "o_orderkey", "left").agg(F.count("*").alias("sources"), F.every("complete").alias("all_complete"), F.round(F.sum("fps"), 6).alias("fps"), F.count("planned").alias("dispatched"))


@query("a28_orientation_histogram", f"SELECT rotation, count(p_partkey) AS n FROM (VALUES (0), (90), (180), (270), (45)) t(rotation) LEFT JOIN ({ROTATED}) r USING (rotation) GROUP BY rotation")
def a28(spark, sf_dir):
    """Counts of every listed rotation, those that don't occur too."""
    all_of = spark.createDataFrame([(r,) for r in (0, 90, 180, 270, 45)], "rotation int")
    found = _rotated(spark, sf_dir).groupBy("rotation").agg(F.count("*").alias("n"))
    return all_of.join(found, "rotation", "left").select("rotation", F.coalesce("n", F.lit(0)).alias("n"))


@query("a33_geometry_batches", f"SELECT p_partkey, CAST((row_number() OVER (PARTITION BY height, width ORDER BY p_partkey) - 1) // 32 AS BIGINT) AS batch FROM ({ROTATED})")
def a33(spark, sf_dir):
    return catalog.batches_by(_rotated(spark, sf_dir), ["height", "width"], "p_partkey", 32).select("p_partkey", "batch")


@query("a35_throughput", "SELECT l_returnflag, round(sum(l_quantity) / nullif(sum(l_tax), 0), 4) AS per_tax FROM lineitem GROUP BY l_returnflag")
def a35(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.try_divide(F.sum("l_quantity"), F.sum("l_tax")), 4).alias("per_tax"))


@query("a32_best_per_source", "SELECT c_nationkey, c_custkey, round(c_acctbal, 6) AS best FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer) WHERE k = 1")
def a32(spark, sf_dir):
    return ranking.best_of(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", "c_custkey").orderBy(F.desc("c_acctbal")).select("c_nationkey", "c_custkey", F.round("c_acctbal", 6).alias("best"))


# --- order, limits, sets


@query("o01_multi_key_sort", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_custkey, o_orderkey) AS place FROM orders")
def o01(spark, sf_dir):
    part = F.coalesce(F.floor(-F.col("o_totalprice")).cast("long"), F.lit((1 << 63) - 1))  # no price comes last
    order = [F.desc_nulls_last("o_totalprice"), "o_custkey", "o_orderkey"]
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return numbered(rows, [], part, order, "place").select("o_orderkey", "place")


@query("o02_sort_by_path", f"WITH {CONTENT} SELECT path, bytes, row_number() OVER (ORDER BY path) AS place FROM content")
def o02(spark, sf_dir):
    rows = _content(spark, sf_dir).select("path", "bytes")
    return numbered(rows, [], F.substring("path", 1, 12), ["path"], "place").select("path", "bytes", "place")


@query("o03_groups_by_first_member", f"WITH {CONTENT}, g AS (SELECT min(path) AS first_path, count(*) AS members FROM content GROUP BY digest HAVING count(*) > 1) SELECT *, row_number() OVER (ORDER BY first_path) AS place FROM g")
def o03(spark, sf_dir):
    groups = _content(spark, sf_dir).groupBy("digest").agg(F.min("path").alias("first_path"), F.count("*").alias("members")).where("members > 1")
    return numbered(groups, [], F.substring("first_path", 1, 12), ["first_path"], "place").select("first_path", "members", "place")


@query("o06_first_n", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 50")
def o06(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy("doc_id").limit(50)


@query("o07_top_reasons", "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k FROM c) SELECT user_id, string_agg(event_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY k) AS reasons FROM r WHERE k <= 3 GROUP BY user_id")
def o07(spark, sf_dir):
    kinds = ("click", "error", "purchase", "signup", "view")
    counts = F.create_map(*(x for k in kinds for x in (F.lit(k), F.count_if(F.col("event_type") == k))))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.map_filter(counts, lambda k, v: v > 0).alias("m"))
    return rows.select("user_id", F.array_join(F.transform(ranking.top_entries(F.col("m"), 3), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("reasons"))


@query("u01_distinct_union", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def u01(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).distinct()
    return customers.union(table(spark, sf_dir, "supplier").select("s_nationkey").distinct()).distinct()


@query("u02_difference", "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'")
def u02(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey").subtract(table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select("l_partkey"))


@query("u03_append", "SELECT s_suppkey AS k, 'supplier' AS kind FROM supplier UNION ALL SELECT c_custkey, 'customer' FROM customer")
def u03(spark, sf_dir):
    part = lambda t, k, kind: table(spark, sf_dir, t).select(F.col(k).alias("k"), F.lit(kind).alias("kind"))
    return part("supplier", "s_suppkey", "supplier").unionByName(part("customer", "c_custkey", "customer"))


# --- validation

CHECKS = f"WITH {DONE} SELECT o.o_orderkey, CASE WHEN d.l_orderkey IS NULL THEN 'no result' WHEN d.signature <> o.o_orderstatus THEN 'signature' WHEN abs(d.fps - 24.0) > 1e-6 THEN 'rate' WHEN NOT d.complete THEN 'incomplete' END AS error FROM orders o LEFT JOIN done d ON d.l_orderkey = o.o_orderkey"


def _validated(spark, sf_dir):
    got = _results(spark, sf_dir).select("o_orderkey", F.col("o_orderstatus").alias("got"), F.col("fps").alias("got_fps"), "complete")
    rows = _plan(spark, sf_dir).join(got, "o_orderkey", "left")
    checks = [(F.col("got").isNotNull(), "no result"), (F.col("got") == F.col("o_orderstatus"), "signature"), (F.abs(F.col("got_fps") - F.col("fps")) <= 1e-6, "rate"), (F.col("complete"), "incomplete")]
    return rows.select("o_orderkey", catalog.first_failure(checks).alias("error"))


@query("v01_source_completeness", CHECKS)
def v01(spark, sf_dir):
    return _validated(spark, sf_dir)


# results of resampling to 24 a second: some rows lost, some frames off by one, some times late
RESULTS = f"""{FRAMES}, n AS (SELECT user_id AS source_id, count(*) AS n FROM events GROUP BY user_id), k AS (SELECT source_id, unnest(generate_series(0, CAST(floor((n - 1) * 24.0 / 30.0) AS BIGINT))) AS target_idx FROM n),
expected AS (SELECT source_id, target_idx, CAST(floor(target_idx * 30.0 / 24.0 + 0.5) AS BIGINT) AS source_idx FROM k),
got AS (SELECT e.source_id, row_number() OVER (PARTITION BY e.source_id ORDER BY e.target_idx) - 1 AS target_idx, e.source_idx + CASE WHEN f.event_id % 499 = 0 THEN 1 ELSE 0 END AS frame, e.target_idx / CAST(24 AS DOUBLE) + CASE WHEN f.event_id % 251 = 0 THEN 0.001 ELSE 0 END AS time_s
  FROM expected e JOIN frames f ON f.source_id = e.source_id AND f.idx = e.source_idx WHERE f.event_id % 211 <> 0)"""


def _resampled(spark, sf_dir):
    rows = frames(spark, sf_dir).select("source_id", F.col("idx").alias("source_idx"), "event_id")
    sources = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("source_id")).agg(F.count("*").alias("n"))
    expected = timeline.resample(sources, "n", 30.0, 24.0).select("source_id", "target_idx", "source_idx")
    kept = expected.join(rows, ["source_id", "source_idx"]).where(F.col("event_id") % 211 != 0)
    place = (F.row_number().over(W.partitionBy("source_id").orderBy("target_idx")) - 1).cast("long")
    late = F.when(F.col("event_id") % 251 == 0, 0.001).otherwise(0.0)
    got = kept.select("source_id", place.alias("target_idx"), (F.col("source_idx") + (F.col("event_id") % 499 == 0).cast("int")).alias("frame"), (F.col("target_idx") / 24.0 + late).alias("time_s"))
    return expected, got


@query("v02_timeline_check", f"WITH {RESULTS}, b AS (SELECT coalesce(e.source_id, g.source_id) AS source_id, e.source_idx, e.target_idx, g.frame, g.time_s FROM expected e FULL JOIN got g ON e.source_id = g.source_id AND e.target_idx = g.target_idx) SELECT source_id, count(frame) AS found, count(source_idx) AS expected, CASE WHEN count(frame) <> count(source_idx) THEN 'rows' WHEN count(*) FILTER (WHERE frame <> source_idx) > 0 THEN 'frame' WHEN count(*) FILTER (WHERE abs(time_s - target_idx / CAST(24 AS DOUBLE)) > 2e-5) > 0 THEN 'time_s' END AS error FROM b GROUP BY source_id")
def v02(spark, sf_dir):
    expected, got = _resampled(spark, sf_dir)
    return catalog.timeline_errors(expected, got, "source_id", 24.0)


@query("v03_size_unchanged", "SELECT d.doc_id, d.n_chars, length(d.text) AS staged FROM documents d WHERE d.n_chars <> length(d.text)")
def v03(spark, sf_dir):
    staged = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.length("text").cast("long").alias("staged"))
    return staged.where("n_chars <> staged")


@query("v04_runtime_contract", f"WITH {FRAMES}, r AS (SELECT source_id, CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN -1 WHEN event_id % 107 = 0 AND idx > 0 THEN idx - 1 ELSE idx END AS idx FROM frames) SELECT source_id, count(*) AS frames, count(*) FILTER (WHERE idx IS NULL) AS missing, count(*) FILTER (WHERE idx < 0) AS negative, count(idx) - count(DISTINCT idx) AS repeated FROM r GROUP BY source_id")
def v04(spark, sf_dir):
    """Rows that break the contract are counted; catalog.checked_indices makes them errors."""
    broken = F.when(F.col("event_id") % 101 == 0, None).when(F.col("event_id") % 103 == 0, -1).when((F.col("event_id") % 107 == 0) & (F.col("idx") > 0), F.col("idx") - 1).otherwise(F.col("idx"))
    return catalog.index_faults(frames(spark, sf_dir).select("source_id", broken.cast("long").alias("idx")), "source_id", "idx")


@query("a29_validation_report", f"WITH e AS ({CHECKS.replace('WITH ', 'WITH ', 1)}) SELECT coalesce(error, 'ok') AS outcome, count(*) AS sources FROM e GROUP BY ALL")
def a29(spark, sf_dir):
    return _validated(spark, sf_dir).groupBy(F.coalesce("error", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("sources"))




# --- sinks, written to the shared folder and read back


@query("s01_file_scan")
def s01(spark, sf_dir):
    from cadenza.sources.files import scan

    return scan(spark, sf_dir, [""], (".parquet",)).select("relative_path", "bytes")


def _written(spark, name: str):
    return Scratch(spark, "sinks").path(name)


@query("s09_json_sink", "SELECT n_nationkey, n_name FROM nation")
def s09(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    manifests.write_json_document(rows, path := _written(spark, "document"))
    return manifests.read_items(spark, path, rows.schema)


@query("s10_csv_sink", "SELECT s_suppkey, s_name FROM supplier")
def s10(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    manifests.write_csv(rows, path := _written(spark, "csv"))
    return spark.read.schema("s_suppkey long, s_name string").option("header", True).csv(path)


@query("s11_json_lines_sink", "SELECT event_id, event_type FROM events")
def s11(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    manifests.write_json_lines(rows, path := _written(spark, "lines"))
    return spark.read.schema(rows.schema).json(path)


@query("s07_frames_parquet", f"WITH {FRAMES} SELECT source_id, idx, event_id FROM frames")
def s07(spark, sf_dir):
    columns.write_frames(frames(spark, sf_dir).select("source_id", "idx", "event_id", "value"), path := _written(spark, "frames"))
    return spark.read.parquet(path).select("source_id", "idx", "event_id")


@query("s12_html_report", "SELECT n_nationkey, n_name FROM nation")
def s12_report(spark, sf_dir):
    """The report written and its table read back: the page holds every row."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    manifests.write_html_table(rows, "Nations", path := _written(spark, "report"))
    cell = lambda k: F.regexp_extract("value", r"^<tr><td>(.*?)</td><td>(.*?)</td></tr>$", k)
    return spark.read.text(path).where("value like '<tr><td>%'").select(cell(1).cast(rows.schema[0].dataType).alias("n_nationkey"), cell(2).alias("n_name"))
