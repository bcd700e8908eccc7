"""Threshold learning, classification, review and gaze queries over documents, labels and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions import clock, html_escape
from cadenza.operators import catalog, intervals, learn, ranking
from cadenza.operators.numbering import numbered
from cadenza.plans._registry import FRAMES, frames, query, table

LABELLED = "labelled AS (SELECT d.doc_id, d.source, d.n_chars, l.quality = 1 AS positive, l.toxic FROM documents d JOIN labels l USING (doc_id))"


def _labelled(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("positive"), "toxic")
    return table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(labels, "doc_id")


@query("a17_confusion", f"WITH {LABELLED} SELECT count(*) FILTER (WHERE NOT positive AND n_chars > 2000) AS tn, count(*) FILTER (WHERE NOT positive AND n_chars <= 2000) AS fp, count(*) FILTER (WHERE positive AND n_chars > 2000) AS fn, count(*) FILTER (WHERE positive AND n_chars <= 2000) AS tp FROM labelled")
def a17(spark, sf_dir):
    return learn.confusion(_labelled(spark, sf_dir), F.col("positive"), F.col("n_chars") <= 2000)


@query("a18_balanced_accuracy", f"WITH {LABELLED}, c AS (SELECT count(*) FILTER (WHERE NOT positive) AS n, count(*) FILTER (WHERE positive) AS p, count(*) FILTER (WHERE NOT positive AND n_chars > 2000) AS tn, count(*) FILTER (WHERE positive AND n_chars <= 2000) AS tp FROM labelled) SELECT round(CASE WHEN n > 0 AND p > 0 THEN (tn / n + tp / p) / 2 ELSE 0 END, 6) AS accuracy FROM c")
def a18(spark, sf_dir):
    c = learn.confusion(_labelled(spark, sf_dir), F.col("positive"), F.col("n_chars") <= 2000)
    return c.select(F.round(learn.balanced_accuracy(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")), 6).alias("accuracy"))


def _threshold_sql(rows: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    pick = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""(WITH v AS (SELECT {pick}n_chars AS x, count(*) FILTER (WHERE positive) AS p, count(*) FILTER (WHERE NOT positive) AS n FROM {rows} GROUP BY {pick}n_chars),
s AS (SELECT {pick}x, lead(x) OVER ({part}ORDER BY x) AS nx, sum(p) OVER ({part}ORDER BY x) AS tp, sum(n) OVER ({part}ORDER BY x) AS fp, sum(p) OVER ({part}) AS ps, sum(n) OVER ({part}) AS ns FROM v),
t AS (SELECT {pick}(x + nx) / 2.0 AS threshold, round(((ns - fp) / ns + tp / ps) / 2, 12) AS accuracy FROM s WHERE nx IS NOT NULL AND ps > 0 AND ns > 0)
SELECT {pick}arg_max(threshold, accuracy * 1e9 + threshold / 1e9) AS threshold, max(accuracy) AS accuracy FROM t {group})"""


@query("a19_best_threshold", f"WITH {LABELLED} SELECT CAST(threshold AS DOUBLE) AS threshold, round(accuracy, 6) AS balanced_accuracy FROM {_threshold_sql('labelled')}")
def a19(spark, sf_dir):
    return learn.best_upper_threshold(_labelled(spark, sf_dir), "n_chars", "positive").select("threshold", F.round("balanced_accuracy", 6).alias("balanced_accuracy"))


FOLDED = f"{LABELLED}, folded AS (SELECT *, CAST((row_number() OVER (PARTITION BY positive ORDER BY doc_id) - 1) % 5 AS INT) AS fold FROM labelled)"


@query("a20_stratified_folds", f"WITH {FOLDED} SELECT doc_id, positive, fold FROM folded")
def a20(spark, sf_dir):
    return learn.stratified_folds(_labelled(spark, sf_dir), "positive", "doc_id", 5).select("doc_id", "positive", "fold")


@query("a21_cross_validation", f"WITH {FOLDED}, train AS (SELECT k.fold AS test_fold, f.n_chars, f.positive FROM folded f, (VALUES (0), (1), (2), (3), (4)) k(fold) WHERE f.fold <> k.fold), fitted AS (SELECT * FROM {_threshold_sql('train', 'test_fold')}) SELECT f.fold, CAST(t.threshold AS DOUBLE) AS threshold, count(*) FILTER (WHERE NOT positive AND n_chars > threshold) AS tn, count(*) FILTER (WHERE NOT positive AND n_chars <= threshold) AS fp, count(*) FILTER (WHERE positive AND n_chars > threshold) AS fn, count(*) FILTER (WHERE positive AND n_chars <= threshold) AS tp FROM folded f JOIN fitted t ON t.test_fold = f.fold GROUP BY f.fold, t.threshold")
def a21(spark, sf_dir):
    folded = learn.stratified_folds(_labelled(spark, sf_dir), "positive", "doc_id", 5)
    return learn.cross_validated(folded, "n_chars", "positive", 5)


POOLED = f"""WITH {LABELLED}, c AS (SELECT least(10, count(*) FILTER (WHERE positive), count(*) FILTER (WHERE NOT positive)) AS folds FROM labelled),
folded AS (SELECT l.*, CAST((row_number() OVER (PARTITION BY positive ORDER BY doc_id) - 1) % c.folds AS INT) AS fold FROM labelled l, c),
train AS (SELECT k.fold AS test_fold, f.n_chars, f.positive FROM folded f, (SELECT DISTINCT fold FROM folded) k WHERE f.fold <> k.fold), fitted AS (SELECT * FROM {_threshold_sql('train', 'test_fold')}),
judged AS (SELECT f.positive, f.n_chars <= t.threshold AS said, f.fold FROM folded f JOIN fitted t ON t.test_fold = f.fold),
p AS (SELECT count(*) FILTER (WHERE NOT positive AND NOT said) AS tn, count(*) FILTER (WHERE NOT positive AND said) AS fp, count(*) FILTER (WHERE positive AND NOT said) AS fn, count(*) FILTER (WHERE positive AND said) AS tp FROM judged)
SELECT (SELECT count(*) FROM fitted) AS folds, tn, fp, fn, tp, round((tn / (tn + fp) + tp / (fn + tp)) / 2, 6) AS balanced_accuracy, round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy,
  (SELECT CAST(min(threshold) AS DOUBLE) FROM fitted) AS threshold_min, (SELECT CAST(quantile_cont(threshold, 0.5) AS DOUBLE) FROM fitted) AS threshold_median, (SELECT CAST(max(threshold) AS DOUBLE) FROM fitted) AS threshold_max FROM p"""


@query("a21_pooled_validation", POOLED)
def a21_pooled(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    folds = learn.fold_count(rows, "positive")
    done = learn.pooled(learn.cross_validated(learn.stratified_folds(rows, "positive", "doc_id", folds), "n_chars", "positive", folds))
    return done.withColumns({c: F.round(c, 6) for c in ("balanced_accuracy", "accuracy")})


@query("p16_decision_validation", "SELECT l.doc_id, CASE WHEN d.doc_id IS NULL THEN 'absent from manifest' WHEN l.quality NOT IN (0, 1) THEN 'unknown decision' END AS problem FROM labels l LEFT JOIN documents d USING (doc_id)")
def p16(spark, sf_dir):
    known = table(spark, sf_dir, "documents").select("doc_id", F.lit(True).alias("found"))
    rows = table(spark, sf_dir, "labels").join(known, "doc_id", "left")
    return rows.select("doc_id", catalog.first_failure([(F.col("found"), "absent from manifest"), (F.col("quality").isin(0, 1), "unknown decision")]).alias("problem"))


CLASSES = """decided AS (SELECT d.doc_id, d.source, d.n_chars, CASE WHEN l.toxic = 1 THEN 'drop' END AS decision FROM documents d LEFT JOIN labels l USING (doc_id)),
classes AS (SELECT *, coalesce(decision, CASE WHEN abs(n_chars - 3000) <= 500 THEN 'review' WHEN n_chars <= 3000 THEN 'keep' ELSE 'drop' END) AS classification,
  CASE WHEN decision IS NOT NULL THEN 'human' WHEN abs(n_chars - 3000) <= 500 THEN 'rule_review_band' ELSE 'yaw_rule' END AS classification_source,
  CASE WHEN n_chars <= 3000 THEN 'keep' ELSE 'drop' END AS suggested, n_chars - 3000 AS distance FROM decided)"""


def _classes(spark, sf_dir):
    decisions = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit("drop").alias("decision"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(decisions, "doc_id", "left")
    return rows.withColumns(learn.classified(F.col("n_chars"), F.lit(3000).cast("long"), 500, F.col("decision")))


@query("p17_classify", f"WITH {CLASSES} SELECT doc_id, classification, classification_source, suggested, distance FROM classes")
def p17(spark, sf_dir):
    return _classes(spark, sf_dir).select("doc_id", "classification", "classification_source", "suggested", "distance")


@query("a14_by_source", f"WITH {CLASSES} SELECT source, {', '.join(f'''count(*) FILTER (WHERE classification = '{c}') AS {c}_n, CAST(coalesce(sum(n_chars) FILTER (WHERE classification = '{c}'), 0) AS BIGINT) AS {c}_n_chars''' for c in ('keep', 'review', 'drop'))} FROM classes GROUP BY source")
def a14(spark, sf_dir):
    return catalog.sparse_pivot(_classes(spark, sf_dir), "source", "classification", ["keep", "review", "drop"], "n_chars")


@query("a15_by_top_folder", f"WITH {CLASSES} SELECT split_part(source || '/' || CAST(doc_id AS VARCHAR), '/', 1) AS folder, classification, count(*) AS n FROM classes GROUP BY ALL")
def a15(spark, sf_dir):
    from cadenza.functions import top_folder

    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    return _classes(spark, sf_dir).groupBy(top_folder(path).alias("folder"), "classification").agg(F.count("*").alias("n"))


@query("a16_class_totals", f"WITH {CLASSES} SELECT classification, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, count(DISTINCT source) AS sources FROM classes GROUP BY classification")
def a16(spark, sf_dir):
    per_source = _classes(spark, sf_dir).groupBy("classification", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    return per_source.groupBy("classification").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.count("*").alias("sources"))


@query("o04_review_queue", f"WITH {CLASSES} SELECT doc_id, row_number() OVER (ORDER BY abs(coalesce(distance, 0)), doc_id) AS place FROM classes WHERE classification = 'review'")
def o04(spark, sf_dir):
    queue = _classes(spark, sf_dir).where("classification = 'review'")
    distance = F.abs(F.coalesce("distance", F.lit(0)))
    return numbered(queue, ["classification"], F.floor(distance / 10), [distance, "doc_id"], "place").select("doc_id", "place")


@query("p19_review_filter", f"WITH {CLASSES} SELECT doc_id, coalesce(decision, 'pending') AS decision FROM classes WHERE contains(lower(source), 'src1')")
def p19(spark, sf_dir):
    return _classes(spark, sf_dir).where(F.lower("source").contains("src1")).select("doc_id", F.coalesce("decision", F.lit("pending")).alias("decision"))


@query("p20_zero_yield", f"WITH {CLASSES}, s AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE classification = 'keep' AND n_chars > 2300) AS kept, count(*) FILTER (WHERE classification = 'drop') AS dropped, count(*) FILTER (WHERE classification = 'review') AS reviewed FROM classes GROUP BY source) SELECT source, n, round(100.0 * dropped / n, 4) AS drop_pct, round(100.0 * reviewed / n, 4) AS review_pct FROM s WHERE kept < 5")
def p20(spark, sf_dir):
    is_ = lambda c: F.col("classification") == c
    per = _classes(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"), F.count_if(is_("keep") & (F.col("n_chars") > 2300)).alias("kept"), F.count_if(is_("drop")).alias("dropped"), F.count_if(is_("review")).alias("reviewed"))
    return per.where("kept < 5").select("source", "n", F.round(100.0 * F.col("dropped") / F.col("n"), 4).alias("drop_pct"), F.round(100.0 * F.col("reviewed") / F.col("n"), 4).alias("review_pct"))


@query("a34_report_statistics", f"WITH {CLASSES} SELECT count(*) AS segments, count(DISTINCT source) AS sources, count(*) FILTER (WHERE classification = 'keep') AS kept, CAST(sum(n_chars) AS BIGINT) AS total_chars FROM classes")
def a34(spark, sf_dir):
    per = _classes(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("classification") == "keep").alias("k"), F.sum("n_chars").alias("c"))
    return per.agg(F.sum("n").alias("segments"), F.count("*").alias("sources"), F.sum("k").alias("kept"), F.sum("c").alias("total_chars"))


@query("s12_report_cards", "SELECT page_id, replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS link, printf('%d:%02d:%02d', CAST(length(html) // 3600 AS INT), CAST(length(html) % 3600 // 60 AS INT), CAST(length(html) % 60 AS INT)) AS clock FROM pages")
def s12(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_escape(F.col("url")).alias("link"), clock(F.length("html").cast("double")).alias("clock"))


@query("s13_strip_times", "SELECT event_id, round(value + 10.0 * f, 6) AS at FROM events, (VALUES (0.15), (0.5), (0.85)) t(f)")
def s13(spark, sf_dir):
    at = F.transform(F.array(*map(F.lit, (0.15, 0.5, 0.85))), lambda f: F.round(F.col("value") + 10.0 * f, 6))
    return table(spark, sf_dir, "events").select("event_id", F.explode(at).alias("at"))


# --- gaze

GAZE = f"{FRAMES}, gaze AS (SELECT source_id, round(quantile_cont(abs(gaze_h), 0.95), 9) AS p95_h, round(quantile_cont(abs(gaze_v), 0.95), 9) AS p95_v, round(quantile_cont(abs(gaze_h + 0.003 * yaw), 0.95), 9) AS residual FROM frames GROUP BY source_id)"


def _gaze(spark, sf_dir):
    q = lambda x: F.round(F.percentile(F.abs(x), 0.95), 9)
    return frames(spark, sf_dir).groupBy("source_id").agg(q(F.col("gaze_h")).alias("p95_h"), q(F.col("gaze_v")).alias("p95_v"), q(F.col("gaze_h") + 0.003 * F.col("yaw")).alias("residual"))


@query("a22_gaze_metrics", f"WITH {GAZE} SELECT source_id, round(p95_h, 6) AS p95_h, round(p95_v, 6) AS p95_v, round(residual, 6) AS residual FROM gaze")
def a22(spark, sf_dir):
    return _gaze(spark, sf_dir).select("source_id", *(F.round(c, 6).alias(c) for c in ("p95_h", "p95_v", "residual")))


SLOPES = 1001
SPREADS = f"{FRAMES}, g AS (SELECT CAST(i AS INT) AS step, CAST(-0.008 AS DOUBLE) + i * (CAST(0.010 AS DOUBLE) / 1000) AS slope FROM generate_series(0, 1000) t(i)), s AS (SELECT step, slope, source_id, quantile_cont(abs(gaze_h - slope * yaw), 0.95) AS p95 FROM frames, g GROUP BY ALL)"


@query("a23_slope_search", f"WITH {SPREADS}, l AS (SELECT step, slope, round(quantile_cont(p95, 0.5), 9) AS loss FROM s GROUP BY step, slope) SELECT step, round(slope, 6) AS slope, round(loss, 6) AS loss FROM l ORDER BY l.loss, l.step LIMIT 1")
def a23(spark, sf_dir):
    best = learn.slope_search(frames(spark, sf_dir), "source_id", "gaze_h", "yaw", -0.008, 0.002, SLOPES)
    return best.select("step", F.round("slope", 6).alias("slope"), F.round("loss", 6).alias("loss"))


@query("j14_slope_grid", f"WITH {SPREADS} SELECT source_id, step, round(p95, 9) AS p95 FROM s")
def j14(spark, sf_dir):
    spreads = learn.slope_spreads(frames(spark, sf_dir), "source_id", "gaze_h", "yaw", -0.008, 0.002, SLOPES)
    return spreads.select("source_id", F.posexplode("spreads").alias("step", "p95")).select("source_id", "step", F.round("p95", 9).alias("p95"))


@query("a24_vertical_reference", f"WITH {GAZE} SELECT round(quantile_cont(p95_v, 0.95), 6) AS reference FROM gaze")
def a24(spark, sf_dir):
    return intervals.global_quantile(_gaze(spark, sf_dir), F.col("p95_v"), 0.95, "reference").select(F.round("reference", 6).alias("reference"))


@query("p18_gaze_risk", f"WITH {GAZE} SELECT source_id, round(CASE WHEN residual IS NOT NULL THEN greatest(residual / 0.25, p95_v / (SELECT quantile_cont(p95_v, 0.95) FROM gaze)) END, 6) AS risk FROM gaze")
def p18(spark, sf_dir):
    rows = _gaze(spark, sf_dir)
    reference = intervals.global_quantile(rows, F.col("p95_v"), 0.95, "reference")  # one row
    both = rows.crossJoin(F.broadcast(reference))
    return both.select("source_id", F.round(learn.gaze_risk(F.col("residual"), F.lit(0.25), F.col("p95_v"), F.col("reference")), 6).alias("risk"))
