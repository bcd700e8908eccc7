"""URL filtering by host rules and a ratio of two character language models.

Rules decide the URLs that they fit. They also label the training data: two variable-order Markov models are
learned from the accepted and the rejected URLs, each smoothed by mixing every order with the next lower one
(down to a uniform distribution). A URL without a rule is judged by the difference of its two log-likelihoods,
divided by its number of characters, against a threshold calibrated on the labelled URLs (best balanced
accuracy; the larger of equal ones, which blocks less). Digits count as one character, so that page numbers
carry nothing. Main path: DataFrame functions only. URLs are cut into character grams, the grams are counted
once, and the models are evaluated once for each distinct gram and joined back; Catalyst broadcasts the gram
table only if its size is below the session's threshold. The distinct URLs, the gram counts, the gram ratios and
the scores are written to the shared folder, so that each is computed once and no plan grows with the order.

Nulls and edges: a null URL or one without `://` has an empty host and path and no rule, and is allowed; repeated
rows are judged each for itself; with only one kind of label, or none, all URLs without a rule are allowed; input
columns that clash with result columns are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.llm._shared import Scratch

#: verdict, host and path prefix
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 4
#: Weight of the next lower order, as a count of characters, and the size of the uniform alphabet.
LOWER_ORDER, ALPHABET = 2.0, 256.0
UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START = "\u0002"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without `://`."""
    at = F.locate("://", url)
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER_AZ, LOWER_AZ), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(texts: DataFrame, order: int) -> DataFrame:
    """One row for each character of `s`: the gram of that character and the `order` before it."""
    padded = F.concat(F.lit(START * order), F.col("s"))
    return texts.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("s")))).withColumn("gram", F.substring(padded, F.col("at"), F.lit(order + 1)))


def gram_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio): log-probability of a gram's last character as rejected less that as accepted.

    counts: gram, accepted, rejected. Each order's counts are sums of these over the grams with the same end, so
    the models of all orders come from one pass over the URLs.
    """
    table = counts
    p = {side: F.lit(1.0 / ALPHABET) for side in ("accepted", "rejected")}
    for k in range(order + 1):
        end = F.substring(F.col("gram"), order + 1 - k, k + 1)
        ends = counts.groupBy(end.alias(f"e{k}")).agg(F.sum("accepted").alias(f"ca{k}"), F.sum("rejected").alias(f"cr{k}"))
        context = F.substring(F.col(f"e{k}"), 1, k)
        totals = ends.groupBy(context.alias(f"c{k}")).agg(F.sum(f"ca{k}").alias(f"ta{k}"), F.sum(f"cr{k}").alias(f"tr{k}"))
        known = ends.withColumn(f"c{k}", context).join(totals, f"c{k}").drop(f"c{k}")
        table = table.withColumn(f"e{k}", end).join(known, f"e{k}")
        for side in p:
            c, t = F.col(f"c{side[0]}{k}"), F.col(f"t{side[0]}{k}")
            p[side] = (c + LOWER_ORDER * p[side]) / (t + LOWER_ORDER)
    return table.select("gram", (F.log(p["rejected"]) - F.log(p["accepted"])).alias("ratio"))


def calibrated(scored: DataFrame) -> DataFrame:
    """One row (threshold): the score above which labelled URLs are best called rejected; null if a class is missing.

    scored: label and score, a multiple of 1e-3, so that there are few distinct values whatever the input's size.
    """
    by_score = scored.where(F.col("label").isNotNull()).groupBy("score").agg(F.count_if(F.col("label") == "block").alias("r"), F.count_if(F.col("label") == "allow").alias("a"))
    up = W.orderBy("score")
    with_sums = by_score.select("score", F.sum("r").over(up).alias("r_at"), F.sum("a").over(up).alias("a_at"), F.sum("r").over(W.partitionBy()).alias("r_all"), F.sum("a").over(W.partitionBy()).alias("a_all"))
    balance = (F.col("r_all") - F.col("r_at")) / F.col("r_all") + F.col("a_at") / F.col("a_all")
    return with_sums.where("r_all > 0 and a_all > 0").agg(F.max_by("score", F.struct(balance, F.col("score"))).alias("threshold"))


def judge(pages: DataFrame, url_col: str = "url", rules=RULES, order: int = ORDER) -> DataFrame:
    """pages with host, path, rule, verdict and score (the length-normalised difference; null without a host and path)."""
    clash = {"host", "path", "rule", "verdict", "score", "__s", "__l"}
    rest = [c for c in pages.columns if c.lower() not in clash or c == url_col]
    host, path = split_url(F.col(f"`{url_col}`"))
    split = pages.select(*(F.col(f"`{c}`") for c in rest), host.alias("host"), path.alias("path"))
    split = split.withColumn("__r", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("rule", F.col("__r.rule")).withColumn("__l", F.col("__r.verdict")).drop("__r")
    split = split.withColumn("__s", F.translate(F.concat("host", "path"), "123456789", "000000000"))
    texts = split.groupBy(F.col("__s").alias("s"), F.col("__l").alias("label")).agg(F.count("*").alias("n")).where("s <> ''")
    scratch = Scratch(pages.sparkSession, "urls")
    texts = scratch.keep(texts, "texts")
    grams = _grams(texts, order)
    weight = {"accepted": "allow", "rejected": "block"}
    counts = grams.groupBy("gram").agg(*(F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(k) for k, v in weight.items()))
    ratios = scratch.keep(gram_ratios(scratch.keep(counts, "counts"), order), "ratios")
    by_text = scratch.keep(_grams(texts.select("s").distinct(), order).join(ratios, "gram").groupBy("s").agg(F.round(F.sum(F.round("ratio", 9)) / F.count("*"), 3).alias("score")), "scores")
    threshold = calibrated(texts.join(by_text, "s"))
    scores = by_text.withColumnRenamed("s", "__s").crossJoin(F.broadcast(threshold))  # one row
    out = split.join(scores, "__s", "left")
    model = F.when(F.col("score") > F.col("threshold"), "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("__l", model)).drop("__s", "__l", "threshold")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def _sql(order: int = ORDER) -> str:
    """The same as SQL, one pair of tables for each order of the models."""
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{}}{h + p}'" for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    rule, verdicts = fits.replace("{}", ""), " ".join(f"WHEN '{h + p}' THEN '{v}'" for v, h, p in RULES)
    tables, joins, a, r = [], [], f"{1 / ALPHABET!r}", f"{1 / ALPHABET!r}"
    for k in range(order + 1):
        tables.append(f"e{k} AS (SELECT substr(gram, {order + 1 - k}, {k + 1}) AS e, sum(a) AS a, sum(r) AS r FROM c GROUP BY 1), t{k} AS (SELECT substr(e, 1, {k}) AS x, sum(a) AS a, sum(r) AS r FROM e{k} GROUP BY 1)")
        joins.append(f"JOIN e{k} ON e{k}.e = substr(c.gram, {order + 1 - k}, {k + 1}) JOIN t{k} ON t{k}.x = substr(c.gram, {order + 1 - k}, {k})")
        a, r = f"((e{k}.a + {LOWER_ORDER} * {a}) / (t{k}.a + {LOWER_ORDER}))", f"((e{k}.r + {LOWER_ORDER} * {r}) / (t{k}.r + {LOWER_ORDER}))"
    return f"""WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
s AS (SELECT page_id, translate(raw, '{UPPER_AZ}', '{LOWER_AZ}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
w AS (SELECT *, CASE {rule} END AS rule, translate(host || path, '123456789', '000000000') AS s FROM s),
l AS (SELECT *, CASE rule {verdicts} END AS label FROM w),
x AS (SELECT s, label, count(*) AS n FROM l WHERE s <> '' GROUP BY ALL),
g AS (SELECT s, label, n, substr(repeat(chr(2), {order}) || s, CAST(unnest(range(1, length(s) + 1)) AS INT), {order + 1}) AS gram FROM x),
c AS (SELECT gram, CAST(sum(CASE WHEN label = 'allow' THEN n ELSE 0 END) AS DOUBLE) AS a, CAST(sum(CASE WHEN label = 'block' THEN n ELSE 0 END) AS DOUBLE) AS r FROM g GROUP BY gram),
{", ".join(tables)},
q AS (SELECT c.gram, ln({r}) - ln({a}) AS ratio FROM c {" ".join(joins)}),
z AS (SELECT d.s, round(sum(round(q.ratio, 9)) / count(*), 3) AS score FROM (SELECT DISTINCT s FROM x) d, LATERAL (SELECT substr(repeat(chr(2), {order}) || d.s, CAST(unnest(range(1, length(d.s) + 1)) AS INT), {order + 1}) AS gram) y JOIN q ON q.gram = y.gram GROUP BY d.s),
b AS (SELECT score, count(*) FILTER (WHERE label = 'block') AS r, count(*) FILTER (WHERE label = 'allow') AS a FROM x JOIN z USING (s) WHERE label IS NOT NULL GROUP BY score),
m AS (SELECT score, (sum(r) OVER () - sum(r) OVER o) / sum(r) OVER () + sum(a) OVER o / sum(a) OVER () AS balance, sum(r) OVER () AS rs, sum(a) OVER () AS asum FROM b WINDOW o AS (ORDER BY score)),
k AS (SELECT score AS threshold FROM m WHERE rs > 0 AND asum > 0 ORDER BY balance DESC, score DESC LIMIT 1)
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN z.score > (SELECT threshold FROM k) THEN 'block' ELSE 'allow' END) AS verdict, z.score FROM l LEFT JOIN z USING (s)"""


QUERIES = {"op8_url_filter": op8_url_filter}
ORACLES = {"op8_url_filter": _sql()}
