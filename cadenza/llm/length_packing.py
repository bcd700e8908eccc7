"""Packing by optimal length buckets.

Lengths are gathered into one global histogram. A dynamic program over it chooses up to BUCKETS boundaries so that
padding every document to the boundary of its bucket costs the least; boundaries lie on a grid that is exact up to
2 * 2**GRID lengths and keeps GRID leading bits beyond, so that the histogram on the driver has a few thousand rows whatever
the input. Inside a bucket documents are taken in the order of the MD5 of their ids and fill batches of budget // boundary places.
Positions in a bucket come from row numbers in small parts of it (those whose MD5 begins alike) and the sizes of the parts
before, so no bucket, however large, is numbered by one task, and the result doesn't depend on the parts.

Nulls and edges: a null text has the length of its end alone, 1; a document longer than the budget is a batch of its
own, whole; null ids and repeated rows are packed like others; an empty table gives an empty result; input columns
that clash with result columns are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.llm._shared import Scratch

BUCKETS, BUDGET, GRID = 16, 32_768, 8
ROWS_PER_PART = 4096
RESULT = ("bucket", "padded", "batch", "slot")


def on_grid(length: Column) -> Column:
    """The least grid value that is not below a length."""
    bits = F.length(F.bin(F.greatest(length, F.lit(1)))) - 1  # exact, where a logarithm may round
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), bits - GRID)).cast("long")
    return F.ceil(length / step).cast("long") * step


def boundaries(values: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int = BUCKETS) -> tuple[list[int], int]:
    """Boundaries (ascending; the last is the largest value) that minimise padding, and that padding.

    values: ascending grid values; counts and sums: documents there and their lengths. Of equal choices the one with
    the smaller boundaries is taken.
    """
    n = len(values)
    if not n:
        return [], 0
    values, total, length = values.astype(np.int64), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), np.concatenate([[0], np.cumsum(sums)]).astype(np.int64)
    best = np.concatenate([[0], values * total[1:] - length[1:]])  # one bucket for the first j values
    cuts = [np.zeros(n + 1, np.int64)]
    for _ in range(1, min(buckets, n)):
        new, cut = best.copy(), np.full(n + 1, -1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + values[j - 1] * (total[j] - total[:j]) - (length[j] - length[:j])
            i = int(cost.argmin())
            if cost[i] < new[j]:
                new[j], cut[j] = cost[i], i
        best = new
        cuts.append(cut)
    out, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        if cut[j] < 0:  # one bucket more didn't help here
            continue
        out.append(int(values[j - 1]))
        j = int(cut[j])
    return out[::-1], int(best[n])


def histogram(lengths: DataFrame, length_col: str = "n_tokens") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = lengths.where(F.col(length_col).isNotNull()).groupBy(on_grid(F.col(length_col)).alias("g")).agg(F.count("*").alias("n"), F.sum(length_col).alias("s")).orderBy("g").collect()
    return tuple(np.array([r[k] for r in rows], np.int64) for k in ("g", "n", "s"))


def pack(lengths: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """lengths with bucket, padded (its boundary), batch (numbered within the bucket) and slot (place in the batch).

    Reads its input twice; give it a narrow table that is cheap to read.
    """
    values, counts, sums = histogram(lengths, length_col)
    chosen, _ = boundaries(values, counts, sums, buckets)
    bucket, padded = F.lit(None).cast("int"), F.lit(None).cast("long")
    for k, b in reversed(list(enumerate(chosen))):
        bucket = F.when(F.col(length_col) <= b, F.lit(k)).otherwise(bucket)
        padded = F.when(F.col(length_col) <= b, F.lit(b).cast("long")).otherwise(padded)
    h = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    digits, n = 0, int(counts.sum())
    while n > ROWS_PER_PART * 16**digits:
        digits += 1
    rest = [c for c in lengths.columns if c not in RESULT]
    rows = lengths.select(*rest, bucket.alias("bucket"), padded.alias("padded"), h.alias("__h"), F.substring(h, 1, digits).alias("__part"))
    part_sizes = rows.groupBy("bucket", "__part").agg(F.count("*").alias("n"))
    before = part_sizes.withColumn("__before", F.sum("n").over(W.partitionBy("bucket").orderBy("__part").rowsBetween(W.unboundedPreceding, -1))).select(F.col("bucket").alias("__b"), F.col("__part").alias("__p"), F.coalesce("__before", F.lit(0)).alias("__before"))
    numbered = rows.withColumn("__r", F.row_number().over(W.partitionBy("bucket", "__part").orderBy("__h", id_col, length_col)))
    placed = numbered.join(before, F.col("bucket").eqNullSafe(F.col("__b")) & (F.col("__part") == F.col("__p")))
    at, room = F.col("__before") + F.col("__r") - 1, F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("padded")))
    return placed.select(*rest, "bucket", "padded", F.floor(at / room).alias("batch"), (at % room).cast("int").alias("slot"))


def token_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens): words and one end."""
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(id_col, (words + 1).cast("long").alias("n_tokens"))


def pack_documents(docs: DataFrame, label: str = "packing") -> DataFrame:
    scratch = Scratch(docs.sparkSession, label)
    return pack(scratch.keep(token_lengths(docs), "lengths"))


def op3_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _sql() -> str:
    """The same as SQL: the histogram, one step of the program for each bucket more, the cuts traced back, and places by row number."""
    steps = ["b1 AS (SELECT j, v * t - l AS cost, 0 AS cut FROM g)"]
    for k in range(2, BUCKETS + 1):
        steps.append(f"""m{k} AS (SELECT g.j, min(o.cost + g.v * (g.t - i.t) - (g.l - i.l)) AS cost, arg_min(i.j, (o.cost + g.v * (g.t - i.t) - (g.l - i.l)) * 100000 + i.j) AS cut FROM g JOIN g0 i ON i.j < g.j JOIN (SELECT j, cost FROM b{k - 1} UNION ALL SELECT 0, 0) o ON o.j = i.j GROUP BY g.j),
b{k} AS (SELECT j, CASE WHEN m.cost < o.cost THEN m.cost ELSE o.cost END AS cost, CASE WHEN m.cost < o.cost THEN m.cut ELSE -1 END AS cut FROM m{k} m JOIN b{k - 1} o USING (j))""")
    trace = [f"e{BUCKETS + 1} AS (SELECT max(j) AS spot, CAST(NULL AS BIGINT) AS taken FROM g)"]
    for k in range(BUCKETS, 0, -1):
        trace.append(f"e{k} AS (SELECT CASE WHEN b.cut >= 0 THEN b.cut ELSE e.spot END AS spot, CASE WHEN b.cut >= 0 THEN e.spot END AS taken FROM e{k + 1} e JOIN b{k} b ON b.j = e.spot)")
    taken = " UNION ALL ".join(f"SELECT taken FROM e{k}" for k in range(1, BUCKETS + 1))
    step = f"(1 << greatest(0, length(bin(n_tokens)) - 1 - {GRID}))"
    return rf"""WITH d AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS n_tokens FROM documents),
h AS (SELECT CAST((n_tokens + {step} - 1) // {step} * {step} AS BIGINT) AS v, count(*) AS n, sum(n_tokens) AS s FROM d GROUP BY ALL),
g AS (SELECT row_number() OVER (ORDER BY v) AS j, v, CAST(sum(n) OVER (ORDER BY v) AS BIGINT) AS t, CAST(sum(s) OVER (ORDER BY v) AS BIGINT) AS l FROM h),
g0 AS (SELECT j, t, l FROM g UNION ALL SELECT 0, 0, 0),
{", ".join(steps)}, {", ".join(trace)},
c AS (SELECT g.v AS padded, CAST(row_number() OVER (ORDER BY g.v) - 1 AS INT) AS bucket, lag(g.v, 1, 0) OVER (ORDER BY g.v) AS above FROM ({taken}) x JOIN g ON g.j = x.taken),
p AS (SELECT d.*, bucket, padded, row_number() OVER (PARTITION BY bucket ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, n_tokens) - 1 AS spot, greatest(1, {BUDGET} // padded) AS room FROM d JOIN c ON d.n_tokens > above AND d.n_tokens <= padded)
SELECT doc_id, CAST(n_tokens AS BIGINT) AS n_tokens, bucket, padded, CAST(spot // room AS BIGINT) AS batch, CAST(spot % room AS INT) AS slot FROM p"""


QUERIES = {"op3_length_packing": op3_length_packing}
ORACLES = {"op3_length_packing": _sql()}
