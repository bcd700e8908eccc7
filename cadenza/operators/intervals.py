"""Measuring, scoring and ranking intervals of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.functions import clip, finite, half_even
from cadenza.operators.numbering import numbered


def median(x: Column) -> Column:
    """Interpolated median of the finite values; null if there are none."""
    return F.percentile(finite(x), F.lit(0.5))


def quantile(x: Column, q: float) -> Column:
    return F.percentile(finite(x), F.lit(q))


#: Rows that one task may order whole, and on either side of a quantile the share of larger tables that it does.
SMALL, MARGIN, ACCURACY = 20_000, 3e-4, 10_000


def global_quantile(rows: DataFrame, x: Column, q: float, out: str) -> DataFrame:
    """One row: the interpolated q quantile of the finite values of a whole table, exactly.

    Sketches bound the quantile from both sides with a rank error of 1 / ACCURACY; what lies below is counted, and only the
    values between the bounds, about 2 * MARGIN of the table, are put in order. Null without values.
    """
    known = rows.select(finite(x).cast("double").alias("x")).where("x IS NOT NULL")
    at = [max(0.0, q - MARGIN), min(1.0, q + MARGIN)]
    sketch = known.agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"), F.percentile_approx("x", at, ACCURACY).alias("b"))
    few = F.col("n") <= SMALL
    bounds = sketch.select("n", F.when(few, F.col("least")).otherwise(F.get("b", F.lit(0))).alias("low"), F.when(few, F.col("most")).otherwise(F.get("b", F.lit(1))).alias("high"))  # one row
    both = known.crossJoin(F.broadcast(bounds)).where("x <= high")
    counts = both.groupBy(F.when(F.col("x") >= F.col("low"), F.col("x")).alias("x")).agg(F.count("*").alias("c"), F.first("n").alias("n"))  # below the bounds: one null
    upto = counts.withColumn("upto", F.sum("c").over(W.orderBy(F.col("x").asc_nulls_first())))
    place = F.lit(float(q)) * (F.col("n") - 1)
    first = lambda k: F.min(F.when(F.col("upto") > k, F.col("x")))
    ends = upto.agg(first(F.floor(place)).alias("a"), first(F.ceil(place)).alias("b"), F.first(place - F.floor(place)).alias("f"))
    return ends.select((F.col("a") + (F.col("b") - F.col("a")) * F.col("f")).alias(out))


def global_quantiles(rows: DataFrame, wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """One row with a column for each (values, q)."""
    found = [global_quantile(rows, x, q, name) for name, (x, q) in wanted.items()]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), found)


def ratio(flag: Column) -> Column:
    """Share of rows where flag is set; 0 without rows."""
    return F.coalesce(F.avg(F.coalesce(flag, F.lit(False)).cast("double")), F.lit(0.0))


def tag_intervals(frames: DataFrame, intervals: DataFrame, key: str, idx: str = "idx") -> DataFrame:
    """frames with the interval (start_index, end_index_exclusive) that holds them.

    Intervals are expanded to their rows and joined by equality, on both columns: a range condition on the key alone
    would compare each frame with every interval of its source.
    """
    rows = intervals.withColumn("__i", F.explode(F.sequence("start_index", F.col("end_index_exclusive") - 1))).withColumnRenamed(key, "__k")
    return frames.join(rows, (F.col(key) == F.col("__k")) & (F.col(idx) == F.col("__i"))).drop("__i", "__k")


def shot(scale: Column) -> Column:
    """Framing by median face scale."""
    return F.when(scale.isNull(), "unknown").when(scale >= 0.20, "close").when(scale >= 0.15, "medium").otherwise("wide")


def composite(raw: Column, face: Column, pose: Column, head: Column, gaze: Column, unblocked: Column) -> Column:
    """100 times the weighted sum of an interval's coverages."""
    return 100.0 * (0.30 * raw + 0.20 * face + 0.10 * pose + 0.20 * head + 0.15 * gaze + 0.05 * unblocked)


def closeness(terms: list[tuple[Column, float | Column]]) -> Column:
    """Mean over all known values of all terms of 1 - |value| / limit, within [0, 1]; 0 without any. Not a mean of means."""
    parts = [clip(1.0 - F.abs(finite(x)) / (limit if isinstance(limit, Column) else F.lit(float(limit))), 0.0, 1.0) for x, limit in terms]
    total = sum((F.coalesce(F.sum(p), F.lit(0.0)) for p in parts[1:]), F.coalesce(F.sum(parts[0]), F.lit(0.0)))
    known = sum((F.count(p) for p in parts[1:]), F.count(parts[0]))
    return F.coalesce(F.try_divide(total, known), F.lit(0.0))


def ranked(segments: DataFrame, partition: list[str], score: str = "score", source: str = "source_id", start: str = "target_start_s", end: str = "target_end_s", bin_width: float = 0.01) -> DataFrame:
    """segments with rank (score descending, then source and start) and a segment_id from source and milliseconds.

    Segments are ranked inside bins of the score, so that no task holds all segments of a profile.
    """
    name = F.format_string("%s_%010d_%010d", F.col(source).cast("string"), half_even(F.col(start) * 1000), half_even(F.col(end) * 1000))
    out = numbered(segments, partition, -F.floor(F.col(score) / bin_width), [F.desc(score), source, start], "rank")
    return out.withColumn("segment_id", name)
