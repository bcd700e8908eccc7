"""Row numbers in the order of whole tables and large groups, without one task for each group.

A part is a value that never decreases along the order (a bin of the first sort key, a prefix of a hash). Rows are numbered
inside (group, part); the sizes of the parts before come from one count. The result is that of one window over the
group, and doesn't depend on how fine the parts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def numbered(rows: DataFrame, groups: list[str], part: Column, order: list, out: str) -> DataFrame:
    """rows with out: 1 for the first row of each group in the order (part, *order), and so on. Null parts come first."""
    marked = rows.withColumn("__part", part)
    sizes = marked.groupBy(*groups, "__part").agg(F.count("*").alias("__n"))
    ahead = F.sum("__n").over(W.partitionBy(*groups).orderBy(F.col("__part").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1))
    before = sizes.select(*(F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)), F.col("__part").alias("__p"), F.coalesce(ahead, F.lit(0)).alias("__before"))
    same = F.col("__part").eqNullSafe(F.col("__p"))
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    within = marked.withColumn("__r", F.row_number().over(W.partitionBy(*groups, "__part").orderBy(*order)))
    return within.join(before, same).withColumn(out, (F.col("__before") + F.col("__r")).cast("long")).drop("__part", "__p", "__before", "__r", *(f"__g{i}" for i in range(len(groups))))
