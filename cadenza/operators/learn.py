"""Learning one-variable thresholds from labels, and the classes that follow from them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.functions import finite
from cadenza.operators.numbering import numbered
from cadenza.shipping import ship

#: Ranges of values that cumulative sums are cut into.
PARTS = 1024


def confusion(rows: DataFrame, expected: Column, predicted: Column, by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp of two boolean columns, in one aggregation."""
    counts = [F.count_if(~expected & ~predicted).alias("tn"), F.count_if(~expected & predicted).alias("fp"), F.count_if(expected & ~predicted).alias("fn"), F.count_if(expected & predicted).alias("tp")]
    return rows.groupBy(*(by or [])).agg(*counts)


def balanced_accuracy(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    """Mean of specificity and sensitivity; 0 if a class is empty."""
    return F.when((tn + fp > 0) & (fn + tp > 0), (tn / (tn + fp) + tp / (fn + tp)) / 2.0).otherwise(0.0)


def best_upper_threshold(rows: DataFrame, value: str, positive: str, by: list[str] | None = None) -> DataFrame:
    """One row (for each group): the threshold t that best separates positives (value <= t), its balanced accuracy, and counts.

    Candidates lie midway between neighbouring distinct values; of equal ones the largest wins. All are judged from
    one cumulative sum over distinct values, not by a pass for each. Null threshold if there is no candidate or only
    one class.
    """
    by = by or []
    known = rows.where(finite(F.col(value)).isNotNull())
    by_value = known.groupBy(*by, F.col(value).alias("__x")).agg(F.count_if(F.col(positive)).alias("__p"), F.count_if(~F.col(positive)).alias("__n"))
    # PARTS ranges of values: sums run inside each, and start from those of the ranges before
    whole = W.partitionBy(*by)
    span = by_value.groupBy(*by).agg(F.min("__x").alias("__low"), F.max("__x").alias("__high"), F.sum("__p").alias("__ps"), F.sum("__n").alias("__ns"))
    ranged = (by_value.join(span, by) if by else by_value.crossJoin(F.broadcast(span))).withColumn("__part", F.floor(F.coalesce(F.try_divide((F.col("__x") - F.col("__low")) * (PARTS - 1), F.col("__high") - F.col("__low")), F.lit(0.0))))
    parts = ranged.groupBy(*by, "__part").agg(F.min("__x").alias("__first"), F.sum("__p").alias("__pp"), F.sum("__n").alias("__pn"))
    along = whole.orderBy("__part")
    before = lambda c: F.coalesce(F.sum(c).over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(*by, "__part", F.lead("__first").over(along).alias("__after"), before("__pp").alias("__p0"), before("__pn").alias("__n0"))
    up = W.partitionBy(*by, "__part").orderBy("__x")
    inside = ranged.join(starts, [*by, "__part"])
    sums = inside.select(*by, "__x", "__ps", "__ns", F.coalesce(F.lead("__x").over(up), F.col("__after")).alias("__next"), (F.col("__p0") + F.sum("__p").over(up)).alias("__tp"), (F.col("__n0") + F.sum("__n").over(up)).alias("__fp"))
    scored = sums.withColumn("threshold", F.when((F.col("__ps") > 0) & (F.col("__ns") > 0), (F.col("__x") + F.col("__next")) / 2.0))
    accuracy = balanced_accuracy(F.col("__ns") - F.col("__fp"), F.col("__fp"), F.col("__ps") - F.col("__tp"), F.col("__tp"))
    scored = scored.withColumn("balanced_accuracy", F.when(F.col("threshold").isNotNull(), F.round(accuracy, 12)))
    best = F.max_by(F.struct("threshold", "balanced_accuracy"), F.when(F.col("threshold").isNotNull(), F.struct("balanced_accuracy", "threshold")))
    return scored.groupBy(*by).agg(best.alias("b")).select(*by, "b.threshold", "b.balanced_accuracy")


def stratified_folds(rows: DataFrame, label: str, order: str, folds: int, part_rows: int = 4096) -> DataFrame:
    """rows with fold: round-robin within each label, in the order of a whole-number column. Folds are even and the same on every run."""
    out = numbered(rows, [label], F.floor(F.col(order) / part_rows), [order], "__n")
    return out.withColumn("fold", ((F.col("__n") - 1) % folds).cast("int")).drop("__n")


def cross_validated(rows: DataFrame, value: str, positive: str, folds: int) -> DataFrame:
    """Per fold the threshold fitted without it and the confusion counts on it; rows need the column fold. Without a threshold no row."""
    train = rows.select("fold", value, positive).withColumnRenamed("fold", "__own").withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).where("fold <> __own")
    fitted = best_upper_threshold(train, value, positive, ["fold"]).where("threshold is not null")
    tested = rows.join(fitted.select("fold", "threshold"), "fold")
    return confusion(tested, F.col(positive), F.col(value) <= F.col("threshold"), ["fold", "threshold"])


def fold_count(rows: DataFrame, positive: str, most: int = 10) -> int:
    """Folds that leave each class in every one: the smaller class, `most` at most; 0 if a class is missing."""
    n = rows.agg(F.count_if(F.col(positive)).alias("p"), F.count_if(~F.col(positive)).alias("n")).first()
    return min(most, n["p"], n["n"])


def pooled(by_fold: DataFrame) -> DataFrame:
    """One row over cross_validated's folds: confusion counts, accuracies, and the spread of the thresholds."""
    names = ("tn", "fp", "fn", "tp")
    sums = by_fold.agg(F.count("*").alias("folds"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names), F.min("threshold").alias("threshold_min"), F.percentile("threshold", 0.5).alias("threshold_median"), F.max("threshold").alias("threshold_max"))
    right, all_rows = F.col("tn") + F.col("tp"), sum((F.col(c) for c in names[1:]), F.col("tn"))
    return sums.withColumns({"balanced_accuracy": balanced_accuracy(*(F.col(c) for c in names)), "accuracy": F.try_divide(right, all_rows)})


def classified(value: Column, threshold: Column, margin: float, decision: Column) -> dict[str, Column]:
    """Class of a row, where it comes from, the class that the rule alone suggests, and the distance to the threshold.

    A human decision wins; within the margin (inclusive) a row goes to review; else it is kept up to the threshold.
    """
    distance = value - threshold
    rule = F.when(value <= threshold, "keep").otherwise("drop")
    near = F.abs(distance) <= margin
    return {
        "classification": F.coalesce(decision, F.when(near, "review").otherwise(rule)),
        "classification_source": F.when(decision.isNotNull(), "human").when(near, "rule_review_band").otherwise("yaw_rule"),
        "suggested": rule,
        "distance": distance,
    }


def gaze_risk(residual: Column, horizontal: Column, vertical: Column, vertical_reference: Column) -> Column:
    """The larger of both relative deviations; null without a residual."""
    return F.when(residual.isNotNull(), F.greatest(residual / horizontal, vertical / vertical_reference))


#: Frames times slopes that a step of slope_spreads holds.
HELD = 4 << 20


def slope_spreads(rows: DataFrame, segment: str, h: str, yaw: str, low: float, high: float, steps: int, q: float = 0.95) -> DataFrame:
    """(segment, spreads): for each slope of the grid the q quantile of |h - slope * yaw| over the segment's frames.

    A segment's frames are shuffled once and meet the whole grid in one task, as a matrix of bounded size at a time.
    Segments are as long as a profile's longest interval, or a recording.
    """
    ship(rows.sparkSession)
    slopes = low + np.arange(steps) * ((high - low) / (steps - 1))

    def run(table: pa.Table) -> pa.Table:
        x, y = (table.column(c).to_numpy()[:, None] for c in (h, yaw))
        width = max(1, HELD // len(x))
        spreads = np.concatenate([np.quantile(np.abs(x - slopes[None, i : i + width] * y), q, axis=0) for i in range(0, steps, width)])
        return pa.table({segment: table.column(segment)[:1], "spreads": pa.array([spreads])})

    both = rows.select(segment, finite(F.col(h)).alias(h), finite(F.col(yaw)).alias(yaw)).dropna()
    return both.groupBy(segment).applyInArrow(run, f"{segment} {dict(rows.dtypes)[segment]}, spreads array<double>")


def slope_search(rows: DataFrame, segment: str, h: str, yaw: str, low: float, high: float, steps: int) -> DataFrame:
    """One row: the slope of the grid with the smallest median, over segments, of the 95th percentile of |h - slope * yaw|; the first of equals."""
    spread = slope_spreads(rows, segment, h, yaw, low, high, steps).select(F.posexplode("spreads").alias("step", "p95"))
    loss = spread.groupBy("step").agg(F.round(F.percentile("p95", 0.5), 9).alias("loss"))
    best = loss.agg(F.min_by(F.struct("step", "loss"), F.struct("loss", "step")).alias("b")).select("b.*")
    return best.select("step", (F.lit(low) + F.col("step") * F.lit((high - low) / (steps - 1))).alias("slope"), "loss")
