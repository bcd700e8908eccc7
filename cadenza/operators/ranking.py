"""Best candidates, margins and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.functions import wrap_degrees


def torso_down(points: Column) -> Column:
    """How far the torso points down: the y part of the unit vector from the shoulders (11, 12) to the hips (23, 24); null if it is no longer than 1e-6."""
    mid = lambda axis, a, b: (F.get(points, F.lit(a))[axis] + F.get(points, F.lit(b))[axis]) / 2
    dx, dy = mid("x", 23, 24) - mid("x", 11, 12), mid("y", 23, 24) - mid("y", 11, 12)
    return F.when(F.hypot(dx, dy) > 1e-6, dy / F.hypot(dx, dy))


def orientation_score(face_score: Column, pose_score: Column, roll: Column, down: Column, has_face: Column, has_pose: Column) -> Column:
    """How plausible a rotation is: scores of what was found in it, uprightness of head and torso, less penalties for what was not."""
    upright = F.coalesce(F.greatest(F.lit(0.0), 1.0 - F.abs(wrap_degrees(roll)) / 45.0), F.lit(0.0))
    hanging = F.coalesce(F.greatest(F.lit(0.0), down), F.lit(0.0))
    lost = F.when(has_face, 0.0).otherwise(2.0) + F.when(has_pose, 0.0).otherwise(0.5)
    return 4.0 * F.coalesce(face_score, F.lit(0.0)) + 1.5 * F.coalesce(pose_score, F.lit(0.0)) + upright + hanging - lost


def best_two(rows: DataFrame, key: str, score: str, position: str) -> DataFrame:
    """key, best (position), best_score, second_score and gap. Ties keep the order of position. Only two candidates of each task are shuffled."""
    w = W.partitionBy(key).orderBy(F.desc(score), position)
    two = rows.withColumn("__r", F.row_number().over(w)).where("__r <= 2")
    at = lambda n, c: F.max(F.when(F.col("__r") == n, F.col(c)))
    return two.groupBy(key).agg(at(1, position).alias("best"), at(1, score).alias("best_score"), at(2, score).alias("second_score")).withColumn("gap", F.col("best_score") - F.col("second_score"))


def confidence(overridden: Column, found: Column, gap: Column, margin: float = 0.75) -> Column:
    return F.when(overridden, "visual_verified").when(found & (gap >= margin), "high").otherwise("review")


def best_of(rows: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The row of each key with the largest score; of equal ones the first by tie."""
    return rows.withColumn("__r", F.row_number().over(W.partitionBy(key).orderBy(F.desc(score), tie))).where("__r = 1").drop("__r")


def top_entries(map_col: Column, n: int) -> Column:
    """The n entries of a map with the largest values, as structs (key, value); equal values by key."""
    entries = F.transform(F.map_entries(map_col), lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("k")))
    return F.transform(F.slice(F.array_sort(entries), 1, n), lambda e: F.struct(e["k"].alias("key"), (-e["v"]).alias("value")))


def review_order(rows: DataFrame, by: str, position: str) -> DataFrame:
    """rows in the order of a review queue: nearest to the boundary, highest gaze risk (unknown last), or rank."""
    orders = {"boundary": F.abs(F.coalesce(F.col("distance"), F.lit(0.0))).asc(), "gaze": F.col("risk").desc_nulls_last(), "rank": F.col("rank").asc()}
    return rows.orderBy(orders[by], F.col(position).asc())
