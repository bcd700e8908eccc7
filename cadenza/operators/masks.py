"""Boolean masks over ordered rows: criteria, breaks, dilation, gap filling, runs and their splitting.

A timeline is the rows of one `key`, ordered by a whole-number column `idx` without holes. All windows share that
partitioning and order, so a chain of these operators shuffles and sorts once. Keys are sources: their lengths are
bounded by the recording, and Spark's windows spill.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.functions import holds, least_known


@dataclass(frozen=True)
class Profile:
    """Thresholds of a selection profile."""

    name: str
    min_seconds: float
    target_seconds: float
    max_seconds: float
    fill_gap_seconds: float
    cut_buffer_seconds: float
    min_face_score: float
    max_rigidity: float
    max_pitch: float
    max_yaw: float
    max_roll: float
    max_gaze_horizontal: float
    min_gaze_vertical: float
    max_gaze_vertical: float
    min_face_scale: float
    min_center_x: float
    max_center_x: float
    min_center_y: float
    max_center_y: float
    eye_open_fraction: float
    min_raw_ratio: float


# The three profiles' thresholds, in the order of the fields.
PROFILES = (
    Profile("loose", 6, 16, 24, 0.75, 0.125, 0.50, 0.025, 30, 50, 25, 0.20, -0.10, 0.15, 0.06, -0.05, 1.05, -0.05, 0.90, 0.25, 0.72),
    Profile("standard", 8, 14, 20, 0.50, 0.25, 0.90, 0.015, 24, 40, 18, 0.14, -0.06, 0.12, 0.10, 0.05, 0.95, 0.05, 0.80, 0.35, 0.84),
    Profile("strict", 8, 12, 16, 0.25, 0.25, 0.99, 0.011, 18, 28, 13, 0.10, -0.03, 0.08, 0.13, 0.15, 0.85, 0.12, 0.72, 0.45, 0.92),
)
# Jumps between neighbouring frames that end a run.
CENTER_JUMP, LOG_SCALE_JUMP, PITCH_JUMP, YAW_JUMP, ROLL_JUMP = 0.08, 0.25, 15.0, 20.0, 20.0


def profiles(spark: SparkSession) -> DataFrame:
    """The profiles as a dimension of three rows."""
    names = [f.name for f in fields(Profile)]
    return spark.createDataFrame([tuple(p.name if n == "name" else float(getattr(p, n)) for n in names) for p in PROFILES], ", ".join(f"{n} {'string' if n == 'name' else 'double'}" for n in names))


def along(key: str | list[str], idx: str = "idx"):
    return W.partitionBy(key).orderBy(idx)


def eye_openness(left: Column, right: Column) -> Column:
    return least_known(left, right)


def eye_open(openness: Column, reference: Column, fraction: Column) -> Column:
    """Openness is known and, where there is a positive reference, reaches its share of that."""
    return holds(openness.isNotNull() & (F.coalesce(reference, F.lit(0.0)) <= 0) | (openness >= reference * fraction))


def criteria(c, p, eye: Column) -> dict[str, Column]:
    """The eleven named criteria. c(name) gives a measurement, p(name) a threshold; a missing measurement fails."""
    box = c("center_x").between(p("min_center_x"), p("max_center_x")) & c("center_y").between(p("min_center_y"), p("max_center_y"))
    return {
        "face": holds(c("face_detected")),
        "face_score": holds(c("face_score") >= p("min_face_score")),
        "rigidity": holds(c("rigidity") <= p("max_rigidity")),
        "pitch": holds(F.abs(c("pitch")) <= p("max_pitch")),
        "yaw": holds(F.abs(c("yaw")) <= p("max_yaw")),
        "roll": holds(F.abs(c("roll")) <= p("max_roll")),
        "gaze_horizontal": holds(F.abs(c("gaze_h")) <= p("max_gaze_horizontal")),
        "gaze_vertical": holds(c("gaze_v").between(p("min_gaze_vertical"), p("max_gaze_vertical"))),
        "eye_open": eye,
        "face_scale": holds(c("face_scale") >= p("min_face_scale")),
        "framing": holds(box),
    }


def all_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns)


def differences(df: DataFrame, key: str, values: list[str], idx: str = "idx") -> DataFrame:
    """df with d_<value>: the change from the row before (null at the first)."""
    w = along(key, idx)
    return df.withColumns({f"d_{v}": F.col(v) - F.lag(v).over(w) for v in values})


def hard_breaks(df: DataFrame, key: str, idx: str = "idx", detected: str = "face_detected", x: str = "center_x", y: str = "center_y", scale: str = "face_scale", angles: tuple[str, str, str] = ("pitch", "yaw", "roll"), limits: tuple[float, ...] = (CENTER_JUMP, LOG_SCALE_JUMP, PITCH_JUMP, YAW_JUMP, ROLL_JUMP)) -> DataFrame:
    """df with hard_break: both this row and the one before are detected and something jumps between them."""
    w = along(key, idx)
    step = lambda v: F.col(v) - F.lag(v).over(w)
    log_scale = F.when(F.col(scale).isNotNull(), F.log(F.greatest(F.col(scale), F.lit(1e-6))))
    jumps = [F.hypot(step(x), step(y)) > limits[0], F.abs(log_scale - F.lag(log_scale).over(w)) > limits[1]]
    jumps += [F.abs(step(a)) > limit for a, limit in zip(angles, limits[2:], strict=True)]
    both = holds(F.col(detected)) & holds(F.lag(detected).over(w))
    return df.withColumn("hard_break", both & reduce(lambda a, b: a | b, map(holds, jumps)))


def dilate(df: DataFrame, key: str | list[str], flag: str, radius: int | Column, out: str, idx: str = "idx") -> DataFrame:
    """df with out: flag is set within `radius` rows. A column as radius is compared with the distance to the nearest set row."""
    w = along(key, idx)
    if isinstance(radius, int):
        spread = F.max(F.col(flag)).over(w.rowsBetween(-radius, radius)) if radius > 0 else F.col(flag)
        return df.withColumn(out, holds(spread))
    at = F.when(F.col(flag), F.col(idx))
    before = F.last(at, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    after = F.first(at, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return df.withColumn(out, holds(F.col(idx) - before <= radius) | holds(after - F.col(idx) <= radius) | holds(F.col(flag)))


def fill_gaps(df: DataFrame, key: str | list[str], flag: str, blocker: str | None, longest: int | Column, out: str, idx: str = "idx") -> DataFrame:
    """df with out: flag, with runs of false of at most `longest` rows set if true rows stand on both sides and no row is blocked; blocked rows are false."""
    keys, w = [key] if isinstance(key, str) else list(key), along(key, idx)
    blocked = holds(F.col(blocker)) if blocker else F.lit(False)
    base = df.withColumn("__v", holds(F.col(flag)) & F.lit(True))
    base = base.withColumn("__run", F.sum(F.coalesce((F.col("__v") != F.lag("__v").over(w)).cast("int"), F.lit(0))).over(w))
    run = W.partitionBy(*keys, "__run")
    last = F.max("__run").over(W.partitionBy(*keys))
    inner = (F.col("__run") > 0) & (F.col("__run") < last)
    short = (F.count("*").over(run) <= longest) & ~F.max(blocked).over(run)
    return base.withColumn(out, ((F.col("__v") | (inner & short)) & ~blocked)).drop("__v", "__run")


def tag_runs(df: DataFrame, key: str | list[str], flag: str, idx: str = "idx") -> DataFrame:
    """The rows where flag is set, with run_id: the same for rows of one maximal run."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.where(F.col(flag)).withColumn("run_id", F.col(idx) - F.row_number().over(W.partitionBy(*keys).orderBy(idx)))


def true_runs(df: DataFrame, key: str | list[str], flag: str, idx: str = "idx") -> DataFrame:
    """Half-open maximal runs of set rows: key, start_index, end_index_exclusive."""
    keys = [key] if isinstance(key, str) else list(key)
    runs = tag_runs(df, key, flag, idx).groupBy(*keys, "run_id").agg(F.min(idx).cast("long").alias("start_index"), (F.max(idx) + 1).cast("long").alias("end_index_exclusive"))
    return runs.drop("run_id")


def split_runs(runs: DataFrame, shortest: int, target: int, longest: int) -> DataFrame:
    """Runs cut into pieces near `target` rows, none longer than `longest` if that can be, none shorter than `shortest`."""
    if not 0 < shortest <= target <= longest:
        raise ValueError("lengths must be positive and ascend")
    length = F.col("end_index_exclusive") - F.col("start_index")
    pieces = F.greatest(F.lit(1), F.bround(length / F.lit(float(target)), 0).cast("long"), F.ceil(length / F.lit(float(longest))))
    n = F.least(pieces, F.floor(length / F.lit(float(shortest))))
    rows = runs.where(length >= shortest).withColumn("__n", n).withColumn("__len", length).withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    cut = lambda i: F.col("start_index") + F.bround(i * F.col("__len") / F.col("__n"), 0).cast("long")
    out = rows.withColumn("__a", cut(F.col("__i"))).withColumn("__b", cut(F.col("__i") + 1)).where(F.col("__b") - F.col("__a") >= shortest)
    keep = [c for c in runs.columns if c not in ("start_index", "end_index_exclusive")]
    return out.select(*keep, F.col("__a").alias("start_index"), F.col("__b").alias("end_index_exclusive"))


def tag_pieces(df: DataFrame, key: str | list[str], flag: str, shortest: int | Column, target: int | Column, longest: int | Column, idx: str = "idx") -> DataFrame:
    """The rows of df that lie in a piece of split_runs(true_runs(df)), with that piece's start_index and end_index_exclusive.

    A row's piece follows from its place in its run, so rows are neither joined with intervals nor shuffled again.
    Lengths may be columns that are the same for all rows of a key.
    """
    if isinstance(shortest, int) and not 0 < shortest <= target <= longest:
        raise ValueError("lengths must be positive and ascend")
    shortest, target, longest = ((F.lit(x) if isinstance(x, int) else x).cast("double") for x in (shortest, target, longest))
    run = W.partitionBy(*([key] if isinstance(key, str) else key), "run_id")
    rows = tag_runs(df, key, flag, idx).withColumn("__len", F.count("*").over(run)).withColumn("__a", F.min(idx).over(run)).where(F.col("__len") >= shortest)
    n = F.greatest(F.lit(1), F.bround(F.col("__len") / target, 0).cast("long"), F.ceil(F.col("__len") / longest))
    rows = rows.withColumn("__n", F.least(n, F.floor(F.col("__len") / shortest))).withColumn("__o", F.col(idx) - F.col("__a"))
    cut = lambda i: F.bround(i * F.col("__len") / F.col("__n"), 0).cast("long")
    near = F.floor(F.col("__o") * F.col("__n") / F.col("__len"))  # the piece, or one beside it: cuts are rounded
    piece = F.when(cut(near + 1) <= F.col("__o"), near + 1).when(cut(near) > F.col("__o"), near - 1).otherwise(near)
    rows = rows.withColumn("__i", piece).withColumn("start_index", (F.col("__a") + cut(F.col("__i"))).cast("long")).withColumn("end_index_exclusive", (F.col("__a") + cut(F.col("__i") + 1)).cast("long"))
    return rows.where(F.col("end_index_exclusive") - F.col("start_index") >= shortest).drop("run_id", "__len", "__a", "__n", "__o", "__i")
