"""Inventories and catalogs: snapshots, incremental reuse, content groups, deduplication and validation joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.numbering import numbered


def stable(after: DataFrame, before: DataFrame, key: str, fields: list[str], out: str = "stable") -> DataFrame:
    """after with out: whether the row is in the earlier snapshot with the same fields. New rows are unstable, vanished ones are gone."""
    was = before.select(F.col(key), F.struct(*fields).alias("__was"))
    return after.join(was, key, "left").withColumn(out, F.struct(*fields).eqNullSafe(F.col("__was"))).drop("__was")


def reusable(scan: DataFrame, previous: DataFrame, identity: list[str], cached: list[str], ok: str) -> tuple[DataFrame, DataFrame]:
    """Rows of scan whose identity is unchanged since a successful previous run, with its cached columns; and the others, which need work."""
    good = previous.where(F.coalesce(F.col(ok), F.lit(False))).select(*identity, *cached).dropDuplicates(identity)
    return scan.join(good, identity), scan.join(good, identity, "left_anti")


def signature(*parts: Column) -> Column:
    """sha256 of the parts, joined by zero bytes."""
    return F.sha2(F.concat_ws("\u0000", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def content_groups(items: DataFrame, content: list[str], name: str) -> DataFrame:
    """One row for each content: canonical (the first name), aliases (the other names, ascending) and members."""
    grouped = items.groupBy(*content).agg(F.array_sort(F.collect_list(name)).alias("__names"))
    return grouped.select(*content, F.get("__names", F.lit(0)).alias("canonical"), F.slice("__names", 2, F.greatest(F.size("__names"), F.lit(1))).alias("aliases"), F.size("__names").cast("long").alias("members"))


def duplicate_totals(items: DataFrame, content: list[str], size: str) -> DataFrame:
    """One row: groups of more than one member, members beyond the first of each, and their bytes. Grouped and summed without lists."""
    groups = items.groupBy(*content).agg(F.count("*").alias("n"), F.max(size).alias("__size")).where("n > 1")
    return groups.agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"), F.coalesce(F.sum((F.col("n") - 1) * F.col("__size")), F.lit(0)).cast("long").alias("duplicate_bytes"))


def first_of(items: DataFrame, key: Column, position: str) -> DataFrame:
    """The row of each key that comes first, by position; the key's partial minimum goes through the shuffle, not its rows."""
    fields = [F.col(c) for c in items.columns]
    return items.groupBy(key.alias("__key")).agg(F.min_by(F.struct(*fields), F.col(position)).alias("__row")).select("__row.*")


def canonical(items: DataFrame, fingerprint: str, position: str, name: str) -> DataFrame:
    """items with canonical, the name of the first item with the same fingerprint, and duplicate_of (null for that one)."""
    first = items.groupBy(fingerprint).agg(F.min_by(name, position).alias("canonical"))
    return items.join(first, fingerprint).withColumn("duplicate_of", F.when(F.col(name) != F.col("canonical"), F.col("canonical")))


def fingerprint(rows: DataFrame, key: str, idx: str, values: list[str]) -> DataFrame:
    """(key, fingerprint): a digest of each timeline's values in order; equal timelines have equal digests."""
    cells = F.concat_ws(",", *(F.coalesce(F.col(v).cast("string"), F.lit("-")) for v in values))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), cells.alias("c"))))
    return rows.groupBy(key).agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["c"]), ";"), 256).alias("fingerprint"))


def required(rows: DataFrame, other: DataFrame, key: str, message: str) -> DataFrame:
    """Inner join on key of which every left row must find its match; one that doesn't is an error, not a lost row."""
    marked = rows.join(other.withColumn("__found", F.lit(True)), key, "left")
    checked = F.when(F.col("__found").isNull(), F.raise_error(F.concat(F.lit(message + ": "), F.col(key).cast("string")))).otherwise(F.lit(True))
    return marked.where(checked).drop("__found")


def pending(catalog: DataFrame, done: DataFrame, key: str, signature_col: str, fps_col: str, complete: Column, strict: bool = True) -> DataFrame:
    """Rows of catalog that no result covers: same signature and rate (within 1e-6) and, if strict, complete."""
    results = done.where(complete) if strict else done
    results = results.select(F.col(key).alias("__k"), F.col(signature_col).alias("__s"), F.col(fps_col).alias("__f"))
    same = (F.col(key) == F.col("__k")) & F.col(signature_col).eqNullSafe(F.col("__s")) & (F.abs(F.col(fps_col) - F.col("__f")) <= 1e-6)
    return catalog.join(results, same, "left_anti")


def overridden(rows: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """rows with value replaced by that of overrides where there is one, and was_overridden."""
    o = overrides.select(key, F.col(value).alias("__o"))
    return rows.join(o, key, "left").withColumn("was_overridden", F.col("__o").isNotNull()).withColumn(value, F.coalesce("__o", value)).drop("__o")


def oriented_size(rotation: Column, width: Column, height: Column) -> tuple[Column, Column]:
    """Width and height after a rotation by a multiple of 90 degrees; others are errors."""
    turned = F.when(rotation.isin(90, 270), True).when(rotation.isin(0, 180), False).otherwise(F.raise_error(F.lit("rotation must be 0, 90, 180 or 270")).cast("boolean"))
    return F.when(turned, height).otherwise(width), F.when(turned, width).otherwise(height)


def frame_count(nb_frames: Column, duration: Column, fps: Column) -> Column:
    """The stated number of frames, else that of duration and rate (rounded half to even)."""
    return F.coalesce(nb_frames.try_cast("long"), F.bround(duration * fps, 0).cast("long"))


def first_failure(checks: list[tuple[Column, str]]) -> Column:
    """The message of the first check that doesn't hold; null if all do."""
    out = F.lit(None).cast("string")
    for holds, message in reversed(checks):
        out = F.when(~F.coalesce(holds, F.lit(False)), F.lit(message)).otherwise(out)
    return out


def sparse_pivot(rows: DataFrame, group: str, kind: str, kinds: list[str], amount: str) -> DataFrame:
    """Per group and kind, how many rows and their amount; kinds that are absent count 0."""
    cells = []
    for k in kinds:
        cells += [F.count_if(F.col(kind) == k).alias(f"{k}_n"), F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(amount))), F.lit(0)).alias(f"{k}_{amount}")]
    return rows.groupBy(group).agg(*cells)


def batches_by(rows: DataFrame, shape: list[str], order: str, size: int, part_rows: int = 4096) -> DataFrame:
    """rows with batch: consecutive groups of `size` rows of the same shape, in the order of a whole-number column."""
    out = numbered(rows, shape, F.floor(F.col(order) / part_rows), [order], "__n")
    return out.withColumn("batch", F.floor((F.col("__n") - 1) / size).cast("long")).drop("__n")


def timeline_errors(expected: DataFrame, got: DataFrame, key: str, target_fps: float, late: float = 2e-5) -> DataFrame:
    """(key, found, expected, error): the first fault of each result, or null: `rows`, `frame` or `time_s`.

    expected: key, target_idx, source_idx; got: key, target_idx (the row's place), frame and time_s. A result has exactly
    the rows of the target timeline, the nearest frame in each, and its time within `late` seconds.
    """
    rows = expected.join(got, [key, "target_idx"], "full")
    off = F.abs(F.col("time_s") - F.col("target_idx") / F.lit(float(target_fps))) > late
    error = F.when(F.count("frame") != F.count("source_idx"), "rows").when(F.count_if(F.col("frame") != F.col("source_idx")) > 0, "frame").when(F.count_if(off) > 0, "time_s")
    return rows.groupBy(key).agg(F.count("frame").alias("found"), F.count("source_idx").alias("expected"), error.alias("error"))


def index_faults(rows: DataFrame, key: str, idx: str) -> DataFrame:
    """(key, frames, missing, negative, repeated): rows of each source whose index is absent, negative or there before."""
    each = rows.groupBy(key, idx).agg(F.count("*").alias("n"))
    again = F.sum(F.when(F.col(idx).isNotNull(), F.col("n") - 1).otherwise(0))
    return each.groupBy(key).agg(F.sum("n").alias("frames"), F.coalesce(F.sum(F.when(F.col(idx).isNull(), F.col("n"))), F.lit(0)).alias("missing"), F.coalesce(F.sum(F.when(F.col(idx) < 0, F.col("n"))), F.lit(0)).alias("negative"), again.alias("repeated"))


def checked_indices(rows: DataFrame, idx: str) -> DataFrame:
    """rows; one without an index, or with a negative one, is an error, never dropped."""
    return rows.where(F.when(F.col(idx).isNull() | (F.col(idx) < 0), F.raise_error(F.lit("frame without index"))).otherwise(F.lit(True)))
