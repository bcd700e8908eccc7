"""Planning whole sources onto nodes and lanes by estimated cost.

Assigning the largest item to the earliest finisher is a sequential fold. It is one Arrow pass over a manifest of sources
(not frames), linear in its rows: a task takes a few seconds and some hundred bytes a row for a million sources.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.shipping import ship


def estimated_frames(duration: Column, target_fps: Column, source_fps: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.bround(duration * F.coalesce(F.nullif(target_fps, F.lit(0.0)), source_fps), 0).cast("long"))


def with_costs(items: DataFrame, frames: str, size: str, local_fps: float, remote_fps: float, mib_per_s: float) -> DataFrame:
    """items with local_cost and remote_cost in seconds: inference, and for the remote node the transfer before it."""
    local = F.col(frames) / F.lit(float(local_fps))
    remote = F.coalesce(F.col(size), F.lit(0)) / F.lit(mib_per_s * 1024 * 1024) + F.col(frames) / F.lit(float(remote_fps))
    return items.withColumn("local_cost", local).withColumn("remote_cost", remote)


def _folded(items: DataFrame, by: list[str], key: str, extra: list[Column], of, made: str, kind: str) -> DataFrame:
    """items of each group in one Arrow pass: of(columns) gives each row's choice, rows in order (order, key); then position within a choice."""
    ship(items.sparkSession)
    rows = items.select(*by, F.col(key).alias(key), *extra)
    types = dict(rows.dtypes)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), (key, "ascending")])
        return table.select([*by, key]).append_column(made, of({c: table.column(c).to_numpy() for c in ("order", "a", "b") if c in table.column_names})).append_column("position", pa.array(np.arange(table.num_rows)))

    schema = ", ".join([*(f"{c} {types[c]}" for c in (*by, key)), f"{made} {kind}", "position long"])
    placed = rows.groupBy(*(by or [F.lit(0).alias("all")])).applyInArrow(run, schema)
    return placed.withColumn("position", (F.row_number().over(W.partitionBy(*by, made).orderBy("position")) - 1).cast("long"))


def assign_nodes(items: DataFrame, key: str) -> DataFrame:
    """(key, node, position): in the order of the larger cost, descending, each item goes where it ends first; equal ends go to local."""

    def of(c: dict) -> pa.Array:
        ends, nodes = [0.0, 0.0], []
        for local, remote in zip(c["a"].tolist(), c["b"].tolist(), strict=True):
            away = ends[0] + local > ends[1] + remote
            ends[away] += remote if away else local
            nodes.append("remote" if away else "local")
        return pa.array(nodes, pa.string())

    extra = [(-F.greatest("local_cost", "remote_cost")).cast("double").alias("order"), F.col("local_cost").cast("double").alias("a"), F.col("remote_cost").cast("double").alias("b")]
    return _folded(items, [], key, extra, of, "node", "string")


def assign_lanes(items: DataFrame, key: str, frames: str, rates: list[float], by: list[str] | None = None) -> DataFrame:
    """(by, key, lane, position): in the order of frames, descending, each item goes to the lane that finishes least late so far; equal ones to the lowest lane."""
    if not rates or min(rates) <= 0:
        raise ValueError("rates must be positive")

    def of(c: dict) -> pa.Array:
        free, lanes = [(0.0, k) for k in range(len(rates))], []  # a heap of ends and lanes
        for negative in c["order"].tolist():
            end, lane = heapq.heappop(free)
            heapq.heappush(free, (end - negative / rates[lane], lane))
            lanes.append(lane)
        return pa.array(lanes, pa.int32())

    return _folded(items, by or [], key, [(-F.col(frames)).cast("double").alias("order")], of, "lane", "int")


def lane_specs(spark: SparkSession, nodes: dict[str, dict]) -> DataFrame:
    """(node, lane, backend, rate, threads): hardware workers share the node's rate; software and integrated lanes have their own."""
    rows = []
    for node, spec in nodes.items():
        lanes = [("nvdec", spec["fps"] / spec["workers"], 0)] * spec["workers"]
        lanes += [("software", spec.get("software_fps", 0.0), spec.get("software_threads", 0))] * spec.get("software_workers", 0)
        lanes += [("igpu", spec["igpu_fps"], 0)] if node == "local" and spec.get("igpu_fps") else []
        rows += [(node, i, *lane) for i, lane in enumerate(lanes)]
    return spark.createDataFrame(rows, "node string, lane int, backend string, rate double, threads int")
