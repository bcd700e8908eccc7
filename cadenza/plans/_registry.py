"""Registration of queries, and the derived tables that many of them read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows, if any."""

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Measurements of a frame, as expressions of an event's id that Spark and SQL read alike.
MEASURES = {
    "center_x": "CAST(event_id * 37 % 100 AS DOUBLE) / 100",
    "center_y": "CAST(event_id * 53 % 100 AS DOUBLE) / 125",
    "face_scale": "CAST(event_id * 7 % 40 + 6 AS DOUBLE) / 160",
    "face_score": "CAST(event_id * 29 % 50 + 49 AS DOUBLE) / 98",
    "rigidity": "CAST(event_id * 31 % 30 AS DOUBLE) / 1000",
    "pitch": "CAST(event_id * 13 % 61 - 30 AS DOUBLE)",
    "yaw": "CAST(event_id * 17 % 101 - 50 AS DOUBLE)",
    "roll": "CAST(event_id * 19 % 51 - 25 AS DOUBLE)",
    "gaze_h": "CAST(event_id * 39 % 41 - 20 AS DOUBLE) / 100",
    "gaze_v": "CAST(event_id * 43 % 26 - 10 AS DOUBLE) / 100",
    "left_open": "CASE WHEN event_id % 23 <> 0 THEN CAST(event_id * 47 % 20 AS DOUBLE) / 20 END",
    "right_open": "CASE WHEN event_id % 29 <> 0 THEN CAST(event_id * 59 % 20 AS DOUBLE) / 20 END",
}

#: The events of a user as a timeline: idx is the place in the order of (ts, event_id).
FRAMES = "frames AS (SELECT user_id AS source_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, event_id, value, event_type, event_type <> 'error' AS face_detected, " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in MEASURES.items()) + " FROM events)"


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("user_id", "source_id")
    idx = (F.row_number().over(W.partitionBy("source_id").orderBy("ts", "event_id")) - 1).cast("long")
    measured = [F.expr(f"CAST({e} AS DOUBLE)").alias(n) for n, e in MEASURES.items()]
    return events.select("source_id", idx.alias("idx"), "event_id", "value", "event_type", (F.col("event_type") != "error").alias("face_detected"), *measured)
