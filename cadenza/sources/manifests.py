"""JSON manifests, and the sinks of results: JSON, CSV with a byte-order mark, JSON lines and HTML."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions import html_escape


def read_items(spark: SparkSession, path: str, item: T.StructType, field: str = "items") -> DataFrame:
    """The items of a manifest: one JSON document that is an array, or an object with the array in `field`."""
    text = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", T.ArrayType(item))
    within = F.from_json("value", T.StructType([T.StructField(field, T.ArrayType(item))]))[field]
    bare = F.ltrim("value").startswith("[")
    return text.select(F.explode(F.when(bare, listed).otherwise(within)).alias("x")).select("x.*")


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """(segment_id, decision) of a JSON map, bare or in the field `decisions`."""
    kind = T.MapType(T.StringType(), T.StringType())
    text = spark.read.text(path, wholetext=True)
    wrapped = F.from_json("value", T.StructType([T.StructField("decisions", kind)]))["decisions"]
    return text.select(F.explode(F.coalesce(wrapped, F.from_json("value", kind))).alias("segment_id", "decision"))


def _one_file(lines: DataFrame, path: str) -> None:
    """Lines (place, value) as one text file in the order of their places: one task writes, none of it passes the driver."""
    lines.orderBy("place").select("value").coalesce(1).write.mode("overwrite").text(path, lineSep="\n")


def _numbered_lines(rows: DataFrame, value: Column) -> DataFrame:
    return rows.select(F.monotonically_increasing_id().alias("place"), value.alias("value"))


def write_json_document(rows: DataFrame, path: str) -> None:
    """One JSON array, an item on each line, of any number of rows."""
    spark = rows.sparkSession
    items = _numbered_lines(rows, F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns))))
    last = items.agg(F.max("place")).first()[0]
    body = items.select("place", F.concat(F.lit("  "), F.col("value"), F.when(F.col("place") == F.lit(last), "").otherwise(",")).alias("value"))
    ends = spark.createDataFrame([(-1, "["), ((1 << 63) - 1, "]")], "place long, value string")
    _one_file(body.unionByName(ends), path)


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV whose header begins with a byte-order mark; no rows give files with a header only."""
    first = rows.columns[0]
    rows.withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").option("header", True).csv(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path, compression="gzip")


def write_html_table(rows: DataFrame, title: str, path: str) -> None:
    """A page with a table of all rows, a line for each; executors render it."""
    spark = rows.sparkSession
    cells = [F.concat(F.lit("<td>"), html_escape(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))), F.lit("</td>")) for c in rows.columns]
    body = _numbered_lines(rows, F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")))
    head = "".join(f"<th>{html.escape(c)}</th>" for c in rows.columns)
    opening = f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table><tr>{head}</tr>"
    ends = spark.createDataFrame([(-1, opening), ((1 << 63) - 1, "</table>")], "place long, value string")
    _one_file(body.unionByName(ends), path)
