"""File inventories: scans, content digests and media probes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions import rational
from cadenza.shipping import ship

# The media suffixes of an inventory, and the bytes read at either end of a file for its digest.
SUFFIXES = (".mp4", ".mov", ".mkv", ".avi", ".m4v")
EDGE = 1 << 20


def scan(spark: SparkSession, root: str, folders: list[str], suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """path, relative_path, bytes and modified of all files below the folders, once each, in the order of paths. Contents are not read."""
    parts = []
    for folder in folders:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root.rstrip('/')}/{folder}".rstrip("/"))
        parts.append(files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    pattern = "(?i)(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"
    base = root.rstrip("/").split("://")[-1].lstrip("/")
    relative = F.regexp_replace("path", rf"^.*?{base.replace('.', chr(92) + '.')}/", "")
    return found.where(F.col("path").rlike(pattern)).dropDuplicates(["path"]).withColumn("relative_path", relative).orderBy("path")


def digest_bytes(content: bytes) -> str:
    """128-bit BLAKE2b of the size (8 bytes, little-endian), the first EDGE bytes and, of longer content, the last EDGE bytes."""
    h = hashlib.blake2b(len(content).to_bytes(8, "little"), digest_size=16)
    h.update(content[:EDGE])
    if len(content) > EDGE:
        h.update(content[-EDGE:])
    return h.hexdigest()


def edge_digest(content: Column) -> Column:
    """digest_bytes of a binary column; null for null. There is no BLAKE2b in Spark SQL, so this is an Arrow UDF."""
    ship(SparkSession.active())

    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else digest_bytes(bytes(v)))

    return run(content)


PROBE = "streams array<struct<codec_type:string,width:int,height:int,avg_frame_rate:string,r_frame_rate:string,nb_frames:string,duration:string>>, format struct<duration:string,size:string,format_name:string>"


def probed(files: DataFrame, json_col: str) -> DataFrame:
    """files with the projection of a media probe's JSON: video, audio, format, fps, is_1080p100, probe_ok and probe_error.

    Unreadable JSON, or none with a video stream, is a failed probe, not an error of the query.
    """
    p = F.from_json(json_col, PROBE)
    video = F.get(F.filter(p["streams"], lambda s: s["codec_type"] == "video"), F.lit(0))
    audio = F.filter(p["streams"], lambda s: s["codec_type"] == "audio")
    fps = rational(F.coalesce(F.nullif(video["avg_frame_rate"], F.lit("")), video["r_frame_rate"], F.lit("0/1")))
    out = files.withColumns({"video": video, "audio": audio, "format": p["format"], "fps": fps})
    full = (F.col("video.width") == 1920) & (F.col("video.height") == 1080) & (F.abs(F.col("fps") - 100) < 0.01)
    ok = F.col("video").isNotNull()
    return out.withColumns({"is_1080p100": F.coalesce(full, F.lit(False)), "probe_ok": ok, "probe_error": F.when(~ok, "no video stream")})


def probe_with(files: DataFrame, run: Callable[[str], str], path_col: str = "path") -> DataFrame:
    """files with probe_json from an injected probe, which runs on the executors; its exceptions become null."""
    ship(files.sparkSession)

    @F.pandas_udf(T.StringType())
    def call(paths: pd.Series) -> pd.Series:
        def one(path: str) -> str | None:
            try:
                return run(path)
            except Exception:
                return None

        return paths.map(one)

    return files.withColumn("probe_json", call(F.col(path_col)))
