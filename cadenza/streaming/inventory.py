"""An inventory that only looks at files it has not seen, as a stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the files below folder; contents are read only if a query uses them."""
    return spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", True).load(folder)


def catch_up(files: DataFrame, checkpoint: str, handle: Callable[[DataFrame], None], suffixes: tuple[str, ...]) -> StreamingQuery:
    """Hand the unseen files with these suffixes to `handle`, in batches, then stop. What was handled is remembered in checkpoint, so a lost run resumes."""
    pattern = "(?i)(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"
    rows = files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).where(F.col("path").rlike(pattern))
    return rows.writeStream.foreachBatch(lambda df, _: handle(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
