"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from cadenza.shipping import ship

#: Whether Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of our own if it is unset on a local master."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="cadenza-shared-")
        spark.sparkContext.setCheckpointDir(where)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return where


class Scratch:
    """Tables of one operator call in the shared folder; drop() removes those that are no longer read."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        ship(spark)
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/cadenza-{label}-{uuid.uuid4().hex[:12]}"
        self.root = self._path("").getFileSystem(self._hadoop()).makeQualified(self._path("")).toString()  # readers other than Spark know no default file system
        self._path("").getFileSystem(self._hadoop()).deleteOnExit(self._path(""))

    def _hadoop(self):
        return self.spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as Parquet and read it back: the lineage ends there, and a lost executor costs nothing.

        The shuffle files of the writing go once the table is complete, as nothing reads them any more.
        """
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(self.path(name))
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._path(name).getFileSystem(self._hadoop()).delete(self._path(name), True)
