"""The folder that the driver and all executors share, and tables kept there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables with fewer rows are written by a task for each ROWS_A_TASK and may be broadcast; larger ones are left to Spark.
FEW_ROWS, ROWS_A_TASK = 200_000, 25_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a temporary folder will do for a local master; on a
    cluster every machine would write to a folder of its own, so that is an error."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("ironsift.shared.dir", None)
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="spark-ironsift-")
        spark.conf.set("ironsift.shared.dir", known)
    return known


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: later steps neither repeat nor lose it. The shuffle files
    of the step go with it."""
    return Kept(df.sparkSession).keep(df, name)


class Kept:
    """Tables of one run in a folder of their own; what no later step reads is dropped."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """The table, written and read again. rows: how many it has at most, where that is known: few rows are written by few tasks."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        if rows is not None and rows < FEW_ROWS:
            df = df.coalesce(1 + rows // ROWS_A_TASK)
        before = self.spark.conf.get(_CLEANUP)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Deletes kept tables. Nothing that still runs may read them."""
        from pyarrow import fs

        for table in tables:
            for folder in {x.rpartition("/")[0] for x in table.inputFiles()}:
                system, path = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
                system.delete_dir(path)


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has few rows, as counted before."""
    return F.broadcast(df) if rows < FEW_ROWS else df
