"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. With a local master a temporary folder will do where it is unset; on a cluster
    each machine would write to a folder of its own, so that is an error."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("ironsift.tables.dir", None)
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="spark-ironsift-")
        spark.conf.set("ironsift.tables.dir", known)
    return known


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
