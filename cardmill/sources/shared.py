"""The folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; where that is unset, one of this machine if Spark runs on it alone, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file:///tmp/cardmill-shared"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p
