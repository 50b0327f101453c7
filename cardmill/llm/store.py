"""Tables written to the folder that the cluster shares, to cut lineage and survive lost executors."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ONE = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset and Spark is local (tests), one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file:///tmp/cardmill-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of the jobs inside when they are done, rather than when the driver's garbage is collected.

    Shuffles are numbered one after the other; where any other job runs on the context at either end, nothing is removed.
    """
    jsc = spark.sparkContext._jsc
    busy = lambda: len(spark.sparkContext.statusTracker().getActiveJobsIds())
    with _ONE:
        alone, first = not busy(), jsc.sc().newShuffleId()
        yield
        cleaner = jsc.sc().cleaner()
        if alone and not busy() and cleaner.isDefined():
            for i in range(first, jsc.sc().newShuffleId()):
                cleaner.get().doCleanupShuffle(i, False)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a written Parquet table; a lost executor costs no more than a read."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """df, whose values come packed, written in buckets of key under the shared folder, a file for each; joins on key don't move it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    table = "cardmill_" + path.rpartition("-")[2]
    with shuffles_removed(spark):
        df.repartition(buckets, key).write.option("compression", "uncompressed").option("path", path).bucketBy(buckets, key).saveAsTable(table)
    out = spark.table(table)
    out.written_path, out.written_table = path, table
    return out


def dropped_buckets(table: DataFrame) -> None:
    dropped(table)
    table.sparkSession.sql(f"DROP TABLE IF EXISTS {table.written_table}")


def dropped(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_HEAVY = 1 << 14


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """The inner join of rows with a written table that has one row for each value of keys; weight tells how many rows have it.

    Values that a share of 1/2**14 of the rows have, of which there are 2**14 at most, are broadcast, so their rows stay where
    they lie; all others are joined by their hash.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) >= max(total / _HEAVY, 64)
    few, many = F.broadcast(table.filter(heavy)), table.filter(~heavy)
    return rows.join(few, keys).unionByName(rows.join(few.select(*keys), keys, "left_anti").join(many, keys))


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def arrow_limits(spark: SparkSession, mb: int = 4) -> None:
    """Bound what one Arrow batch holds, so that long texts don't fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that df doesn't have, whatever the case of its own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
