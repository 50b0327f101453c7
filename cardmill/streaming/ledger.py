"""Sinks of streams whose repeated batches change nothing: a folder a batch, and a ledger of the batches that are whole.

A batch is written to <path>/batches/<id> and then entered in <path>/ledger/<id> by one rename. Spark runs a batch again when
it doesn't know that it ended: one that is in the ledger is left alone, one that isn't replaces what its first run left. Readers
see the batches of the ledger only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.storage import child, listed, located, replaced


def entered(path: str) -> list[int]:
    """The ids of whole batches."""
    return sorted(int(f.base_name) for f in listed(child(path, "ledger")) if f.base_name.isdigit())


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: rows of a batch, once however often it is run."""

    def write(batch: DataFrame, batch_id: int) -> None:
        system, entry = located(child(path, "ledger", str(batch_id)))
        if system.get_file_info(entry).type != fs.FileType.NotFound:
            return
        batch.write.mode("overwrite").parquet(child(path, "batches", str(batch_id)))
        replaced(child(path, "ledger", str(batch_id)), b"")

    return write


def appended(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows of whole batches with their batch_id."""
    ids = entered(path)
    if not ids:
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(None).cast("long"))
    rows = spark.read.schema(schema).parquet(*(child(path, "batches", str(i)) for i in ids))
    return rows.withColumn("batch_id", F.regexp_extract(F.col("_metadata.file_path"), r"/batches/(\d+)/", 1).cast("long"))


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the row of its last batch."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in (*keys, "batch_id"))), "batch_id").alias("r")).select(*keys, "r.*")


def started(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """A stream into the ledger of path, until what is there has been read."""
    return stream.writeStream.foreachBatch(append_once(path)).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def saved_responses(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """S27, S28 as a stream: responses that a fetcher has saved as <year>/<day>/<doc_id>.<attempt>, each file once.

    A file is three digits of status, a line feed and the body, so it is never empty (Spark passes over empty files); 000 stands for a fetch
    without any answer. Spark's own file source keeps the offsets and deals files to batches.
    """
    files = spark.readStream.format("binaryFile").options(recursiveFileLookup="true", maxFilesPerTrigger=per_batch).schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    name = r"(\d{4})/([^/]+)/([^/]+)\.(\d+)$"
    part = lambda i: F.regexp_extract("path", name, i)
    code = F.nullif(F.substring("content", 1, 3).cast("string").try_cast("int"), F.lit(0))
    rows = files.filter(F.col("path").rlike(name))
    return rows.select(part(1).cast("int").alias("year"), part(2).alias("day"), part(3).alias("doc_id"), part(4).cast("int").alias("attempt"), code.alias("code"), F.substring("content", 5, (1 << 31) - 1).alias("body"), F.col("modificationTime").alias("ts"))
