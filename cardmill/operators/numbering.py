"""Numbers along a global order, without a task that sees all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import shared_path


def numbered(df: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """df with each row's place, from 1, in the order.

    Ranges of the order are written as a table in the shared folder (`written_path`), each row with its range; the
    ranges' counts, one for each, are summed up to offsets, and a window inside each range does the rest. df is read twice, once for
    the bounds, so it should be a table or cheap; the result's `rows` tells how many there are. Rows that the order doesn't tell apart share a range: end it with what does.
    """
    spark = df.sparkSession
    path = shared_path(spark, "numbered")
    part = "_range"
    while part.lower() in {c.lower() for c in df.columns}:
        part += "_"
    df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    counts = {r[0]: r[1] for r in stored.groupBy(part).count().collect()}
    before = dict(zip(sorted(counts), accumulate([0, *(counts[p] for p in sorted(counts))]), strict=False))
    offsets = spark.createDataFrame(list(before.items()), f"{part} int, {name} long")
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) + F.col(name)
    out = stored.join(F.broadcast(offsets), part).withColumn(name, place).drop(part)
    out.written_path, out.rows = path, sum(counts.values())
    return out
