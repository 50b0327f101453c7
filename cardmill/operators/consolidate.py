"""Many archives and folders to one archive a year: inventory, deduplication by content, names, decisions."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import basename, date_from_name, digest, doc_id_from_name, safe_basename, valid_pdf


def source_refs(members: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row for each physical occurrence, in source order.

    members: year, archive, archive_rank, member_index, member (and content); files: year, path, root_rank (and content).
    Members of archives come before files; members keep their place in the archive, files are sorted by path.
    """
    extra = [c for c in ("content", "sha256", "bytes", "packed_bytes", "method", "crc", "header_offset") if c in members.columns and (files is None or c in files.columns)]
    zipped = members.select(
        "year", F.lit("zip").alias("kind"), F.col("archive").alias("source_path"), "member",
        F.concat(basename(F.col("archive")), F.lit("!"), F.col("member")).alias("label"), basename(F.col("member")).alias("basename"),
        date_from_name(F.col("member"), F.col("year")).alias("date"), doc_id_from_name(F.col("member")).alias("doc_id"),
        F.struct(F.lit(0).alias("kind"), F.col("archive_rank").cast("long").alias("rank"), F.col("member_index").cast("long").alias("place"), F.lit("").alias("path")).alias("source_order"), *extra,
    )
    if files is None:
        return zipped
    loose = files.select(
        "year", F.lit("file").alias("kind"), F.col("path").alias("source_path"), F.lit(None).cast("string").alias("member"),
        F.col("path").alias("label"), basename(F.col("path")).alias("basename"),
        date_from_name(F.col("path"), F.col("year")).alias("date"), doc_id_from_name(F.col("path")).alias("doc_id"),
        F.struct(F.lit(1).alias("kind"), F.col("root_rank").cast("long").alias("rank"), F.lit(0).cast("long").alias("place"), F.col("path").alias("path")).alias("source_order"), *extra,
    )
    return zipped.unionByName(loose)


def inventory(refs: DataFrame) -> DataFrame:
    """By year the physical occurrences, those without an id, and the ids."""
    return refs.groupBy("year").agg(F.count("*").alias("physical"), F.count_if(F.col("doc_id").isNull()).alias("unparsed"), F.countDistinct("doc_id").alias("doc_ids"))


def content_dedup(refs: DataFrame, content: str = "content") -> DataFrame:
    """A5: of each id and content the occurrence that comes first; `copies` says how many it stands for.

    `content` may be bytes or a digest of them. Only the digest is shuffled.
    """
    d = F.col(content) if content == "sha256" else digest(F.col(content))
    rows = refs.filter("doc_id IS NOT NULL").withColumn("sha256", d).drop("content")
    kept = rows.groupBy("year", "doc_id", "sha256").agg(F.min_by(F.struct(*(c for c in rows.columns if c not in ("year", "doc_id", "sha256"))), "source_order").alias("r"), F.count("*").alias("copies"))
    return kept.select("year", "doc_id", "sha256", "copies", "r.*")


def dedup_counts(kept: DataFrame) -> DataFrame:
    """A5: by year what comes in, what goes out, identical copies and further versions."""
    return kept.groupBy("year").agg(
        F.sum("copies").alias("source_entries"), F.count("*").alias("output_entries"), F.sum(F.col("copies") - 1).alias("identical_duplicates"),
        (F.count("*") - F.countDistinct("doc_id")).alias("variants"),
    )


def output_names(kept: DataFrame) -> DataFrame:
    """`version` (from 1, in source order) and a name in the archive that no other entry has.

    First versions whose plain names clash get <id>_ in front, then <id>_2_ and so on; further
    versions go to a folder of their id.
    """
    year = F.col("year").cast("string")
    folder = F.when(F.col("date").isNull(), F.concat(year, F.lit("/_undated"))).otherwise(F.concat_ws("/", year, F.substring("date", 1, 7), F.col("date")))
    name = safe_basename(F.col("basename"), F.col("doc_id"))
    rows = kept.withColumns({"folder": folder, "name": name, "version": F.row_number().over(Window.partitionBy("year", "doc_id").orderBy("source_order"))})
    # a plain name goes to the first in the order of ids; versions ask for names in that order too
    w = Window.partitionBy("year", "folder", "name").orderBy("doc_id", "version")
    rows = rows.withColumn("clash", F.row_number().over(w))
    own = F.row_number().over(Window.partitionBy("year", "folder", "name", "doc_id", F.col("clash") > 1).orderBy("version"))
    rows = rows.withColumn("turn", own)
    prefix = F.when(F.col("clash") == 1, "").when(F.col("turn") == 1, F.concat("doc_id", F.lit("_"))).otherwise(F.concat("doc_id", F.lit("_"), F.col("turn").cast("string"), F.lit("_")))
    plain = F.concat(prefix, F.col("name"))
    arcname = F.when(F.col("version") == 1, F.concat("folder", F.lit("/"), plain)).otherwise(F.concat("folder", F.lit("/_variants/"), "doc_id", F.lit("/"), F.col("version").cast("string"), F.lit("_"), plain))
    return rows.withColumn("arcname", arcname).drop("folder", "name", "clash", "turn")


def aliases(refs: DataFrame, named: DataFrame) -> DataFrame:
    """Of each id with several occurrences all labels in source order, its versions and their names."""
    ordered = lambda value, order: F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"])
    labels = refs.filter("doc_id IS NOT NULL").groupBy("year", "doc_id").agg(ordered("label", "source_order").alias("source_entries")).filter(F.size("source_entries") > 1)
    names = named.groupBy("year", "doc_id").agg(F.count("*").alias("distinct_content_versions"), ordered("arcname", "version").alias("output_entries"))
    return labels.join(names, ["year", "doc_id"])


def id_digest(ids: DataFrame, by: list[str], column: str = "doc_id") -> DataFrame:
    """SHA-256 of a group's sorted distinct ids, one a line; one row a group. A group without ids has the digest of nothing.

    Ids are made distinct where they lie, sorted inside their group by Spark (which spills), and a running hash takes them in
    batches; a group of any size costs a batch.
    """
    rows = ids.select(*by, F.col(column).cast("string").alias("_id")).distinct().repartition(*by).sortWithinPartitions(*by, "_id")
    schema = T.StructType([*(rows.schema[c] for c in by), T.StructField("id_digest", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, digest, begun = None, None, None, False

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*head, pa.array([digest.hexdigest()])], schema.names)

        for b in batches:
            keys = list(zip(*(b.column(i).to_pylist() for i in range(len(by))), strict=True))
            at = 0
            while at < len(keys):
                if keys[at] != key:
                    if key is not None:
                        yield row()
                    key, head, digest, begun = keys[at], [b.column(i).slice(at, 1) for i in range(len(by))], hashlib.sha256(), False
                end = bisect_right(keys, False, at, key=lambda k: k != key)
                values = [v for v in b.column(len(by)).slice(at, end - at).to_pylist() if v is not None]
                if values:
                    digest.update((("\n" if begun else "") + "\n".join(values)).encode())
                    begun = True
                at = end
        if key is not None:
            yield row()

    return rows.mapInArrow(run, schema)


def bad_documents(refs: DataFrame) -> DataFrame:
    """occurrences that aren't PDFs; a consolidation stops on any."""
    return refs.filter(~valid_pdf(F.col("content"))).select("year", "label")


def decision(dry_run: Column, archives: Column, loose: Column, ids: Column, unparsed: Column, canonical: Column) -> Column:
    """What is done with a year, by the first rule that applies."""
    return (
        F.when(dry_run, "counted")
        .when(unparsed > 0, "error_no_doc_id")
        .when((archives == 0) & (ids == 0), "created_empty")
        .when((archives == 1) & (loose == 0), "validated_and_renamed")
        .when(canonical, "error_target_exists")
        .otherwise("merged")
    )
