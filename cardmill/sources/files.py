"""Loose files, state files, logs and tables as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import basename, doc_id_from_name, valid_pdf
from ..schemas import TABLE

_DAY = "struct<date_to:string, site_total:bigint, doc_ids:array<string>, no_pdf_doc_ids:array<string>, server500_doc_ids:array<string>, completed_at_utc:string, accepted_error:string, additional_logged_statuses:array<string>>"


def loose_documents(spark: SparkSession, roots: list[str]) -> DataFrame:
    """PDF files under several roots: path, root_rank, content. An earlier root goes first."""
    out = None
    for rank, root in enumerate(roots):
        df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(root).select("path", F.lit(rank).alias("root_rank"), "content")
        out = df if out is None else out.unionByName(df)
    return out


def unique_files(files: DataFrame) -> DataFrame:
    """Of each name before its first underscore the path that comes first."""
    key = F.split(basename(F.col("path")), "_")[0]
    return files.groupBy(key.alias("key")).agg(F.min("path").alias("path"))


def staged_documents(files: DataFrame) -> DataFrame:
    """Of each id the first valid file, by root and path."""
    rows = files.withColumn("doc_id", doc_id_from_name(F.col("path"))).filter(F.col("doc_id").isNotNull() & valid_pdf(F.col("content")))
    return rows.groupBy("doc_id").agg(F.min_by("path", F.struct("root_rank", "path")).alias("path"))


def ids_by_date(names: DataFrame) -> DataFrame:
    """Of each year and date token in (year, name) the sorted ids."""
    from ..functions.text import date_from_name

    rows = names.select("year", date_from_name(F.col("name"), F.col("year")).alias("day"), doc_id_from_name(F.col("name")).alias("doc_id")).filter("day IS NOT NULL AND doc_id IS NOT NULL")
    return rows.groupBy("year", "day").agg(F.array_sort(F.collect_set("doc_id")).alias("doc_ids"))


def repair_state(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Day records of state files: year, day and their fields. A file that doesn't parse has none."""
    schema = f"version int, year int, days map<string,{_DAY}>, _broken string"
    raw = spark.read.schema(schema).option("multiLine", "true").option("columnNameOfCorruptRecord", "_broken").json(paths)
    return raw.filter("_broken IS NULL AND days IS NOT NULL").select("year", F.explode("days").alias("day", "r")).filter("r IS NOT NULL").select("year", "day", "r.*")


def state_ids(state: DataFrame, ids: str) -> DataFrame:
    """The distinct ids of one list of the day records, in lower case."""
    return state.select("year", F.explode(ids).alias("doc_id")).select("year", F.lower("doc_id").alias("doc_id")).distinct()


def log_lines(spark: SparkSession, path: str, year: int) -> DataFrame:
    """Lines of a log with their number; a number grows along a file."""
    return spark.read.text(path).select(F.lit(year).alias("year"), F.monotonically_increasing_id().alias("line_no"), "value")


def annual_table(spark: SparkSession, paths: list[str], checked: bool = True) -> DataFrame:
    """The annual CSV tables; empty cells are ''. A header other than the schema's is an error."""
    df = spark.read.schema(TABLE).options(header=True, multiLine=True, quote='"', escape='"', enforceSchema=not checked).csv(paths)
    return df.na.fill("")


def json_report(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Reports of one JSON object a file."""
    return spark.read.schema(schema).option("multiLine", "true").json(paths)
