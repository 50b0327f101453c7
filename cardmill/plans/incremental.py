"""Years built as they come due, each published whole.

A build writes its tables, CSV files and reports to <root>/builds/<id> and publishes a year by replacing <root>/published/<year>.json, which
names them: one rename for table, CSV and report together. Readers go by these names, so a build that stops midway leaves its
finished years published and all others as they were, and the next one builds only what is still open. One build runs at a time. Builds that no year
names any more are removed at the end of one that succeeds.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delivery import years_to_build
from ..operators.variants import best_records, status_counts
from ..schemas import TABLE_COLUMNS
from ..sources import sinks
from ..sources.storage import child, deleted, listed, located, replaced
from .build import year_reports

_REPORT = "year int, archive string, sample_mode boolean, rows_written long, archive_pdf_entries long, archive_unique_doc_ids long, extra_variants long, ok long, warning long, failed long, registration_mismatches long, csv_columns int, build string"


def published(root: str) -> list[dict]:
    """The report of each published year with the build that it is from."""
    out = []
    for f in listed(child(root, "published"), ".json"):
        system, inside = located(child(root, "published", f.base_name))
        with system.open_input_stream(inside) as s:
            out.append(json.loads(s.read()))
    return out


def reports(spark: SparkSession, root: str) -> DataFrame:
    """K3: a row a year."""
    names = [x.split()[0] for x in _REPORT.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in published(root)], _REPORT)


def records(spark: SparkSession, root: str) -> DataFrame:
    """The table of all published years, each from the build that published it."""
    paths = [child(root, "builds", r["build"], "table", f"year={r['year']}") for r in published(root) if r["rows_written"]]
    parts = [spark.read.option("basePath", p.rpartition("/")[0]).parquet(p) for p in paths]
    if not parts:
        raise ValueError(f"{root} has no published year with rows")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def csv_of(root: str, year: int) -> str:
    build = next(r["build"] for r in published(root) if r["year"] == year)
    return child(root, "builds", build, f"output_{year}.csv")


def build_due(spark: SparkSession, variants: DataFrame, archives: DataFrame, root: str, force: bool = False) -> list[int]:
    """Build and publish the years whose published report isn't complete for their archive; returns them in order.

    variants: the input of best_records; archives: year, archive. All due years are one job, in which a document's variants meet in one
    shuffle; then each is published on its own. Tables are written by ranges of year and id, so a large year isn't one task's.
    """
    due = {r.year: r.archive for r in years_to_build(reports(spark, root), archives, len(TABLE_COLUMNS), force).collect()}  # a row a year
    if not due:
        return []
    build = uuid.uuid4().hex
    table = child(root, "builds", build, "table")
    rows = best_records(variants.filter(F.col("year").isin(list(due))))
    extra = [c for c in ("year", *TABLE_COLUMNS, "pdf_variant_count", "extraction_status", "registration_number_matches_filename") if c in rows.columns]
    rows.select(*dict.fromkeys(extra)).repartitionByRange("year", "doc_id").sortWithinPartitions("year", "doc_id").write.partitionBy("year").parquet(table)
    whole = spark.read.parquet(table)
    none = spark.createDataFrame([(y, a) for y, a in due.items()], "year int, archive string")
    made = {r.year: r.asDict() for r in year_reports(whole, none).collect()}
    done = []
    for year in sorted(due):
        report = made.get(year) or {"year": year, "archive": due[year], "sample_mode": False, "csv_columns": len(TABLE_COLUMNS)} | dict.fromkeys(status_counts(whole).columns[1:], 0) | {"rows_written": 0}
        sinks.annual_csv(whole, year, child(root, "builds", build, f"output_{year}.csv"))
        replaced(child(root, "published", f"{year}.json"), json.dumps(report | {"build": build}).encode())
        done.append(year)
    _forget(root)
    return done


def _forget(root: str) -> None:
    """Remove builds that no published year names."""
    named = {r["build"] for r in published(root)}
    system, inside = located(child(root, "builds"))
    for d in system.get_file_info(fs.FileSelector(inside, allow_not_found=True)):
        if d.base_name not in named:
            deleted(child(root, "builds", d.base_name))
