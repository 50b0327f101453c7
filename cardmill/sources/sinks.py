"""Sinks: annual CSV files, archives, reports and registers. Data is written by executors or as one small row set by the driver.

Final files appear by a rename of a finished temporary file, so a reader never sees a part of one.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ISSUE_COLUMNS, MANIFEST_COLUMNS, TABLE_COLUMNS, projected
from .shared import file_system, shared_path
from .storage import child, located, replaced
from .yearzip import archives as archives  # noqa: PLC0414 - the sink of archives is one of these

BOM = b"\xef\xbb\xbf"


def store(records: DataFrame, path: str) -> None:
    """The canonical table: Parquet, a folder for each year, in ranges of ids, sorted by id inside; finished years are replaced, others stay."""
    rows = projected(records, TABLE_COLUMNS).repartitionByRange("year", "doc_id").sortWithinPartitions("year", "doc_id")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def annual_csv(records: DataFrame, year: int, target: str, columns: list[str] = TABLE_COLUMNS, sep: str = ",") -> None:
    """One file of a year's rows in the order of their ids, with a byte order mark.

    One year's rows fit one file by the format's own terms; Spark sorts them by ranges and writes a part for each to a staging folder among the
    shared ones; the parts are copied on in blocks, one behind the other, to any storage. It is published only with as many rows as were selected.
    """
    spark = records.sparkSession
    staging, counted = shared_path(spark, "csv"), Observation()
    rows = projected(records.filter(F.col("year") == year), columns).orderBy("doc_id").observe(counted, F.count(F.lit(1)).alias("n"))
    layout = {"header": False, "quote": '"', "escape": '"', "sep": sep, "emptyValue": "", "lineSep": "\n"}
    rows.write.options(**layout).csv(staging)
    fs, root = file_system(spark, staging)
    parts = sorted(str(x.getPath()) for x in fs.listStatus(root) if x.getPath().getName().startswith("part-"))
    found = spark.read.options(header=False, multiLine=True, quote='"', escape='"', sep=sep).schema(", ".join(f"`{c}` string" for c in columns)).csv(staging).count() if parts else 0
    if found != counted.get["n"]:
        raise ValueError(f"the staged table of {year} has {found} rows of {counted.get['n']}")
    system, inside = located(target)
    system.create_dir(inside.rpartition("/")[0] or ".")
    tmp = f"{inside}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(tmp) as out:
        out.write(BOM)
        out.write((sep.join(columns) + "\n").encode())
        for p in parts:
            own, path = located(p)
            with own.open_input_stream(path) as f:
                while data := f.read(1 << 20):
                    out.write(data)
    system.move(tmp, inside)
    fs.delete(root, True)


def atomic_json(value: object, target: str) -> None:
    """K3, K6 to K8, K17."""
    tmp = f"{target}.{uuid.uuid4().hex}.tmp"
    Path(tmp).write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
    os.replace(tmp, target)


def schema_json(schema: T.StructType, target: str) -> None:
    """K6: names, places and types of the columns."""
    atomic_json([{"position": i, "name": f.name, "type": f.dataType.simpleString()} for i, f in enumerate(schema, 1)], target)


def manifest(annual: DataFrame) -> DataFrame:
    """K4."""
    return projected(annual, MANIFEST_COLUMNS).orderBy("year")


def quality_issues(records: DataFrame) -> DataFrame:
    """Rows that are not ok, over all years."""
    return projected(records.filter("extraction_status != 'ok'"), ISSUE_COLUMNS)


def tsv(df: DataFrame, target: str, header: list[str], order: list[str]) -> None:
    """A register without quotes; tabs and line breaks in values become blanks."""
    clean = df.orderBy(*order).select(*(F.translate(F.col(c).cast("string"), "\t\r\n", "   ").alias(c) for c in df.columns))
    lines = clean.select(F.concat_ws("\t", *(F.coalesce(c, F.lit("")) for c in clean.columns)).alias("value"))
    tmp = f"{target}.{uuid.uuid4().hex}.tmp"
    with open(tmp, "w", encoding="utf-8") as out:
        out.write("\t".join(header) + "\n")
        for r in lines.toLocalIterator():  # one partition at a time
            out.write(r.value + "\n")
    os.replace(tmp, target)


def patch_entries(staged: DataFrame, site: DataFrame, held: DataFrame) -> DataFrame:
    """Staged rows whose id is announced and not held yet."""
    keys = ["year", "doc_id"]
    return staged.join(site.select(*keys).distinct(), keys, "left_semi").join(held.select(*keys).distinct(), keys, "left_anti")


def log_line(df: DataFrame) -> DataFrame:
    """Seven fields of an error as one line."""
    from ..functions.text import one_line

    names = ["timestamp", "day", "status", "registration", "doc_id", "reason", "url"]
    return df.select(F.concat_ws(" | ", *(F.coalesce(one_line(F.col(n)), F.lit("-")) for n in names)).alias("value"))


def link_or_copy(source: str, target: str) -> None:
    """A hard link where the file system allows one, else a copy."""
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    try:
        os.link(source, target)
    except OSError:
        shutil.copy2(source, target)


def move_to_backup(paths: list[str], backup: str) -> list[dict]:
    """Moves files away and records their sizes."""
    Path(backup).mkdir(parents=True, exist_ok=True)
    out = []
    for p in paths:
        out.append({"path": p, "bytes": os.path.getsize(p) if os.path.isfile(p) else sum(f.stat().st_size for f in Path(p).rglob("*") if f.is_file())})
        shutil.move(p, str(Path(backup) / Path(p).name))
    return out


def updated_report(path: str, **keys: object) -> None:
    """Some keys of a JSON report replaced."""
    report = json.loads(Path(path).read_text(encoding="utf-8-sig"))
    atomic_json(report | keys, path)


def markdown(df: DataFrame, title: str, most: int = 1000) -> str:
    """A small result as a Markdown table; larger ones belong into files."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows are no report")
    line = lambda cells: "| " + " | ".join(str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([f"# {title}", "", line(df.columns), line(["---"] * len(df.columns)), *(line(r) for r in rows), ""])


def save_state(state: DataFrame, folder: str, name: str = "repair_state_{}.json") -> DataFrame:
    """The day records of each year as one stamped JSON file, by a rename; returns year, path, days.

    state: year, day and the fields of files.repair_state. A year is one task's: at most 366 days, with the ids that a site lists in them.
    """
    record = F.struct(*(c for c in state.columns if c not in ("year", "day")))
    days = state.groupBy("year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("day", record.alias("r"))))).alias("days"), F.count("*").alias("n"))
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    text = F.to_json(F.struct(F.lit(1).alias("version"), "year", stamp.alias("updated_at_utc"), "days"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = [child(folder, name.format(year)) for year in b.column(0).to_pylist()]
            for path, value in zip(paths, b.column(2).to_pylist(), strict=True):
                replaced(path, value.encode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(paths, pa.string()), b.column(1)], ["year", "path", "days"])

    return days.select("year", F.col("n").alias("days"), text.alias("text")).mapInArrow(write, "year int, path string, days long")
