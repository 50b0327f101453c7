"""The index of all archives of a folder, kept by change: an archive is opened once for each of its versions.

<table>/catalog.json lists the archives as of the last refresh with size and time of change, and the key of each version, whose members
are the partition version=<key> of <table>/members. A refresh indexes only versions that the catalog lacks, publishes the
new catalog by one rename, and then removes the partitions of versions that are gone; one that dies in between leaves the old
catalog and partitions that the next refresh writes over or removes.
"""

from __future__ import annotations

import hashlib
import json

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import child, deleted, listed, located, replaced
from .ziparchive import ZipIndex, year_archives, zip_members

_SCHEMA = ZipIndex({}).schema() + ", version string"


def catalog(table: str) -> dict[str, dict]:
    """By archive its size, time of change and version; empty before the first refresh."""
    system, inside = located(child(table, "catalog.json"))
    if system.get_file_info(inside).type == fs.FileType.NotFound:
        return {}
    with system.open_input_stream(inside) as f:
        return json.loads(f.read())


def _now(folder: str, years: range | None) -> dict[str, dict]:
    wanted, out = set(year_archives(folder, years)), {}
    for f in listed(folder, ".zip"):
        path = child(folder, f.base_name)
        if path in wanted:
            version = hashlib.md5(f"{path}\n{f.size}\n{f.mtime_ns}".encode()).hexdigest()
            out[path] = {"size": f.size, "changed": f.mtime_ns, "version": version}
    return out


def refresh(spark: SparkSession, folder: str, table: str, years: range | None = None, permissive: bool = True) -> dict[str, list[str]]:
    """Bring the index up to the folder; returns the archives that were opened, and those whose rows went."""
    known, now = catalog(table), _now(folder, years)
    opened = sorted(p for p, a in now.items() if a["version"] != known.get(p, {}).get("version"))
    if opened:
        versions = F.create_map(*(F.lit(x) for p in opened for x in (p, now[p]["version"])))
        rows = zip_members(spark, opened, permissive=permissive).withColumn("version", versions[F.col("archive")])
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(child(table, "members"))
    if opened or set(known) != set(now):
        replaced(child(table, "catalog.json"), json.dumps(now).encode())
    kept = {a["version"] for a in now.values()}
    system, inside = located(child(table, "members"))
    for d in system.get_file_info(fs.FileSelector(inside, allow_not_found=True)):
        if d.base_name.startswith("version=") and d.base_name.removeprefix("version=") not in kept:
            deleted(child(table, "members", d.base_name))
    return {"opened": opened, "gone": sorted(set(known) - set(now))}


def indexed(spark: SparkSession, table: str) -> DataFrame:
    """The members of all archives of the catalog; partitions of other versions aren't read."""
    versions = sorted({a["version"] for a in catalog(table).values()})
    system, inside = located(child(table, "members"))
    there = {d.base_name.removeprefix("version=") for d in system.get_file_info(fs.FileSelector(inside, allow_not_found=True))}
    paths = [child(table, "members", f"version={v}") for v in versions if v in there]  # an archive without members has none
    if not paths:
        return spark.createDataFrame([], _SCHEMA).drop("version")
    return spark.read.schema(_SCHEMA).option("basePath", child(table, "members")).parquet(*paths).drop("version")
