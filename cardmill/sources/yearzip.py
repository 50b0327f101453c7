"""The sink "yearzip": one ZIP a year, published by a commit in two phases.

Tasks write files of their own attempt under <path>/_attempts/<job>, verify them, and name them in their commit
message. Only `commit` publishes: it writes the list of renames as <job>/commit.json, then renames, then removes the
job's folder. A job that fails is removed whole by `abort`; one that dies between list and last rename is finished by the next
commit, or by `finish`, from its list. So no reader ever sees part of an archive under a year's name, and files of retried,
speculative and failed tasks never get one.

Rows are (year, arcname, content), dealt so that all rows of an archive are in one partition, one behind the other.
A null arcname adds no member, so an empty year is one such row.

`archives` needs no task that takes a whole archive: it deals rows by ranges of names, and with the option runs a task writes what it has of an archive as a run, a ZIP
of its own that `commit` lists but doesn't publish. A second job copies each run's members to their place in the archive's file and their entries, moved by
that place, to theirs in its directory, a task a run, and reads both back. Then the archives are published as above. Where the storage can't write inside a file
(all but local and mounted ones), a task an archive copies its runs one behind the other, in blocks.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import astuple, dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .shared import shared_path
from .storage import child, deleted, located, replaced
from .ziparchive import _END, _END64, _ENTRY, LOCATION, _entries, _entry, _local_name, directory, member_bytes, with_content

_ATTEMPTS = "_attempts"
_BLOCK = 8 << 20

# An entry's field of a place of eight bytes, the locator of the wide end record, and the largest of four bytes.
_WIDE = struct.Struct("<2HQ")
_LOCATOR = struct.Struct("<4sLQL")
_FULL = 0xFFFFFFFF


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[int, str, str, int]]  # year, name, attempt's file, members
    runs: list[tuple] = field(default_factory=list)  # the fields of Run


@dataclass
class Run:
    """Members of an archive that lie one behind the other, as a ZIP of their own."""

    year: int
    name: str  # of the archive
    path: str
    n: int
    first: str | None  # name of a member
    last: str | None
    names: int  # bytes
    digest: str  # of the names
    size: int  # of the members with their headers
    at: int = 0  # where they go in the archive
    entries_at: int = 0
    wide: bool = False  # whether entries have places of eight bytes

    @property
    def entries(self) -> int:
        """Bytes of its entries in the archive's directory."""
        return self.n * (_ENTRY.size + self.wide * _WIDE.size) + self.names


class YearZip(DataSource):
    """Options: path; stored (true, else deflated at level 1); manifest (a member's name in the year's folder that the writer adds, or empty); report (a file for the list of archives); runs (true: runs are listed in the report, none is published)."""

    @classmethod
    def name(cls) -> str:
        return "yearzip"

    def schema(self) -> str:
        return "year int, arcname string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return Writer(dict(self.options), schema.fieldNames())


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.folder, self.job = options["path"].rstrip("/"), uuid.uuid4().hex
        self.stored = options.get("stored", "true").lower() == "true"
        self.manifest, self.report = options.get("manifest", "_manifest.json"), options.get("report", "")
        self.place = [columns.index(c) for c in ("year", "part", "arcname", "content") if c in columns]
        self.parts, self.runs = "part" in columns, options.get("runs", "false").lower() == "true"

    def _attempts(self) -> str:
        return child(self.folder, _ATTEMPTS, self.job)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done, open_, key = [], None, None
        seen = set()
        for b in iterator:
            for row in zip(*(b.column(i).to_pylist() for i in self.place), strict=True):
                year, part, arcname, content = row if self.parts else (row[0], None, *row[1:])
                if (year, part) != key:
                    if open_:
                        done.append(open_.run() if self.runs else open_.close())
                    key = (year, part)
                    if key in seen:
                        raise ValueError(f"rows of {year} come in several runs; sort them by year")
                    seen.add(key)
                    name = f"{year}.zip" if part is None else f"{year}-{part}.zip"
                    open_ = _Archive(self._attempts(), year, name, self.stored, self.manifest)
                if arcname is not None:
                    open_.add(arcname, content or b"")
        if open_:
            done.append(open_.run() if self.runs else open_.close())
        return Written([], [astuple(r) for r in done]) if self.runs else Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        if self.runs:
            replaced(self.report, json.dumps([r for m in messages if m for r in m.runs]).encode())
            return
        files = sorted(f for m in messages if m for f in m.files)
        names = [name for _, name, _, _ in files]
        if len(set(names)) < len(names):
            raise ValueError("several tasks wrote one archive: " + ", ".join(sorted({n for n in names if names.count(n) > 1})))
        published(self.folder, self._attempts(), files)
        if self.report:
            replaced(self.report, json.dumps([[year, child(self.folder, name), n] for year, name, _, n in files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        deleted(self._attempts())


class _Archive:
    """One archive of one task."""

    def __init__(self, folder: str, year: int, name: str, stored: bool, manifest: str):
        self.year, self.name, self.manifest, self.n, self.names = year, name, manifest, 0, hashlib.sha256()
        self.first, self.last = None, None
        self.path = child(folder, f"{uuid.uuid4().hex}.zip")
        self.system, self.inside = located(self.path)
        self.system.create_dir(self.inside.rpartition("/")[0])
        self.out = self.system.open_output_stream(self.inside)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED, compresslevel=None if stored else 1)

    def add(self, arcname: str, content: bytes) -> None:
        self.zip.writestr(arcname, content)
        self.names.update(arcname.encode() + b"\n")
        self.n += 1
        self.first, self.last = arcname if self.first is None else self.first, arcname

    def run(self) -> Run:
        """Close it as a run, which is verified where it goes."""
        names = sum(len(i.filename.encode()) for i in self.zip.infolist())
        self.zip.close()
        self.out.close()
        with self.system.open_input_file(self.inside) as f:
            size = directory(f)[0]
        return Run(self.year, self.name, self.path, self.n, self.first, self.last, names, self.names.hexdigest(), size)

    def close(self) -> tuple[int, str, str, int]:
        n = self.n
        if self.manifest:
            self.add(f"{self.year}/{self.manifest}", json.dumps({"year": self.year, "pdf_count": n}).encode())
        self.zip.close()
        self.out.close()
        found = hashlib.sha256()
        with self.system.open_input_file(self.inside) as f, zipfile.ZipFile(f) as check:
            for name in check.namelist():
                found.update(name.encode() + b"\n")
            if len(check.namelist()) != self.n or found.digest() != self.names.digest() or check.testzip() is not None:
                raise ValueError(f"{self.path} doesn't hold what was written")
        return self.year, self.name, self.path, n


def published(folder: str, job: str, files: list[tuple[int, str, str, int]]) -> None:
    """Publish files of a job's folder under their names."""
    finish(folder)
    if files:
        replaced(child(job, "commit.json"), json.dumps([[source.rpartition("/")[2], name] for _, name, source, _ in files]).encode())
        finish(folder)


def ordered(runs: list[Run]) -> list[Run]:
    """An archive's runs by their names, which mustn't overlap."""
    runs = sorted(runs, key=lambda r: (r.first or "").encode())
    some = [r for r in runs if r.n]
    if any(a.last.encode() >= b.first.encode() for a, b in zip(some, some[1:])):
        raise ValueError(f"several tasks wrote the same part of {runs[0].name}")
    return runs


def placed(runs: list[Run], full: int = _FULL) -> bytes:
    """Give runs their places, one behind the other; returns the archive's end record."""
    at = 0
    for r in runs:
        r.at, r.wide = at, at + r.size >= full
        at += r.size
    begin = at
    for r in runs:
        r.entries_at = at
        at += r.entries
    n, wide = sum(r.n for r in runs), b""
    if n >= 0xFFFF or at >= full:
        wide = _END64.pack(b"PK\x06\x06", _END64.size - 12, 45, 45, 0, 0, n, n, at - begin, begin) + _LOCATOR.pack(b"PK\x06\x07", 0, at, 1)
    return wide + _END.pack(b"PK\x05\x06", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), min(at - begin, _FULL), min(begin, _FULL), 0)


def _members(r: Run, out) -> None:
    """The members of a run, in blocks."""
    system, inside = located(r.path)
    with system.open_input_file(inside) as f:
        for at in range(0, r.size, _BLOCK):
            out.write(f.read_at(min(_BLOCK, r.size - at), at))


def _moved(r: Run) -> bytes:
    """The entries of a run as the archive's directory has them."""
    system, inside = located(r.path)
    with system.open_input_file(inside) as f:
        begin, end, _ = directory(f)
        data = f.read_at(end - begin, begin)
    at, n, done = 0, 0, bytearray()
    while at < len(data):
        next_, (_, size, packed, _, _, offset) = _entry(data, at, 0)
        v = list(_ENTRY.unpack_from(data, at))
        v[10], v[11], v[13], v[18] = packed, size, r.wide * _WIDE.size, _FULL if r.wide else offset + r.at
        v[3] = max(v[3], 45) if r.wide else v[3]
        done += _ENTRY.pack(*v) + data[at + _ENTRY.size : at + _ENTRY.size + v[12]]
        if r.wide:
            done += _WIDE.pack(1, 8, offset + r.at)
        at, n = next_, n + 1
    if begin != r.size or n != r.n or len(done) != r.entries:
        raise ValueError(f"{r.path} isn't as it was written")
    return bytes(done)


def _verify(r: Run, f) -> None:
    """Read a run's entries and members back from the archive."""
    n, names, end = 0, hashlib.sha256(), r.entries_at + r.entries
    for _, e in _entries(f, r.entries_at, end, 0, r.entries_at, end) if r.n else ():
        member_bytes(f, *e)
        if _local_name(f, e[5])[0] != e[0].encode():
            raise ValueError(f"{r.name}: {e[0]} isn't where its entry says")
        names.update(e[0].encode() + b"\n")
        n += 1
    if n != r.n or names.hexdigest() != r.digest:
        raise ValueError(f"{r.name} doesn't hold what was written")


def joined(spark: SparkSession, job: str, runs: list[Run], manifest: str, stored: bool, inside_files: bool | None = None) -> list[tuple[int, str, str, int]]:
    """Archives of runs, each a file of the job's folder: year, name, file, members without the manifest.

    inside_files tells whether tasks write at places of one file; unless given, they do where the folder is local or mounted.
    """
    if inside_files is None:
        inside_files = isinstance(located(job)[0], fs.LocalFileSystem)
    own: dict[str, list[Run]] = {}
    for r in runs:
        own.setdefault(r.name, []).append(r)
    archives_, tasks = [], []
    for name, some in sorted(own.items()):
        year, n, some = some[0].year, sum(r.n for r in some), ordered(some)
        if manifest:
            told = _Archive(job, year, name, stored, "")
            told.add(f"{year}/{manifest}", json.dumps({"year": year, "pdf_count": n}).encode())
            some.append(told.run())
        end = placed(some)
        archives_.append((year, name, n))
        if inside_files:
            path = child(job, f"{uuid.uuid4().hex}.zip")
            with open(located(path)[1], "wb") as f:
                f.seek(some[-1].entries_at + some[-1].entries)
                f.write(end)
            tasks += [(name, path, [r], end) for r in some]
        else:
            tasks.append((name, None, some, end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                name, path, some, end = tasks[i]
                if path:
                    with open(located(path)[1], "r+b") as out:
                        for r in some:
                            out.seek(r.at)
                            _members(r, out)
                            out.seek(r.entries_at)
                            out.write(_moved(r))
                        out.flush()
                        os.fsync(out.fileno())
                else:
                    path = child(job, f"{uuid.uuid4().hex}.zip")  # this attempt's own
                    system, inside = located(path)
                    with system.open_output_stream(inside) as out:
                        for r in some:
                            _members(r, out)
                        for r in some:
                            out.write(_moved(r))
                        out.write(end)
                system, inside = located(path)
                with system.open_input_file(inside) as f:
                    directory(f)
                    for r in some:
                        _verify(r, f)
                yield pa.RecordBatch.from_pydict({"name": [name], "path": [path]})

    done = spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(run, "name string, path string").collect()  # a row a run
    if len(done) != len(tasks):
        raise ValueError("not all runs were placed")
    paths = {r.name: r.path for r in done}
    return [(year, name, paths[name], n) for year, name, n in archives_]


def finish(folder: str) -> None:
    """Publish what committed jobs have listed: renames that were done are skipped, then the job's folder goes."""
    system, root = located(folder)
    attempts = f"{root.rstrip('/')}/{_ATTEMPTS}"
    jobs = system.get_file_info(fs.FileSelector(attempts, allow_not_found=True))
    for job in jobs:
        plan = f"{job.path}/commit.json"
        if system.get_file_info(plan).type == fs.FileType.NotFound:
            continue  # still writing, or failed
        with system.open_input_stream(plan) as f:
            renames = json.loads(f.read())
        for source, name in renames:
            if system.get_file_info(f"{job.path}/{source}").type != fs.FileType.NotFound:
                system.move(f"{job.path}/{source}", f"{root.rstrip('/')}/{name}")
        system.delete_dir(job.path)
    if jobs and not system.get_file_info(fs.FileSelector(attempts, allow_not_found=True)):
        system.delete_dir(attempts)


def archives(entries: DataFrame, folder: str, stored: bool = True, manifest: str = "_manifest.json", parts: int = 1, run_bytes: int = 64 << 20) -> DataFrame:
    """The ZIPs of (year, arcname, content), or of (year, arcname) and a member's location; returns year, path, entries.

    With a location, only names move, and the tasks read each member where it lies; content then is for
    members that lie nowhere yet, whose archive is null. Members lie in the order of their names, and a task takes about `run_bytes` of them, whatever the
    archive's size. `parts` over 1 deals a year by its names to as many archives <year>-<part>.zip.
    """
    spark = entries.sparkSession
    key = ["year", "part"] if parts > 1 else ["year"]
    if parts > 1:
        entries = entries.withColumn("part", F.pmod(F.crc32(F.coalesce("arcname", F.lit(""))), F.lit(parts)).cast("int"))
    lies = set(LOCATION) <= set(entries.columns)
    some = [c for c in ("content", *LOCATION) if c == "content" or lies]
    if "content" not in entries.columns:
        entries = entries.withColumn("content", F.lit(None).cast("binary"))
    size = F.coalesce(F.octet_length("content"), F.col("bytes"), F.when(F.col("archive").isNotNull(), 1 << 20)) if lies else F.octet_length("content")
    total = entries.agg(F.sum(F.coalesce(size, F.lit(0)) + 256)).first()[0] or 0  # a file whose length isn't known counts as 1 MB
    n = max(spark.sparkContext.defaultParallelism, -(-total // run_bytes))
    rows = entries.select(*key, "arcname", *some).repartitionByRange(n, *key, "arcname").sortWithinPartitions(*key, "arcname")
    if lies:
        rows = with_content(rows, "_read").withColumn("content", F.coalesce("content", "_read"))
    report = child(shared_path(spark, "archives"), "report.json")
    spark.dataSource.register(YearZip)
    out = rows.select(*key, "arcname", "content").write.format("yearzip").mode("append")
    out.options(path=folder, stored=str(stored).lower(), report=report, runs="true").save()
    system, inside = located(report)
    with system.open_input_stream(inside) as f:
        runs = [Run(*r) for r in json.loads(f.read())]  # a row a run
    deleted(report.rpartition("/")[0])
    done = []
    if runs:
        job = runs[0].path.rpartition("/")[0]
        try:
            done = joined(spark, job, runs, manifest, stored)
            published(folder, job, done)
        except BaseException:
            system, inside = located(child(job, "commit.json"))
            if system.get_file_info(inside).type == fs.FileType.NotFound:  # else the next commit finishes it
                deleted(job)
            raise
    return spark.createDataFrame([(year, child(folder, name), n) for year, name, _, n in done], "year int, path string, entries int")
