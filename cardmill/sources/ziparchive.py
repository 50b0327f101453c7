"""Members of year archives as rows, without one task an archive.

The source "zipindex" deals each archive's central directory to partitions by ranges of its bytes; planning reads the end record of the
archives that the pushed filters leave, and nothing else. A range that begins inside the directory looks for the next entry:
its signature, a chain of entries behind it, and a local header of the same name where it points. Rows say where a
member's bytes lie, so contents are a second step (`with_content`) on the rows that are left after any filter
or shuffle: one ranged read a member, checked by length and CRC-32.
"""

from __future__ import annotations

import bz2
import re
import struct
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from .storage import child, listed, located, stem

_YEAR = re.compile(r"(\d{4})(?:$|[-_.])")
_SCHEMA = "year int, archive string, archive_rank int, member_index long, member string, bytes long, packed_bytes long, method int, crc long, header_offset long"
_ARROW = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[t]) for n, t in (x.split() for x in _SCHEMA.split(", "))])
#: Where a member's bytes lie; the columns that with_content needs.
LOCATION = ["archive", "member", "bytes", "packed_bytes", "method", "crc", "header_offset"]

# Records of the ZIP format.
_ENTRY = struct.Struct("<4s4B4HL2L5H2L")
_END = struct.Struct("<4s4H2LH")
_END64 = struct.Struct("<4sQ2H2L4Q")
_LOCAL = struct.Struct("<4s2B4HL2L2H")
_FULL = 0xFFFFFFFF


def year_archives(folder: str, years: range | None = None, repair: bool = True) -> list[str]:
    """ZIP files named for a year, sorted; without those of repairs where repair is false."""
    out = []
    for f in listed(folder, ".zip"):
        found = _YEAR.match(stem(f.path))
        if found and (years is None or int(found[1]) in years) and (repair or "-repair" not in stem(f.path)):
            out.append(child(folder, f.base_name))
    return out


class NotAnArchive(ValueError):
    pass


def directory(file) -> tuple[int, int, int]:
    """(begin, end, base) of an archive's central directory; base is what its own offsets lack."""
    size = file.size()
    tail_at = max(0, size - (1 << 16) - 22)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0 or len(tail) - at < 22:
        raise NotAnArchive("no end of a central directory")
    _, _, _, _, _, length, offset, _ = _END.unpack_from(tail, at)
    end = tail_at + at
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        record_at = end - 20 - _END64.size
        record = _END64.unpack(file.read_at(_END64.size, record_at)) if record_at >= 0 else (b"",)
        if record[0] == b"PK\x06\x06":
            length, offset, end = record[8], record[9], record_at
    begin = end - length
    if begin < 0 or begin < offset:
        raise NotAnArchive("the central directory isn't where its end says")
    return begin, end, begin - offset


class _Filter:
    """Comparisons of year and equalities of archive."""

    def __init__(self):
        self.tests: list[tuple[str, str, object]] = []

    def take(self, f) -> bool:
        kinds = {EqualTo: "eq", In: "in", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}
        column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else ""
        kind = kinds.get(type(f))
        if kind is None or not (column == "year" or (column == "archive" and kind in ("eq", "in"))):
            return False
        self.tests.append((column, kind, f.value))
        return True

    def keeps(self, archive: str, year: int) -> bool:
        def holds(column, kind, v):
            x = year if column == "year" else archive
            return v is not None and {"eq": lambda: x == v, "in": lambda: x in v, "gt": lambda: x > v, "ge": lambda: x >= v, "lt": lambda: x < v, "le": lambda: x <= v}[kind]()

        return all(holds(*t) for t in self.tests)


class ZipIndex(DataSource):
    """Options paths (one a line), permissive (true: skip files that are no ZIP), rangeBytes (of the directory) and contentBytes (of the archive) for a partition."""

    @classmethod
    def name(cls) -> str:
        return "zipindex"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Range(InputPartition):
    def __init__(self, *value):
        super().__init__(value)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("paths", "").split("\n") if p]
        self.permissive = options.get("permissive", "false").lower() == "true"
        self.range_bytes, self.content_bytes = int(options.get("rangeBytes", 4 << 20)), int(options.get("contentBytes", 0))
        self.filter = _Filter()

    def pushFilters(self, filters):
        return [f for f in filters if not self.filter.take(f)]

    def _ranges(self, found: tuple[str, int, int]) -> list[InputPartition]:
        path, year, rank = found
        system, inside = located(path)
        with system.open_input_file(inside) as f:
            try:
                begin, end, base = directory(f)
            except NotAnArchive as e:
                if self.permissive:
                    return [_Range()]  # a partition without rows
                raise ValueError(f"{path}: {e}") from e
            n = max(1, -(-(end - begin) // self.range_bytes), -(-f.size() // self.content_bytes) if self.content_bytes else 1)
        step = max(1, -(-(end - begin) // n))
        return [_Range(path, year, rank, begin, end, base, at, min(at + step, end)) for at in range(begin, end, step)]

    def partitions(self) -> list[InputPartition]:
        found, ranks = [], {}
        for p in self.paths:
            m = _YEAR.match(stem(p))
            year = int(m[1]) if m else 0
            ranks[year] = ranks.get(year, -1) + 1
            if self.filter.keeps(p, year):
                found.append((p, year, ranks[year]))
        with ThreadPoolExecutor(16) as pool:
            out = [r for rs in pool.map(self._ranges, found) for r in rs]
        return out or [_Range()]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.value:
            return
        path, year, rank, begin, end, base, first, last = partition.value
        system, inside = located(path)
        with system.open_input_file(inside) as f:
            held = []
            for at, e in _entries(f, begin, end, base, first, last):
                held.append((year, path, rank, at - begin, *e))
                if len(held) == 8192:
                    yield _batch(held)
                    held = []
            if held:
                yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


def _entry(data: bytes, at: int, base: int) -> tuple[int, tuple] | None:
    """Where the entry at `at` ends, and (member, bytes, packed_bytes, method, crc, header_offset); None where there is none or not all of it."""
    if len(data) - at < _ENTRY.size or data[at : at + 4] != b"PK\x01\x02":
        return None
    v = _ENTRY.unpack_from(data, at)
    flags, method, crc, packed, size, n_name, n_extra, n_comment, offset = v[5], v[6], v[9], v[10], v[11], v[12], v[13], v[14], v[18]
    name_at = at + _ENTRY.size
    end = name_at + n_name + n_extra + n_comment
    if end > len(data):
        return None
    extra, i = data[name_at + n_name : name_at + n_name + n_extra], 0
    while i + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, i)
        if kind == 1:  # sizes of eight bytes, those that don't fit, in this order
            j, stop = i + 4, min(i + 4 + n, len(extra))
            wide = [int.from_bytes(extra[k : k + 8], "little") for k in range(j, stop - 7, 8)]
            size, packed, offset = (wide.pop(0) if x == _FULL and wide else x for x in (size, packed, offset))
        i += 4 + n
    name = data[name_at : name_at + n_name].decode("utf-8" if flags & 0x800 else "cp437", "replace").split("\0")[0]
    return end, (name, size, packed, method, crc, offset + base)


def _local_name(f, offset: int) -> tuple[bytes, int]:
    """The raw name of a local header, and where its data begins."""
    head = f.read_at(_LOCAL.size, offset)
    if len(head) < _LOCAL.size or head[:4] != b"PK\x03\x04":
        return b"", -1
    n_name, n_extra = _LOCAL.unpack(head)[-2:]
    return f.read_at(n_name, offset + _LOCAL.size), offset + _LOCAL.size + n_name + n_extra


def _entries(f, begin: int, end: int, base: int, first: int, last: int, block: int = 1 << 20, chain: int = 8) -> Iterator[tuple[int, tuple]]:
    """(place, entry) of all entries that begin in [first, last)."""
    held_at, data = first, b""

    def more() -> bool:
        nonlocal data
        got = f.read_at(min(block, end - held_at - len(data)), held_at + len(data))
        data += got
        return bool(got)

    def entry(at: int):
        """The entry at a place of the file, reading on as far as it takes."""
        while (e := _entry(data, at - held_at, base)) is None:
            if not b"PK\x01\x02".startswith(data[at - held_at : at - held_at + 4]) or not more():
                return None
        return e

    def begins(at: int) -> bool:
        """Whether an entry begins here: it chains with those behind it, and its local header has its name."""
        here, e = at, entry(at)
        first_entry = e
        for _ in range(chain):
            if e is None:
                return here == end and first_entry is not None
            here = held_at + e[0]
            if here == end:
                break
            e = entry(here)
        if e is None and here != end:
            return False
        raw_at = at - held_at + _ENTRY.size
        raw = data[raw_at : raw_at + int.from_bytes(data[at - held_at + 28 : at - held_at + 30], "little")]
        return _local_name(f, first_entry[1][5])[0] == raw

    at = first
    if first != begin:
        while True:
            found = data.find(b"PK\x01\x02", at - held_at)
            if found < 0:
                at = max(at, held_at + len(data) - 3)
                if at >= last + 3 or not more():
                    return
                continue
            at = held_at + found
            if at >= last:
                return
            if begins(at):
                break
            at += 1
    while at < last:
        if at - held_at > block:
            data, held_at = data[at - held_at :], at
        e = entry(at)
        if e is None:
            raise ValueError(f"the central directory breaks off at byte {at}")
        yield at, e[1]
        at = held_at + e[0]


def member_bytes(f, name: str, size: int, packed: int, method: int, crc: int, offset: int) -> bytes:
    """A member's content, checked."""
    _, at = _local_name(f, offset)
    if at < 0:
        raise ValueError(f"{name}: no local header at byte {offset}")
    data = f.read_at(packed, at)
    if method == 8:
        data = zlib.decompressobj(-15).decompress(data)
    elif method == 12:
        data = bz2.decompress(data)
    elif method:
        raise ValueError(f"{name}: compression method {method} isn't known")
    if len(data) != size or zlib.crc32(data) != crc:
        raise ValueError(f"{name}: bad CRC or length")
    return data


def with_content(rows: DataFrame, name: str = "content", most: int = 8 << 20) -> DataFrame:
    """Rows that have the columns of LOCATION, with their bytes. A null header_offset means a loose file at `archive`; a null archive has no content.

    Rows keep their partitions and order, and batches end behind `most` bytes.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for b in batches:
            begin, held, size = 0, [], 0
            for i, row in enumerate(b.select(LOCATION).to_pylist()):
                path = row["archive"]
                if path is not None and path != opened:
                    if file:
                        file.close()
                    system, inside = located(path)
                    file, opened = system.open_input_file(inside), path
                if path is None:
                    held.append(None)
                elif row["header_offset"] is None:
                    held.append(file.read_at(file.size(), 0))
                else:
                    held.append(member_bytes(file, row["member"], row["bytes"], row["packed_bytes"], row["method"], row["crc"], row["header_offset"]))
                size += len(held[-1] or b"")
                if size > most:
                    yield pa.RecordBatch.from_arrays([*b.slice(begin, len(held)).columns, pa.array(held, pa.binary())], [*b.schema.names, name])
                    begin, held, size = i + 1, [], 0
            if held:
                yield pa.RecordBatch.from_arrays([*b.slice(begin, len(held)).columns, pa.array(held, pa.binary())], [*b.schema.names, name])
        if file:
            file.close()

    return rows.mapInArrow(run, schema)


def zip_members(spark: SparkSession, paths: list[str], content: bool = False, permissive: bool = False, range_bytes: int = 4 << 20, content_bytes: int = 128 << 20, to_read: bool = False) -> DataFrame:
    """Members of all archives, folders among them; filters of year and archive choose what is opened.

    member_index is the place of a member's entry in the directory's bytes, so it grows with the order of members. Where contents are
    read, at once or (to_read) by with_content later, a partition stands for about content_bytes of an archive.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # this source has filters to push, which Spark else refuses
    spark.dataSource.register(ZipIndex)
    options = {"paths": "\n".join(paths), "permissive": str(permissive).lower(), "rangeBytes": range_bytes, "contentBytes": content_bytes if content or to_read else 0}
    rows = spark.read.format("zipindex").options(**options).load()
    return with_content(rows.filter(~F.endswith("member", F.lit("/")))) if content else rows


def usable_archives(members: DataFrame) -> DataFrame:
    """Archives that hold a PDF or a manifest."""
    name = F.lower("member")
    return members.groupBy("year", "archive").agg(F.bool_or(F.endswith(name, F.lit(".pdf")) | F.endswith(name, F.lit("_manifest.json"))).alias("usable")).filter("usable").select("year", "archive")
