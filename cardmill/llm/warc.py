"""WARC archives of pages, read back, and their index merged from sorted runs.

Writing. Pages with equal payloads of at least `least_revisit` bytes become one response (the largest
page_id) and revisits of it; the records go out through Spark's text writer, which puts raw
bytes with CRLF between them to any file system that Spark knows, as gzip files of at
most `per_file` records. A revisit keeps the headers of its capture, so its payload's length and
digest stay known without its bytes.

Reading. Files come whole (their size is bounded by `per_file`), and the length headers
frame the records, so payloads may hold anything, WARC headers included. Each file gives a run of index
entries sorted by URL key, timestamp and page_id. Ranges of that order are dealt to tasks,
and each task merges the runs of its range with a loser tree, k ways at once. Equal URLs don't
share a task's fate: the range bounds may fall between their captures.

Nulls: a null html is an empty payload, a null url is "about:blank"; a null page_id stays null and
is neither largest nor referred to. Rows that repeat the largest page_id of a payload are responses like it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import arrow_limits, documents, new_path, written
from .words import column

CRLF = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes: five hexadecimal digits are four of base 32."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def capture_time(page_id: Column) -> Column:
    """The pages have no time of capture; their order gives one, a second apart, between the first and the last second of four-digit years.

    Ids beyond share these times, and the index puts equal times in the order of ids.
    """
    second = F.greatest(F.least(F.coalesce(page_id, F.lit(0)), F.lit(253402300799)), F.lit(-62135596800))
    return F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def records(pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """One WARC record for each row of pages, without its last CRLF."""
    html = F.coalesce("html", F.lit(""))
    p = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\x00-\x20\x7f]", "%20").alias("url"), html.alias("html"))
    p = p.withColumns({"digest": base32_sha1(F.col("html")), "n": F.octet_length("html").cast("long")})
    first = p.filter(F.col("n") >= least_revisit).groupBy("digest").agg(F.max_by(F.struct("page_id", "url"), F.col("page_id")).alias("o"))
    p = p.join(first, "digest", "left")
    revisit = F.col("o.page_id").isNotNull() & ((F.col("page_id") != F.col("o.page_id")) | F.col("page_id").isNull())
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    refers = F.concat(F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: "), ident(F.col("o.page_id")), F.lit(f"{CRLF}WARC-Refers-To-Target-URI: "), F.col("o.url"), F.lit(CRLF))
    return p.select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
            F.lit(f"{CRLF}WARC-Record-ID: "), ident(F.col("page_id")),
            F.lit(f"{CRLF}WARC-Date: "), capture_time(F.col("page_id")),
            F.lit(f"{CRLF}WARC-Target-URI: "), F.col("url"), F.lit(CRLF),
            F.when(revisit, refers).otherwise(F.lit("")),
            F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"),
            F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length(block),
            F.lit(CRLF * 2), block, F.lit(CRLF),
        ).alias("value")
    )


def write_archives(pages: DataFrame, path: str, least_revisit: int = 0, per_file: int = 4096) -> None:
    records(pages, least_revisit).write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def url_key(url: str) -> str:
    """A sort key: the host's labels from the last on, then path and query, in lower case and without www and fragment."""
    rest = url.split("://", 1)[-1].split("#", 1)[0].lower()
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].removesuffix(":80").removesuffix(":443").removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + slash + path


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of an archive's bytes."""
    at, n = 0, len(data)
    while at < n:
        if data[at : at + 7] != b"WARC/1.":
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(CRLF)[1:]
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        to = end + 4 + int(head["content-length"])
        if data[to : to + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length than it says")
        yield at, to + 4 - at, head, data[end + 4 : to]
        at = to + 4


_ENTRY = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, captured string, file string, file_offset long, file_length long"
_FIELDS = [x.split()[0] for x in _ENTRY.split(", ")]
_ARROW = pa.schema([(n, pa.int64() if x.endswith("long") else pa.string()) for n, x in zip(_FIELDS, _ENTRY.split(", "), strict=True)])
_SORT = lambda r: (r[5], r[6], r[0] is not None, r[0] or 0, r[7], r[8])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_ARROW.types)], schema=_ARROW)


def _id(urn: str | None) -> int | None:
    found = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(found) if found else None


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted run of index entries for each archive."""
    for b in batches:
        for i in range(b.num_rows):
            name = column(b, "path")[i].as_py().rpartition("/")[2]
            run = []
            for at, n, head, block in parse(gzip.decompress(column(b, "content")[i].as_py())):
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                size = int(next(x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
                if head["warc-type"] == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if (found, len(payload)) != (digest, size):
                        raise ValueError(f"{name}: the payload at byte {at} isn't what its headers say")
                run.append((_id(head["warc-record-id"]), size, digest, head["warc-type"], _id(head.get("warc-refers-to")), url_key(head["warc-target-uri"]), head["warc-date"], name, at, n))
            run.sort(key=_SORT)
            if run:
                yield _table(run)


class LoserTree:
    """Merges sorted runs: every node keeps the loser of its match, so each step replays one path to the root."""

    def __init__(self, runs: list[list[tuple]], key=_SORT):
        self.runs, self.k = [iter(r) for r in runs], len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.key, self.tree = key, [-1] * max(self.k, 1)
        for i in range(self.k):
            self._replay(i)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; ended runs go last."""
        x, y = self.keys[a], self.keys[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _replay(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            if self.tree[node] == -1:  # the first to come waits for its opponent
                self.tree[node] = i
                return
            if self._less(self.tree[node], i):
                self.tree[node], i = i, self.tree[node]
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[i := self.tree[0]] is not None:
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            self.keys[i] = None if self.heads[i] is None else self.key(self.heads[i])
            self._replay(i)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of one range. Rows of a run arrive in its order; should a fetch disturb that, the run splits where the order breaks."""
    runs: dict[str, list[list[tuple]]] = {}
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            own = runs.setdefault(row[7], [[]])
            if own[-1] and _SORT(own[-1][-1]) > _SORT(row):
                own.append([])
            own[-1].append(row)
    held = []
    for row in LoserTree([r for own in runs.values() for r in own]):
        held.append(row)
        if len(held) == 8192:
            yield _table(held)
            held = []
    if held:
        yield _table(held)


def read_index(spark, path: str) -> DataFrame:
    """Index entries of all archives under path, one sorted run for each file."""
    arrow_limits(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(_runs, _ENTRY)


def merge_index(runs: DataFrame) -> DataFrame:
    """All entries in the order of URL key, timestamp and page_id, ranges of it in successive partitions."""
    return runs.repartitionByRange("url_key", "captured", "page_id").mapInArrow(_merge, _ENTRY)


def op6_warc_index_merge(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archives(documents(spark, sf_dir, "pages"), path)
    index = merge_index(written(read_index(spark, path), "warc-runs"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
