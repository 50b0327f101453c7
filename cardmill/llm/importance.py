"""Importance resampling of documents towards a target: weights by hashed n-grams, drawn by Gumbel's top k.

A feature is a run of 1 to `runs` consecutive words joined by one space; its bucket is the CRC-32 of its bytes modulo `buckets`. One scan
of a text keeps a ring of running CRC states, one for each of the last `runs` starts: a word extends each of them by a space and its
bytes and opens its own, so a feature costs one call and its string is never built. Texts are scanned in slices of
`SLICE` bytes, the ring going on from one to the next, so a text of any length costs no more than itself.

Counts of buckets are added up in each task and then among tasks; the gains are a table of `buckets` numbers, whose size is a parameter,
and go to every task. Two scans of the corpus, one for its counts and one for the weights, shuffle only these and a row of numbers for
each document. Ranks come from ranges of the order and their counts (operators.numbering), never from one task.

Nulls: a null text has no words; a null doc_id hashes as "<seed>:" and goes behind all others of its score. Texts without
words weigh 0. Repeated rows are drawn each on its own, though with equal scores. An empty corpus gives an empty result, an empty target gains
from its smoothing alone; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from .fill_middle import hash_group
from .store import arrow_limits, documents, dropped, free_names, written
from .words import column, release

SLICE = 1 << 18
_WORD = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
_FOLD = bytes(b if b in _WORD else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@dataclass(frozen=True)
class Sampling:
    runs: int = 3
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 5
    seed: int = 42


def slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, lists of a slice's each; a word is in one list whole."""
    at, n = 0, len(text)
    while at < n:
        to = at + SLICE
        part = text[at:to].translate(_FOLD)
        while to < n and part[-1] != 32:  # a word goes on
            more = text[to : to + 4096].translate(_FOLD)
            end = more.find(b" ")
            part += more if end < 0 else more[: end + 1]
            to += len(more) if end < 0 else end + 1
        yield part.split()
        at = to


def bucket_runs(text: bytes, s: Sampling) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of all features that end in them) of each slice of a text."""
    ring: list[int] = []
    keep = s.runs - 1
    for words in slices(text):
        out: list[int] = []
        for w in words:
            spaced = b" " + w
            ring = [crc32(spaced, x) for x in ring[-keep:]] if keep else []
            ring.append(crc32(w))
            out += ring
        yield len(words), np.array(out, np.int64) % s.buckets


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for x in column(batch, "text").cast(pa.large_binary()):
        yield x.as_py() or b""


def bucket_counts(texts: DataFrame, s: Sampling = Sampling()) -> DataFrame:
    """bucket and n of all features of the column text; buckets without any are left out."""
    arrow_limits(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.buckets, np.int64)
        for b in batches:
            for text in _texts(b):
                for _, found in bucket_runs(text, s):
                    total += np.bincount(found, minlength=s.buckets)
            release()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, s: Sampling = Sampling()) -> np.ndarray:
    """Each bucket's gain: the floor of 1000 times the logarithm of its smoothed share of the target over that of the corpus."""
    spark = corpus.sparkSession
    counts = spark.range(s.buckets).select(F.col("id").cast("int").alias("bucket"))
    for df, name in ((corpus, "s"), (target, "t")):
        counts = counts.join(df.select("bucket", F.col("n").cast("double").alias(name)), "bucket", "left")
    counts = counts.na.fill(0.0, ["s", "t"])
    rows = counts.collect()  # as many as the parameter says
    s_all, t_all = sum(r.s for r in rows), sum(r.t for r in rows)
    out = np.zeros(s.buckets, np.int64)
    b = float(s.buckets)
    for r in rows:
        out[r.bucket] = int(np.floor(1000.0 * np.log((r.t + 1.0) * (s_all + b) / ((r.s + 1.0) * (t_all + b)))))
    return out


def weighed(docs: DataFrame, gain: np.ndarray, s: Sampling = Sampling()) -> DataFrame:
    """doc_id, n_words, n_features and weight of each row: the sum of its features' gains."""
    arrow_limits(docs.sparkSession)
    names = ["doc_id", "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in _texts(b):
                words = features = weight = 0
                for n, found in bucket_runs(text, s):
                    words, features, weight = words + n, features + len(found), weight + int(gain[found].sum())
                out.append((words, features, weight))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), *(pa.array([x[i] for x in out], pa.int64()) for i in range(3))], names)
            release()

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def drawn(weights: DataFrame, s: Sampling = Sampling()) -> DataFrame:
    """weights (written, see weighed) with score and rank: of the N rows with words enough, floor(percent * N / 100) have a rank."""
    row, number = free_names(weights, "row", "number")
    h = hash_group(F.col("doc_id"), s.seed, 0).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    may = F.col("n_words") >= s.least_words
    scored = weights.withColumns({"score": F.col("weight") + noise, row: F.monotonically_increasing_id()})
    most = weights.filter(may).count() * s.percent // 100
    out = numbered(scored, [may.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col(row)], number)
    return out.withColumn("rank", F.when(may & (F.col(number) <= most), F.col(number))).drop(row, number)


def resampled(docs: DataFrame, target: DataFrame, s: Sampling = Sampling()) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of all documents."""
    gain = gains(bucket_counts(docs, s), bucket_counts(target, s), s)
    table = written(weighed(docs, gain, s), "weighed")
    out = drawn(table, s)
    dropped(table)  # its rows are in ranges now
    return out


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    out = resampled(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
