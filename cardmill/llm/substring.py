"""Substring deduplication: winnowed anchors as seeds, extended both ways, maximal repeats kept.

A window is `window` consecutive words of one text. The first least hash of the `anchor`-word
sequences in a window is its anchor, a function of the window's words alone; so two equal windows
have equal anchors at equal offsets, and every repeat of at least `window` words meets itself in an anchor.
Successive windows with one anchor form a stretch: the anchor, extended to the left and right as far as its
windows go.

1. Seeds: anchors are joined on their hash, pre-aggregated with their stretches. Where a whole stretch
   is found twice, all its windows are repeats.
2. Extension: where an anchor is found twice but a stretch is not, the match ends somewhere inside. The
   extensions of those stretches, one window after the other to both sides of the anchor, and of
   one representative of each other stretch of the anchor, are compared by the hash of all their words. No two occurrences are
   paired, so a passage of m texts costs m rows.
3. Maximal repeats: windows found twice merge into the longest runs of repeated words.

Anchors and windows are compared by 128 bits of independent hashes. Anchors, stretches and windows that very many places have are
joined by broadcast (`store.looked_up`), so no task meets all of them.

Nulls: a null text has no words; doc_id may be null or repeated (rows are told apart by doc_id and text, and
rows equal in both are repeats of each other like any). Texts under `window` words stay as they are. An empty table gives an empty result; other columns are untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import arrow_limits, documents, dropped, free_names, looked_up, written
from .words import Words, chunks, column, signed

SINGLE, KNOWN, REPEATED = 1, 2, 3  # a stretch to look into; one that stands for its equals; one found twice


@dataclass(frozen=True)
class Repeats:
    window: int = 35
    anchor: int = 8


_ANCHORS = "rid long, anchor long, stretch long, at int, n int"


def _anchors(r: Repeats):
    """(row, anchor hash, stretch hash, first window, number of windows) of each stretch."""
    span = r.window - r.anchor + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                w = Words(column(c, "text"))
                start, doc = w.windows(r.window)
                if not len(start):
                    continue
                every = np.arange(len(w.starts) - r.anchor + 1)
                h = w.seq_hash(every, every + r.anchor)
                seed = start + np.lib.stride_tricks.sliding_window_view(h, span)[start].argmin(1)
                new = np.ones(len(start), bool)
                new[1:] = (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.concatenate((first, [len(start)])))
                at = start[first]
                stretch = w.seq_hash(at, at + n - 1 + r.window, 1)
                # where the anchor lies in it is a function of its words, as is the number of windows
                rows = column(c, "rid").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[doc[first]]), pa.array(signed(h[seed[first]])), pa.array(signed(stretch)), pa.array((at - w.first[doc[first]]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["rid", "anchor", "stretch", "at", "n"],
                )

    return run


def _lists(arr: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows and fields of a column of lists of structs of integers; nulls are empty."""
    n = np.array(arr.value_lengths().fill_null(0))
    flat = arr.flatten()
    return np.repeat(np.arange(len(arr)), n), [flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(flat.type.num_fields)]


def _windows(r: Repeats):
    """The hashes of every window of the stretches to look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                w = Words(column(c, "text"))
                row, (at, n, kind) = _lists(column(c, "spans"))
                look = kind != REPEATED
                row, at, n, kind = row[look], at[look], n[look], kind[look]
                k = np.repeat(np.arange(len(n)), n)
                pos = np.arange(len(k)) - (np.cumsum(n) - n)[k] + at[k]
                s = pos + w.first[row[k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(w.seq_hash(s, s + r.window, i))) for i in (0, 1)] + [pa.array(column(c, "rid").to_numpy()[row[k]]), pa.array(pos.astype(np.int32)), pa.array(kind[k].astype(np.int32))],
                    ["w0", "w1", "rid", "pos", "kind"],
                )

    return run


def repeated_spans(docs: DataFrame, r: Repeats = Repeats()) -> tuple[DataFrame, DataFrame]:
    """docs with spans of repeated windows, array<struct<at, n, kind>> in a last column whose name docs doesn't have, in two parts:
    rows that needed no extension and the others. Word positions count from 0."""
    spark = docs.sparkSession
    arrow_limits(spark)
    rid, spans_, more_ = free_names(docs, "__rid", "__spans", "__more")
    names = docs.columns
    docs = docs.withColumn(rid, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    found = written(docs.select(F.col(rid).alias("rid"), "text").mapInArrow(_anchors(r), _ANCHORS), "anchors")
    # only occurrences of anchors that are found twice go on
    twice = written(found.groupBy("anchor").agg(F.count("*").alias("all")).filter("all > 1"), "anchors-twice")
    own = written(looked_up(found, twice, ["anchor"], "all").drop("all").withColumn("place", F.xxhash64("rid", "at")), "seeds")
    dropped(found, twice)
    stretch = written(own.groupBy("anchor", "stretch").agg(F.count("*").alias("same"), F.min("place").alias("one")), "stretches")
    kinds = written(stretch.groupBy("anchor").agg(F.count("*").alias("kinds")), "kinds")
    both = written(looked_up(stretch, kinds, ["anchor"], "kinds"), "kinds-of-stretches")
    known = (F.col("kinds") > 1) & (F.col("place") == F.col("one"))
    what = F.when(F.col("same") == 1, F.array(F.lit(SINGLE))).when(known, F.array(F.lit(KNOWN), F.lit(REPEATED))).otherwise(F.array(F.lit(REPEATED)))
    spans = looked_up(own, both, ["anchor", "stretch"], "same").select("rid", "at", "n", F.explode(what).alias("kind"))
    # rows equal in doc_id and text share a rid, and each of them gets the whole list: a span is in it once
    spans = spans.groupBy(F.col("rid").alias(rid)).agg(F.collect_set(F.struct("at", "n", "kind")).alias(spans_))
    # what the seeds have shuffled goes before the texts move
    listed = written(spans, "span-lists")
    dropped(own, stretch, kinds, both)
    joined = written(docs.join(listed, rid, "left").select(*names, rid, spans_), "spans")
    dropped(listed)

    look = F.exists(spans_, lambda x: x["kind"] != REPEATED)
    plain = joined.filter(F.col(spans_).isNull() | ~look)
    open_ = joined.filter(look)
    w = written(open_.select(F.col(rid).alias("rid"), "text", F.col(spans_).alias("spans")).mapInArrow(_windows(r), "w0 long, w1 long, rid long, pos int, kind int"), "windows")
    found = written(w.groupBy("w0", "w1").agg(F.sum("kind").alias("weight"), F.sum(F.when(F.col("kind") == SINGLE, 1).otherwise(0)).alias("rows")).filter("weight > 1"), "windows-twice")
    hit = looked_up(w.filter(F.col("kind") == SINGLE), found, ["w0", "w1"], "rows")
    hit = hit.groupBy(F.col("rid").alias(rid)).agg(F.collect_list(F.struct(F.col("pos").alias("at"), F.lit(1).alias("n"), F.lit(REPEATED).alias("kind"))).alias(more_))
    hit = written(hit, "hits")
    dropped(w, found)
    none = F.expr("array()").cast("array<struct<at:int,n:int,kind:int>>")
    closed = open_.join(hit, rid, "left").withColumn(spans_, F.concat(F.filter(spans_, lambda x: x["kind"] == REPEATED), F.coalesce(more_, none)))
    return plain.drop(rid), closed.select(*names, spans_)


def removed_words(w: Words, spans: pa.Array, window: int) -> np.ndarray:
    """Of each word of a chunk: whether a repeated window covers it."""
    row, (at, n, _) = _lists(spans)
    cover = np.zeros(len(w.starts) + 1, np.int32)
    s = at + w.first[row]
    np.add.at(cover, s, 1)
    np.add.at(cover, s + n - 1 + window, -1)
    return np.cumsum(cover[:-1]) > 0


def _finish(r: Repeats, make):
    """Per text: its words, and which of them go; make builds the batch from (chunk, removed counts, kept bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                w = Words(column(c, "text"))
                gone = removed_words(w, c.column(c.num_columns - 1), r.window)
                kept, n_gone = [], np.zeros(w.rows, np.int64)
                data = w.data.tobytes()
                for d in range(w.rows):
                    words = data[w.offs[d] : w.offs[d + 1]].split()
                    own = gone[w.first[d] : w.first[d + 1]]
                    n_gone[d] = own.sum()
                    kept.append((b" ".join(compress(words, (~own).tolist())) if n_gone[d] else b" ".join(words)))
                yield make(c, w, n_gone, kept)

    return run


def deduplicated(docs: DataFrame, r: Repeats = Repeats()) -> DataFrame:
    """docs without the words that repeats cover. A text that loses words has its other words joined by one space, and
    n_chars (if there) set to its length; all others stay as they are."""
    names, schema = docs.columns, docs.schema

    def make(c: pa.RecordBatch, w: Words, gone: np.ndarray, kept: list[bytes]) -> pa.RecordBatch:
        text = column(c, "text").to_pylist()
        cols = []
        for i, n in enumerate(names):
            col = c.column(i)
            if n == "text":
                col = pa.array([k.decode() if g else t for t, k, g in zip(text, kept, gone.tolist(), strict=True)], col.type)
            elif n == "n_chars":
                col = pa.array([len(k.decode()) if g else x for x, k, g in zip(col.to_pylist(), kept, gone.tolist(), strict=True)], col.type)
            cols.append(col)
        return pa.RecordBatch.from_arrays(cols, names)

    plain, closed = repeated_spans(docs, r)
    return plain.unionByName(closed).mapInArrow(_finish(r, make), schema)


def repeats(docs: DataFrame, r: Repeats = Repeats()) -> DataFrame:
    """The maximal runs of repeated words: doc_id, first_word, n_words, words (joined by one space)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                w = Words(column(c, "text"))
                gone = removed_words(w, c.column(c.num_columns - 1), r.window)
                cut = np.zeros(len(gone) + 1, bool)
                cut[w.first] = True
                first = np.flatnonzero(gone & (~np.concatenate(([False], gone[:-1])) | cut[:-1])) if len(gone) else np.zeros(0, int)
                last = np.flatnonzero(gone & (~np.concatenate((gone[1:], [False])) | cut[1:])) if len(gone) else np.zeros(0, int)
                doc = w.doc()[first]
                words = [b" ".join(w.word(i) for i in range(x, y + 1)).decode() for x, y in zip(first.tolist(), last.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([column(c, "doc_id").cast(pa.int64()).take(pa.array(doc)), pa.array(first - w.first[doc]), pa.array(last - first + 1), pa.array(words, pa.string())], ["doc_id", "first_word", "n_words", "words"])

    plain, closed = repeated_spans(docs.select("doc_id", "text"), r)
    return plain.unionByName(closed).mapInArrow(run, "doc_id long, first_word long, n_words long, words string")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    def make(c: pa.RecordBatch, w: Words, gone: np.ndarray, kept: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([column(c, "doc_id").cast(pa.int64()), pa.array(w.n.astype(np.int64)), pa.array(gone), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    r = Repeats()
    plain, closed = repeated_spans(documents(spark, sf_dir).select("doc_id", "text"), r)
    return plain.unionByName(closed).mapInArrow(_finish(r, make), "doc_id long, n_words long, n_removed long, kept_sha256 string")
