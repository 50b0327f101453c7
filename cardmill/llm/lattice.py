"""Sampled subword segmentation: forward filtering, backward sampling over the piece lattice.

The pieces come from a public vocabulary, with weights by their rank: log w = -temperature * ln(rank + 2). A
text gets one space in front, as in that vocabulary's own scheme, and a space stands for its
word mark. Pieces hold spaces at their front only and no line break, so a text's lattice falls into
independent stretches: a run of spaces with what follows it, and single line breaks. Forward sums are
taken once for each distinct stretch of a block of texts; each occurrence is then sampled backwards with
draws that are hashes of (seed, row key, number of the stretch, step). So a row's ids depend
on its key and text alone, whatever the partitions.

A character that is no piece falls back to the pieces of its bytes, as does the word mark itself where it is written in
a text. Decoding joins the pieces' bytes and drops the first space: it gives back each text exactly.

Nulls: a null text is empty and has no ids; a null key counts as 0. Repeated rows with one key and text get
equal ids. An empty table gives an empty result. Extra columns don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .store import arrow_limits, documents
from .words import U, _bytes_of, chunks, column, mix, span_hashes

BYTES_AT = 3  # id of the piece of byte 0, by the vocabulary's description
_BASE, _MOD = 1_000_003, U(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Sampling:
    seed: int = 17
    temperature: float = 2.0
    fallback: float = -30.0  # log weight of a byte
    path: str = ""


class Vocabulary:
    """Pieces as bytes, and for each length of prefix the hashes of all prefixes with the piece that they are."""

    def __init__(self, path: str, temperature: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [b"" if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        for b in range(256):
            pieces[BYTES_AT + b] = bytes([b])
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.lens = np.array([len(p) for p in pieces])
        self.at = np.cumsum(self.lens) - self.lens
        words = {p: i for i, p in enumerate(pieces) if p and not BYTES_AT <= i < BYTES_AT + 256}
        rank = {p: r for r, p in enumerate(words)}
        self.weight = np.zeros(n)
        for p, i in words.items():
            self.weight[i] = -temperature * np.log(rank[p] + 2)
        prefixes: dict[int, dict[int, int]] = {}
        for p, i in words.items():
            h = 0
            for k, byte in enumerate(p, 1):
                h = _step_int(h, byte)
                level = prefixes.setdefault(k, {})
                level[h] = i if k == len(p) else level.get(h, -1)
        self.levels = []
        for k in range(1, max(prefixes) + 1):
            h = np.array(list(prefixes[k]), np.uint64)
            order = np.argsort(h)
            self.levels.append((h[order], np.array(list(prefixes[k].values()))[order]))


def _hashed(n: int) -> np.uint64:
    return U(n * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)


def _step_int(h: int, byte: int) -> int:
    return ((h + byte + 1) * 0x9E3779B97F4A7C15 ^ (h >> 29)) & 0xFFFFFFFFFFFFFFFF


def _step(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return (h + byte.astype(U) + U(1)) * _MOD ^ (h >> U(29))


@lru_cache(maxsize=2)
def vocabulary(path: str, temperature: float) -> Vocabulary:
    if not path:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return Vocabulary(path, temperature)


def _stretches(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where the stretches of all texts begin."""
    space, line = data == 32, data == 10
    begin = np.zeros(len(data) + 1, bool)
    begin[offs] = True
    begin[1:-1] |= space[1:] & ~space[:-1]
    begin[:-1] |= line
    begin[1:] |= line
    return np.flatnonzero(begin[:-1])


def _distinct(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each stretch its number among the distinct ones; their bytes, and where each begins."""
    _, at, which = np.unique(span_hashes(data, begin, begin + length), return_index=True, return_inverse=True)
    own = np.concatenate(([0], np.cumsum(length[at])))
    spread = lambda first, n: np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
    distinct = data[spread(begin[at], length[at])]
    if (length[at][which] == length).all() and np.array_equal(distinct[spread(own[which], length)], data):
        return which, distinct, own
    raw, index = data.tobytes(), {}  # two stretches share a hash: tell them apart by their bytes
    which = np.array([index.setdefault(raw[a : a + k], len(index)) for a, k in zip(begin.tolist(), length.tolist(), strict=True)])
    return which, np.frombuffer(b"".join(index), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in index])))


class Lattice:
    """All edges of distinct stretches, and for each position the running shares of the edges that end there."""

    def __init__(self, v: Vocabulary, data: np.ndarray, offs: np.ndarray, fallback: float):
        n = len(data)
        end = np.repeat(offs[1:], np.diff(offs))
        char = np.append((data & 0xC0) != 0x80, True)
        char[offs] = True
        starts = np.flatnonzero(char[:-1])
        size = np.diff(np.append(starts, n))  # bytes of each character
        src, dst, ids = [], [], []
        alive, h = starts, np.zeros(len(starts), U)
        for k, (table, piece) in enumerate(v.levels, 1):
            h = _step(h, data[alive + k - 1])
            at = np.minimum(np.searchsorted(table, h), len(table) - 1)
            ok = table[at] == h
            alive, h, at = alive[ok], h[ok], at[ok]
            to = alive + k
            hit = (piece[at] >= 0) & char[to]
            src.append(alive[hit])
            dst.append(to[hit])
            ids.append(piece[at[hit]])
            more = to < end[alive]
            alive, h = alive[more], h[more]
            if not len(alive):
                break
        src, dst, ids = np.concatenate(src), np.concatenate(dst), np.concatenate(ids)
        single, whole = np.zeros(n, bool), np.zeros(n, np.int64)
        whole[starts] = size
        single[src[dst - src == whole[src]]] = True
        bare = starts[~single[starts]]
        src, dst = np.concatenate((src, bare)), np.concatenate((dst, bare + whole[bare]))
        ids = np.concatenate((ids, np.full(len(bare), -1)))
        w = np.where(ids >= 0, v.weight[ids], fallback * (dst - src))
        # forward filtering, all stretches in step; a stretch's first place holds 0
        first = np.repeat(offs[:-1], np.diff(offs))
        step = src - first[src]
        order = np.argsort(step.astype(np.uint16) if len(step) and step.max() < 65536 else step, kind="stable")
        src, dst, ids, w = src[order], dst[order], ids[order], w[order]
        step = src - first[src]
        # a stretch's end shares its place with the next one's start, so ends are kept apart
        alpha, last = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        alpha[offs[:-1]] = 0
        closes = dst == end[src]
        cut = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1], [True]))) if len(step) else np.zeros(1, int)
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            x = alpha[src[a:b]] + w[a:b]
            inner = ~closes[a:b]
            np.logaddexp.at(alpha, dst[a:b][inner], x[inner])
            np.logaddexp.at(last, dst[a:b][~inner], x[~inner])
        share = np.exp(alpha[src] + w - np.where(closes, last[dst], alpha[dst]))
        # place of an edge's end: its last byte
        place = dst - 1
        order = np.argsort(place << 8 | np.minimum(dst - src, 255))  # no two edges of a place have one length
        self.src, self.ids, place, share = src[order], ids[order], place[order], share[order]
        self.first = np.searchsorted(place, np.arange(n + 1))
        run = np.concatenate(([0], np.cumsum(share)))
        self.running = run[1:] - run[self.first[place]]
        self.running[self.first[1:][np.diff(self.first) > 0] - 1] = 2  # the last edge of a place takes what is left

    def edge(self, place: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """An edge that ends at place, by a draw from [0, 1)."""
        e = self.first[place]
        more = np.flatnonzero(self.running[e] <= draw)
        while len(more):
            e[more] += 1
            more = more[self.running[e[more]] <= draw[more]]
        return e


def encode_block(v: Vocabulary, s: Sampling, data: np.ndarray, offs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids of all texts, and where each text's begin. Texts have their space in front; empty ones have no bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    begin = _stretches(data, offs)
    length = np.diff(np.append(begin, n))
    which, distinct, own = _distinct(data, begin, length)
    lat = Lattice(v, distinct, own, s.fallback)
    doc = np.searchsorted(offs, begin, "right") - 1
    number = np.arange(len(begin)) - np.searchsorted(doc, doc)
    base = mix(mix(keys[doc].view(np.uint64) + _hashed(s.seed)) + number.astype(U))
    occ, place, start = np.arange(len(begin)), own[which + 1] - 1, own[which]
    got_occ, got_step, got_id, got_place = [], [], [], []
    step = 0
    while len(occ):
        draw = (mix(base[occ] + _hashed(step + 1)) >> U(11)).astype(float) / 2.0**53
        e = lat.edge(place, draw)
        got_occ.append(occ)
        got_step.append(np.full(len(occ), step))
        got_id.append(lat.ids[e])
        got_place.append(lat.src[e] - own[which[occ]] + begin[occ])
        src = lat.src[e]
        more = src > start
        occ, place, start = occ[more], src[more] - 1, start[more]
        step += 1
    where = np.concatenate(got_place)  # in the texts
    ids = np.concatenate(got_id)
    order = np.argsort(where, kind="stable")
    where, ids = where[order], ids[order]
    size = np.diff(np.append(where, n))
    times = np.where(ids >= 0, 1, size)
    out = np.repeat(ids, times)
    inside = np.arange(len(out)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(where, times)
    bare = out < 0
    out[bare] = BYTES_AT + data[inside[bare]].astype(np.int64)
    return out, np.searchsorted(inside, offs)


def decode_block(v: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """The bytes of a sequence of ids."""
    n = v.lens[ids]
    return v.bytes[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(v.at[ids], n)]


def _with_space(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space in front of those that aren't empty."""
    data, offs = _bytes_of(arr)
    full = np.diff(offs) > 0
    new = offs + np.concatenate(([0], np.cumsum(full)))
    out = np.full(int(new[-1]), 32, np.uint8)
    row = np.repeat(np.arange(len(full)), np.diff(offs))
    out[np.arange(len(data)) - offs[row] + new[row] + 1] = data
    return out, new


def _blocks(s: Sampling, batches: Iterator[pa.RecordBatch]):
    v = vocabulary(s.path, s.temperature)
    for b in batches:
        for c in chunks(b):
            data, offs = _with_space(column(c, "text"))
            keys = np.array(column(c, "doc_id").cast(pa.int64()).fill_null(0))
            ids, at = encode_block(v, s, data, offs, keys)
            yield v, c, data, offs, ids, at


def encode(docs: DataFrame, s: Sampling = Sampling()) -> DataFrame:
    """doc_id and its sampled ids."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, c, _, _, ids, at in _blocks(s, batches):
            yield pa.RecordBatch.from_arrays([column(c, "doc_id").cast(pa.int64()), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, s: Sampling = Sampling()) -> DataFrame:
    """doc_id and text of the rows of encode()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(s.path, s.temperature)
        for b in batches:
            texts = [decode_block(v, np.array(x, np.int64))[1:].tobytes().decode() if x else "" for x in column(b, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op7_piece_sampling(spark, sf_dir: str) -> DataFrame:
    """Of each document: n_pieces, n_bytes, ids_crc32 (of little-endian 32-bit ids) and whether decoding gave the text back."""
    s = Sampling()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for v, c, data, offs, ids, at in _blocks(s, batches):
            back = decode_block(v, ids)
            wide = ids.astype("<u4")
            size = np.concatenate(([0], np.cumsum(v.lens[ids])))[at]
            same = [size[d] == offs[d] and size[d + 1] == offs[d + 1] and np.array_equal(back[size[d] : size[d + 1]], data[offs[d] : offs[d + 1]]) for d in range(c.num_rows)]
            crc = [zlib.crc32(wide[at[d] : at[d + 1]].tobytes()) for d in range(c.num_rows)]
            n = np.diff(offs)
            yield pa.RecordBatch.from_arrays([column(c, "doc_id").cast(pa.int64()), pa.array(np.diff(at)), pa.array(n - (n > 0)), pa.array(crc, pa.int64()), pa.array(same)], ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "lossless"])

    docs = documents(spark, sf_dir)
    arrow_limits(spark)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, lossless boolean")
