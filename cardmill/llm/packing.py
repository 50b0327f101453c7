"""Vector bin packing of tokenised documents into sequences.

An example asks for three things at once: tokens, one of a sequence's segments, and
loss-bearing tokens. A task keeps up to `pending` examples and one open sequence; the
next piece is the pending example whose demand has the largest dot product with what
the sequence has left (each in units of its limit) among those that fit. Where none
fits, the largest is cut so that the sequence fills. A sequence that stays short, the last one of a task or
one that the limit of segments or of loss closes, is dealt out in powers of two, which need no padding, unless it
lacks a 1/`slack` of the tokens at most, which is padded.

Each partition packs on its own and holds `pending` examples and one sequence's pieces,
whatever its size, so nothing is shuffled. `sequence_id` has the partition in its upper bits; it is
the same on every run over the same files.

Nulls: a null text is empty, so its ids are the end id alone; a null doc_id stays null.
Repeated rows are packed once each; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .store import arrow_limits, documents
from .words import column, release

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048
    pending: int = 128
    slack: int = 64


@lru_cache(maxsize=2)
def _encoding(path: str):
    """The byte-level BPE of a tokenizers file, by its ranks: several times as fast."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})


@lru_cache(maxsize=1)
def _slow():
    """The same vocabulary by tokenizers, which has no such limit."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def byte_bpe(path: str | None = None, end_id: int = 1) -> Callable[[str], np.ndarray]:
    """A function from texts to ids with the end id, loaded where it runs."""

    def encode(text: str) -> np.ndarray:
        import public_tokenizers

        e = _encoding(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        try:
            ids = e.encode(text, allowed_special="all")
        except ValueError:  # its pattern's stack is full, as on very long runs of white space
            ids = _slow().encode(text, add_special_tokens=False).ids
        return np.append(np.array(ids, np.uint32), np.uint32(end_id))

    return encode


class Packer:
    """Pieces (example, start, length, crc32, loss, sequence, offset) of the examples of one task."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits, self.next = limits, first_sequence
        self.cap = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.items: list[tuple] = []  # example, ids, start, prefix sums of loss or None
        self.demand = np.zeros((0, 3))
        self.open: list[tuple] = []
        self.left = self.cap.copy()

    def add(self, example, ids: np.ndarray, loss: np.ndarray | None = None) -> Iterator[tuple]:
        """loss: which ids bear loss; None for all."""
        sums = None if loss is None else np.concatenate(([0], np.cumsum(loss, dtype=np.int64)))
        start, n = 0, len(ids)
        if self.limits.loss >= self.limits.tokens:
            # Whole sequences of one example need no choice.
            while n - start >= self.limits.tokens:
                to = start + self.limits.tokens
                yield self._piece(example, ids, start, to, sums, self.next, 0)
                self.next += 1
                start = to
        if start < n:
            self._hold((example, ids, start, sums))
        while len(self.items) > self.limits.pending:
            yield from self._step()

    def _hold(self, item: tuple) -> None:
        self.items.append(item)
        _, ids, start, sums = item
        n = len(ids) - start
        self.demand = np.vstack((self.demand, [n, 1, n if sums is None else sums[-1] - sums[start]]))

    def _piece(self, example, ids, start, to, sums, sequence, offset) -> tuple:
        crc = zlib.crc32(np.ascontiguousarray(ids[start:to], "<u4").tobytes())
        return example, start, to - start, crc, int(to - start if sums is None else sums[to] - sums[start]), sequence, offset

    def _take(self, i: int) -> tuple:
        item = self.items[i]
        self.items[i] = self.items[-1]
        self.demand[i] = self.demand[-1]
        self.items.pop()
        self.demand = self.demand[:-1]
        return item

    def _step(self) -> Iterator[tuple]:
        """Place one piece."""
        fits = (self.demand <= self.left).all(1)
        score = (self.demand / self.cap) @ (self.left / self.cap)
        if fits.any():
            i = int(np.argmax(np.where(fits, score, -1)))
            example, ids, start, sums = self._take(i)
            to = len(ids)
        else:
            i = int(np.argmax(score))
            example, ids, start, sums = self._take(i)
            to = min(len(ids), start + int(self.left[0]))
            if sums is not None:  # as far as the loss limit lets it go
                to = min(to, int(np.searchsorted(sums, sums[start] + self.left[2], "right")) - 1)
            if to <= start:
                yield from self._close()
                to = start
            if to < len(ids):
                self._hold((example, ids, to, sums))
        if to > start:
            n = to - start
            self.open.append((example, ids, start, to, sums))
            self.left -= [n, 1, n if sums is None else sums[to] - sums[start]]
        if self.left[0] <= 0 or self.left[1] <= 0:
            yield from self._close()

    def _close(self) -> Iterator[tuple]:
        """End the open sequence: as it is if it is full or nearly, else in powers of two."""
        rest, self.open = self.open, []
        total = sum(to - start for _, _, start, to, _ in rest)
        nearly = total >= self.limits.tokens - self.limits.tokens // self.limits.slack
        self.left = self.cap.copy()
        while total:
            room = total if nearly else 1 << (total.bit_length() - 1)
            total -= room
            at = 0
            while room:
                example, ids, start, to, sums = rest[0]
                cut = min(to, start + room)
                yield self._piece(example, ids, start, cut, sums, self.next, at)
                at += cut - start
                room -= cut - start
                rest[0] = (example, ids, cut, to, sums)
                if cut == to:
                    rest.pop(0)
            self.next += 1

    def finish(self) -> Iterator[tuple]:
        while self.items:
            yield from self._step()
        yield from self._close()


def pack_documents(docs: DataFrame, encode: Callable[[str], np.ndarray] | None = None, limits: Limits = Limits()) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens."""
    encode = encode or byte_bpe()
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(limits, TaskContext.get().partitionId() << 32)
        names = ["doc_id", "doc_tokens", "start", "length", "ids_crc32", "loss_tokens", "sequence_id", "offset"]

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            cols = [[p[0][0] for p in pieces], [p[0][1] for p in pieces], *([p[i] for p in pieces] for i in range(1, 7))]
            by = dict(zip(names, cols, strict=True))
            order = [x.split()[0] for x in _SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(by[n], pa.int64()) for n in order], order)

        for b in batches:
            pieces: list[tuple] = []
            for doc_id, text in zip(column(b, "doc_id").to_pylist(), column(b, "text").to_pylist(), strict=True):
                ids = encode(text or "")
                pieces += packer.add((doc_id, len(ids)), ids)
            if pieces:
                yield out(pieces)
            release()
        if pieces := list(packer.finish()):
            yield out(pieces)

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)


def pack_conversations(turns: DataFrame, encode: Callable[[str], np.ndarray] | None = None, limits: Limits = Limits(loss=1536)) -> DataFrame:
    """Instruction data: each row (doc_id, roles, texts) is an example; only ids of the assistant bear loss.

    A null list is empty; where one list is longer, or has nulls, a text is empty and a role isn't the assistant's. An example without any turn has
    no pieces. Returns the columns of pack_documents.
    """
    encode = encode or byte_bpe()
    arrow_limits(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(limits, TaskContext.get().partitionId() << 32)
        order = [x.split()[0] for x in _SCHEMA.split(", ")]

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            rows = [(p[0][0], p[1], p[2], p[3], p[0][1], p[5], p[6], p[4]) for p in pieces]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(8)], order)

        for b in batches:
            pieces: list[tuple] = []
            for doc_id, roles, texts in zip(*(column(b, n).to_pylist() for n in ("doc_id", "roles", "texts")), strict=True):
                parts = [(r == "assistant", encode(t or "")) for r, t in zip_longest(roles or [], texts or [])]
                if parts:
                    ids = np.concatenate([x for _, x in parts])
                    pieces += packer.add((doc_id, len(ids)), ids, np.concatenate([np.full(len(x), r) for r, x in parts]))
            if pieces:
                yield out(pieces)
        if pieces := list(packer.finish()):
            yield out(pieces)

    return turns.select("doc_id", "roles", "texts").mapInArrow(run, _SCHEMA)


def op3_vector_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
