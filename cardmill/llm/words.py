"""Words, word hashes and hashes of word sequences of whole Arrow batches, in numpy.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D of the UTF-8 text. Its hash chains a mixing bijection
over its eight-byte lanes, so it isn't linear in anything; spans of more than `LONG` bytes are hashed by XXH3. A sequence of
words is hashed by doubling: the hash of 2**(j+1) words mixes those of its two halves, and any length is covered by its
first and its last 2**j words. There are two independent chains, `which` 0 and 1, where 128 bits are asked for.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 1 << 19
LONG = 64

U = np.uint64
_SEED = (0x2545F4914F6CDD1D, 0x8CB92BA72F3D8DD7)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes of a lane


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _bytes_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each row begins; nulls are empty."""
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    if len(arr) == 0 or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8)[offs[0] : offs[-1]]
    return data, offs - offs[0]


def retain() -> None:
    """Keep freed arrays of up to 32 MB for the next ones until release(), 128 MB of them at most: fresh pages cost as much as a pass over them."""
    if sys.platform == "linux":
        set_ = getattr(ctypes.CDLL(None), "mallopt", None)
        if set_:
            set_(-3, 32 << 20)  # M_MMAP_THRESHOLD, as far as glibc raises it by itself
            set_(-1, 128 << 20)  # M_TRIM_THRESHOLD


def release() -> None:
    """Give freed memory back to the system: a worker lives on between tasks, and its peak would stay with it."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, others don't
        if trim:
            trim(0)


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about limit bytes of text each; a longer text stands alone."""
    if batch.num_rows == 0:
        return
    _, offs = _bytes_of(column(batch, text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    release()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of byte spans."""
    n = (ends - starts).astype(np.int64)
    h = mix(U(_SEED[which]) + n.astype(U) * U(0x9FB21C651E98DF25))
    if not len(n):
        return h
    lanes = np.ndarray(len(data) + 1, "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))  # at every byte
    live = np.flatnonzero((n > 0) & (n <= LONG))
    at = 0
    while len(live):
        left = n[live] - at
        h[live] = mix(h[live] ^ (lanes[starts[live] + at] & _LANE[np.minimum(left, 8)])) + U(at + 1)
        live, at = live[left > 8], at + 8
    if (n > LONG).any():
        view = memoryview(np.ascontiguousarray(data))
        for i in np.flatnonzero(n > LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(view[starts[i] : ends[i]], _SEED[which])
    return h


class Sequences:
    """Hashes of spans of a row of values."""

    def __init__(self, h: np.ndarray):
        self.levels = [h]

    def _level(self, j: int) -> np.ndarray:
        while len(self.levels) <= j:
            x, s = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(mix(x[: max(len(x) - s, 0)] * U(0x9E3779B97F4A7C15) + x[s:]))
        return self.levels[j]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of [start, end); equal for equal sequences only, but for chance."""
        n = (ends - starts).astype(np.int64)
        out = n.astype(U) * U(0xD1342543DE82EF95)
        if not len(n):
            return out
        power = np.frexp(np.maximum(n, 1))[1] - 1
        for j in np.unique(power[n > 0]).tolist():
            x = self._level(j)
            own = slice(None) if (n > 0).all() and (power == j).all() else np.flatnonzero((n > 0) & (power == j))
            out[own] = mix(out[own] + mix(x[starts[own]] * U(0xC2B2AE3D27D4EB4F) + x[ends[own] - (1 << j)]))
        return out


class Words:
    """Words of the texts of one chunk. first[d] is the first word of text d; first[-1] their number."""

    def __init__(self, arr: pa.Array, lower: bool = False):
        self.data, self.offs = _bytes_of(arr)
        self.rows = len(arr)
        if lower:
            self.data = _LOWER[self.data]
        n = len(self.data)
        if n == 0:
            self.starts = self.ends = np.zeros(0, np.int64)
        else:
            word = ~_SPACE[self.data]
            cut = np.zeros(n + 1, bool)
            cut[self.offs] = True
            before = np.concatenate(([False], word[:-1]))
            after = np.concatenate((word[1:], [False]))
            self.starts = np.flatnonzero(word & (~before | cut[:-1]))
            self.ends = np.flatnonzero(word & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, self.offs)
        self.n = np.diff(self.first)
        self._sequences: dict[int, Sequences] = {}

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.rows), self.n)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans."""
        return span_hashes(self.data, starts, ends)

    def hashes(self, which: int = 0) -> np.ndarray:
        return self.sequences(which).levels[0]

    def sequences(self, which: int = 0) -> Sequences:
        if which not in self._sequences:
            self._sequences[which] = Sequences(span_hashes(self.data, self.starts, self.ends, which))
        return self._sequences[which]

    def seq_hash(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of word sequences [start, end)."""
        return self.sequences(which).hashes(starts, ends)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of k words inside one text, and their texts."""
        n = np.maximum(self.n - k + 1, 0)
        doc = np.repeat(np.arange(self.rows), n)
        first = np.concatenate(([0], np.cumsum(n)))[:-1]
        return np.arange(len(doc)) - first[doc] + self.first[:-1][doc], doc

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def per_row(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of values[offs[d]:offs[d+1]]."""
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[offs[1:]] - sums[offs[:-1]]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def crc32_of_id(ids: pa.Array) -> np.ndarray:
    """crc32 of each id as text; null counts as the empty text."""
    import zlib

    return np.array([zlib.crc32(b"" if x is None else str(x).encode()) for x in ids.to_pylist()], np.int64)
