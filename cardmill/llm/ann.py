"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Inner products become distances by one more component: with M the largest norm, a vector
x is hashed as (x, sqrt(M^2 - |x|^2)) / M and a query q as (q, 0) / |q|, so the nearest
point of the sphere is the one of largest inner product. Each of `tables` tables has
`hashes` Gaussian (2-stable) projections in slots of `width`. A query visits its own
bucket and perturbed ones in the order of estimated success (the squared distances of its
projections to the slots), the first `probes` of them in each table. How many that are is fitted: a sample of `sample` queries is
compared with all vectors, and the least number that finds `recall` of their true neighbours is taken, so the share of
the vectors that is visited follows from how clear the neighbours are. Where `probes` don't find so many, all queries are compared with
all blocks instead.

M holds for a range of norms, from itself down to a half of it, so a few long vectors don't press all others to one pole. A query visits its
buckets in each range that has vectors; ranges come from a count of norms by powers of two. Norms are taken of scaled components, so squares
don't overflow.

Both sides travel as blocks of at most `block` vectors of one bucket, joined on the bucket
key, so a bucket of any size is many rows and AQE can split it; the product of two blocks
keeps the `k` best of each query (ties at the cut included), and scores are taken again
from the original vectors, pair by pair, in double precision. A query that finds fewer than
k candidates is compared with all blocks, dealt to as many shards as there are shuffle partitions, so it lacks none.

`visited` tells what share of the vectors a query's buckets hold. Without structure in the vectors (20th neighbour at an inner product
of 0.35 where chance gives 0 +- 0.125, as in the tables at hand) no setting found gets a recall of 0.9 from less than about 0.6 of them.

Null, zero or non-finite vectors and null ids take no part. Vectors of unequal length are never
compared. Repeated ids: a pair (query, candidate) of one id is never returned, and a
candidate id counts once, with its best score. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import arrow_limits, documents, dropped, written
from .words import U, column, mix


@dataclass(frozen=True)
class Index:
    k: int = 20
    tables: int = 4
    hashes: int = 0  # 0: by the number of vectors, so that buckets keep their size
    width: float = 2.5
    probes: int = 256  # at most; beyond that the search is exact
    recall: float = 0.94  # that `probes` is fitted to, on a sample
    sample: int = 50  # queries
    block: int = 2048
    seed: int = 7


def vectors(batch: pa.RecordBatch, id_col: str, vec_col: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the usable vectors of a batch, by length, in double precision."""
    ids, col = column(batch, id_col), column(batch, vec_col)
    ok = np.array(ids.is_valid()) & np.array(col.is_valid())
    ids, col = ids.filter(pa.array(ok)).cast(pa.int64()), col.filter(pa.array(ok))
    if not len(col):
        return
    ids = ids.to_numpy()
    flat = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    n = np.array(col.value_lengths())
    at = np.concatenate(([0], np.cumsum(n)))
    for d in np.unique(n[n > 0]):
        rows = np.flatnonzero(n == d)
        x = flat[at[rows][:, None] + np.arange(d)]
        good = np.isfinite(x).all(1) & (np.abs(x).max(1) > 0)
        if good.any():
            yield ids[rows[good]], x[good]


def norm_of(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(1)
    with np.errstate(over="ignore"):
        return np.minimum(scale * np.sqrt(((x / scale[:, None]) ** 2).sum(1)), np.finfo(float).max)


#: Ranges of norms of vectors of one length: (the least binary exponent in it, its largest norm), the largest first.
Ranges = list[tuple[int, float]]


def ranges_of(counts: list[tuple[int, float, float]]) -> Ranges:
    """From (binary exponent, least norm, largest norm): ranges that end above a half of their largest norm, except inside one exponent."""
    out: Ranges = []
    for e, least, most in sorted(counts, reverse=True):
        if out and least >= out[-1][1] / 2:
            out[-1] = (e, out[-1][1])
        else:
            out.append((e, most))
    return out


def _norms(id_col: str, vec_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], tuple[float, float, int]] = {}
        for b in batches:
            for _, x in vectors(b, id_col, vec_col):
                norm = norm_of(x)
                exponent = np.frexp(norm)[1]
                for e in np.unique(exponent):
                    some = norm[exponent == e]
                    least, most, n = seen.get((x.shape[1], int(e)), (np.inf, 0.0, 0))
                    seen[x.shape[1], int(e)] = min(least, float(some.min())), max(most, float(some.max())), n + len(some)
        rows = [(*k, *v) for k, v in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()))], ["dim", "exponent", "least", "norm", "n"])

    return run


def _projections(dim: int, index: Index) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.Generator(np.random.PCG64([index.seed, dim]))
    return [(rng.normal(size=(dim + 1, index.hashes)), rng.uniform(0, index.width, index.hashes)) for _ in range(index.tables)]


def _keys(slots: np.ndarray, dim: int, table: int, place: np.ndarray) -> np.ndarray:
    """One value for each row of slot numbers in a range of norms."""
    h = np.full(slots.shape[:-1], U(dim * 1000 + table)) + place.reshape(-1, *[1] * (slots.ndim - 2)).astype(np.uint64) * U(0xD1B54A32D192ED03)
    for j in range(slots.shape[-1]):
        h = mix(h * U(0x9E3779B97F4A7C15) + slots[..., j].astype(np.int64).view(np.uint64))
    return h.view(np.int64)


def probe_order(hashes: int, probes: int) -> np.ndarray:
    """Sets of perturbations in the order of their estimated success, a row for each, as choices among the 2 * hashes moves to a
    neighbouring slot that are sorted by their squared distances. The expected distances of uniform projections give the order, as in
    Lv et al. 2007; moves j and 2 * hashes + 1 - j are of one projection, so no set has both.
    """
    n = 2 * hashes
    scale = 4 * (hashes + 1) * (hashes + 2)
    cost = [j * (j + 1) / scale if j <= hashes else 1 - (n + 1 - j) / (hashes + 1) + (n + 1 - j) * (n + 2 - j) / scale for j in range(1, n + 1)]
    rows, heap = [()], [(cost[0], (0,))]
    while heap and len(rows) < probes:
        total, moves = heappop(heap)
        if len({min(m, n - 1 - m) for m in moves}) == len(moves):
            rows.append(moves)
        m = moves[-1]
        if m + 1 < n:
            heappush(heap, (total - cost[m] + cost[m + 1], (*moves[:-1], m + 1)))
            heappush(heap, (total + cost[m + 1], (*moves, m + 1)))
    out = np.zeros((len(rows), n), np.int64)
    for row, moves in zip(out, rows, strict=True):
        row[list(moves)] = 1
    return out


_BLOCK = "key long, dim int, n int, ids binary, vecs binary"


def _sent(x: np.ndarray) -> bytes:
    """Single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return np.ascontiguousarray(single if (single == x).all() else x).tobytes()


def _got(data: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, np.float32 if len(data) == 4 * dim * n else np.float64).reshape(n, dim).astype(float)


class _Packer:
    """Blocks of rows with one key; an open block of each key, all bounded together."""

    def __init__(self, size: int, most_bytes: int = 48 << 20):
        self.size, self.most, self.open, self.bytes = size, most_bytes, {}, 0

    def add(self, keys: np.ndarray, ids: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        cut = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            rows = order[a:b]
            held = self.open.setdefault((int(k[a]), x.shape[1]), [])
            held.append((ids[rows], x[rows]))
            self.bytes += x[rows].nbytes
            if sum(len(i) for i, _ in held) >= self.size:
                yield from self._out((int(k[a]), x.shape[1]))
        if self.bytes > self.most:
            yield from self.rest()

    def _out(self, key: tuple) -> Iterator[tuple]:
        held = self.open.pop(key)
        ids, x = np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])
        self.bytes -= x.nbytes
        for a in range(0, len(ids), self.size):
            yield key[0], key[1], len(ids[a : a + self.size]), ids[a : a + self.size].tobytes(), _sent(x[a : a + self.size])

    def rest(self) -> Iterator[tuple]:
        for key in list(self.open):
            yield from self._out(key)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1])
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


_BLOCK_SCHEMA = pa.schema([("key", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("vecs", pa.binary())])


def _buckets(index: Index, x: np.ndarray, ranges: Ranges, order: np.ndarray | None) -> Iterator[np.ndarray]:
    """For each table: the bucket of each vector of base (one column), or, for each range, those that each query visits, in that order."""
    norm, dim = norm_of(x), x.shape[1]
    if order is None:
        place = (np.frexp(norm)[1][:, None] < np.array([e for e, _ in ranges[:-1]])[None, :]).sum(1)
        most = np.array([m for _, m in ranges])[place]
        y = np.concatenate((x / most[:, None], np.sqrt(np.maximum(1 - (norm / most) ** 2, 0))[:, None]), 1)
    else:
        y = np.concatenate((x / norm[:, None], np.zeros((len(x), 1))), 1)
    for t, (a, shift) in enumerate(_projections(dim, index)):
        p = (y @ a + shift) / index.width
        slots = np.floor(p).astype(np.int64)
        if order is None:
            yield _keys(slots, dim, t, place)[:, None]
            continue
        f = p - slots
        near = np.argsort(np.concatenate((f, 1 - f), 1), axis=1, kind="stable")  # moves down and up, the nearest slot first
        step = np.zeros((*near.shape, index.hashes), np.int64)
        np.put_along_axis(step, (near % index.hashes)[..., None], np.where(near < index.hashes, -1, 1)[..., None], 2)
        all_slots = slots[:, None, :] + np.einsum("pm,qmh->qph", order, step)
        for i in range(len(ranges)):
            yield _keys(all_slots, dim, t, np.array([i]))


def _blocks(index: Index, norms: dict[int, Ranges], queries: bool, id_col: str, vec_col: str, shards: int = 0):
    """Blocks of the vectors of a bucket; with shards, of any vectors, dealt to the shards, each of which all queries visit."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        pack, order, dealt = _Packer(256 if queries else index.block), probe_order(index.hashes, index.probes), 0
        for b in batches:
            for ids, x in vectors(b, id_col, vec_col):
                dim = x.shape[1]
                if shards and queries:
                    for shard in range(shards):
                        yield from pack.add(np.full(len(ids), dim * shards + shard, np.int64), ids, x)
                    continue
                if shards:
                    yield from pack.add(dim * shards + (dealt + np.arange(len(ids))) // 64 % shards, ids, x)
                    dealt += len(ids)
                    continue
                for a in range(0, len(ids), 256):
                    own, part = ids[a : a + 256], x[a : a + 256]
                    for keys in _buckets(index, part, norms.get(dim, []), order if queries else None):
                        yield from pack.add(keys.ravel(), np.repeat(own, keys.shape[1]), np.repeat(part, keys.shape[1], 0))
        yield from pack.rest()

    return lambda batches: _batches(rows(batches), _BLOCK_SCHEMA)


def best_of(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best distinct candidates of each query, scored pair by pair; ties to the smaller id."""
    repeated = len(np.unique(ids)) < len(ids)
    if repeated:
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
    s = q @ x.T
    s[q_ids[:, None] == ids[None, :]] = -np.inf
    best = np.maximum.reduceat(s, np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))), axis=1) if repeated else s
    cut = np.partition(best, max(best.shape[1] - k, 0), axis=1)[:, max(best.shape[1] - k, 0)]
    near = (s >= (cut - 1e-9 * np.maximum(1, np.abs(cut)))[:, None]) & np.isfinite(s)
    r, c = np.nonzero(near)
    score = (q[r] * x[c]).sum(1)
    if repeated:
        order = np.lexsort((-score, ids[c], r))
        r, c, score = r[order], c[order], score[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (ids[c[1:]] != ids[c[:-1]])
        r, c, score = r[new], c[new], score[new]
    order = np.lexsort((ids[c], -score, r))
    r, c, score = r[order], c[order], score[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    keep = rank < k
    return q_ids[r[keep]], ids[c[keep]], score[keep]


def merged(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k distinct candidates of each query, each with its best score."""
    order = np.lexsort((-s, v, q))
    q, v, s = q[order], v[order], s[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])
    q, v, s = q[new], v[new], s[new]
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], v[keep], s[keep]


class _Best:
    """The best k so far of each query; what comes is merged in when there is much of it."""

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [], 0
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    def add(self, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.held.append(found)
        self.size += len(found[0])
        if self.size > 500_000:
            self.done()

    def done(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.best = merged(*(np.concatenate([self.best[i], *(h[i] for h in self.held)]) for i in range(3)), self.k)
        self.held, self.size = [], 0
        return self.best


def _products(k: int):
    """Products of joined blocks: of each query of the task one row with its best candidates."""

    def rows(best: _Best) -> Iterator[pa.RecordBatch]:
        q, v, s = best.done()
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, int)
        offs = (np.append(first, len(q)) * 8).astype(np.int32)
        lists = [pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(x))]) for x in (v, s)]
        yield pa.RecordBatch.from_arrays([pa.array(q[first]), *lists], ["query_id", "ids", "scores"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for b in batches:
            cols = [column(b, n).to_pylist() for n in ("dim", "q_ids", "q_vecs", "ids", "vecs")]
            for dim, qi, qv, vi, vv in zip(*cols, strict=True):
                q, v = np.frombuffer(qi, np.int64), np.frombuffer(vi, np.int64)
                best.add(best_of(q, _got(qv, dim, len(q)), v, _got(vv, dim, len(v)), k))
            if len(best.best[0]) > 500_000:
                yield from rows(best)
                best = _Best(k)
        yield from rows(best)

    return run


def _ranked(k: int):
    """Merges the rows of each query and ranks its candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for b in batches:
            ids, scores = column(b, "ids").to_pylist(), column(b, "scores").to_pylist()
            n = np.array([len(x) // 8 for x in ids], np.int64)
            best.add((np.repeat(column(b, "query_id").to_numpy(), n), np.frombuffer(b"".join(ids), np.int64), np.frombuffer(b"".join(scores))))
        q, v, s = best.done()
        rank = np.arange(len(q)) - np.searchsorted(q, q) + 1
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(rank.astype(np.int32)), pa.array(v), pa.array(s)], ["query_id", "rank", "vec_id", "score"])

    return run


def visited(queries: np.ndarray, base: np.ndarray, index: Index = Index()) -> tuple[float, float]:
    """The share of base that the probes of a query reach in any table, and the sum of the shares of all tables, which is the work."""
    norm = norm_of(base)
    most = ranges_of([(int(e), float(norm[np.frexp(norm)[1] == e].min()), float(norm[np.frexp(norm)[1] == e].max())) for e in np.unique(np.frexp(norm)[1])])
    schema = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64()))])
    keys = []
    for x, is_query in ((queries, True), (base, False)):
        batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(x.tolist(), pa.list_(pa.float64()))], schema=schema)
        own: dict[int, list] = {}
        for out in _blocks(index, {base.shape[1]: most}, is_query, "vec_id", "embedding")(iter([batch])):
            for key, ids in zip(column(out, "key").to_pylist(), column(out, "ids").to_pylist(), strict=True):
                own.setdefault(key, []).append(np.frombuffer(ids, np.int64))
        keys.append({k: np.concatenate(v) for k, v in own.items()})
    seen, work = np.zeros((len(queries), len(norm)), bool), 0
    for key, q in keys[0].items():
        if key in keys[1]:
            seen[np.ix_(q, keys[1][key])] = True
            work += len(q) * len(keys[1][key])
    return float(seen.mean()), work / seen.size


def search(queries: DataFrame, base: DataFrame, index: Index = Index(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest of base for each row of queries: query_id, rank, vec_id, score."""
    spark = base.sparkSession
    arrow_limits(spark)
    base, queries = base.select(id_col, vec_col), queries.select(id_col, vec_col)
    lengths = base.mapInArrow(_norms(id_col, vec_col), "dim long, exponent long, least double, norm double, n long").groupBy("dim", "exponent")
    lengths = lengths.agg(F.min("least").alias("least"), F.max("norm").alias("norm"), F.sum("n").alias("n")).collect()  # a row for each length and power of two
    norms = {d: ranges_of([(r.exponent, r.least, r.norm) for r in lengths if r.dim == d]) for d in {r.dim for r in lengths}}
    if not index.hashes:
        index = replace(index, hashes=hashes_for(max((sum(r.n for r in lengths if r.dim == d) for d in norms), default=1)))

    def found(q: DataFrame, x: DataFrame) -> DataFrame:
        both = q.select("key", F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")).join(x.select("key", "dim", "ids", "vecs"), "key")
        out = both.drop("key").mapInArrow(_products(index.k), "query_id long, ids binary, scores binary")
        return out.repartition("query_id").mapInArrow(_ranked(index.k), "query_id long, rank int, vec_id long, score double")

    def exact(q: DataFrame) -> DataFrame:
        shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return found(q.mapInArrow(_blocks(index, norms, True, id_col, vec_col, shards), _BLOCK), base.mapInArrow(_blocks(index, norms, False, id_col, vec_col, shards), _BLOCK))

    # a sample of queries and their true neighbours, index.sample * (k + 1) vectors at most, tell how many probes are needed
    some = written(queries.orderBy(F.xxhash64(id_col), id_col).limit(index.sample), "ann-sample")
    pairs = written(exact(some), "ann-sample-pairs")
    theirs = base.join(F.broadcast(pairs.select(F.col("vec_id").alias(id_col)).distinct()), id_col, "left_semi").dropDuplicates([id_col])
    fitted = fitted_probes(index, norms, [(r.query_id, r.vec_id) for r in pairs.select("query_id", "vec_id").collect()], *({r[0]: r[1] for r in t.collect()} for t in (some, theirs)))
    dropped(some, pairs)
    if fitted is None:
        return exact(queries)
    index = replace(index, probes=fitted)

    x = base.mapInArrow(_blocks(index, norms, False, id_col, vec_col), _BLOCK)
    near = written(found(queries.mapInArrow(_blocks(index, norms, True, id_col, vec_col), _BLOCK), x), "ann")
    # Queries that found fewer than k: against all blocks of their length
    full = near.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= index.k)
    short = written(queries.join(full, queries[id_col] == full["query_id"], "left_anti"), "ann-short")
    if short.isEmpty():
        return near
    return near.join(full, "query_id", "left_semi").unionByName(exact(short))


def hashes_for(n: int) -> int:
    return max(3, round(np.log2(max(n, 1)) / 2.2))


def fitted_probes(index: Index, norms: dict[int, Ranges], pairs: list[tuple[int, int]], queries: dict[int, list], base: dict[int, list]) -> int | None:
    """The least number of probes that reaches `recall` of the given (query, neighbour) pairs; None where `probes` of them don't."""
    order, ranks = probe_order(index.hashes, index.probes), []
    for q, v in pairs:
        x, y = np.array([queries[q]], float), np.array([base[v]], float)
        ranges = norms[y.shape[1]]
        ranges = ranges if isinstance(ranges, list) else [(0, ranges)]  # one M for all
        asked = list(_buckets(index, x, ranges, order))
        hits = [np.flatnonzero(a[0] == b[0, 0]) for t, b in enumerate(_buckets(index, y, ranges, None)) for a in asked[t * len(ranges) : (t + 1) * len(ranges)]]
        ranks.append(min((int(h[0]) for h in hits if len(h)), default=len(order)))
    if not ranks:
        return 1
    needed = int(np.sort(ranks)[int(np.ceil(index.recall * len(ranks))) - 1]) + 1
    return needed if needed <= len(order) else None


def op10_multiprobe_ann(spark, sf_dir: str) -> DataFrame:
    base = documents(spark, sf_dir, "embeddings")
    return search(base.filter("vec_id % 20 = 0"), base)
