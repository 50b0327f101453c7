"""Exact Jaccard join on n-gram sets, as a blocked sparse product of document by n-gram incidence.

The wanted entries of the product are the pairs whose overlap reaches the bound that their
sizes give. Texts of equal sets are one row of the matrix (its node). Then:

1. Column blocks. Sizes are dealt to classes. A pair at the threshold whose smaller set is in class c
   differs in d(c) n-grams at most, so if n-grams are hashed into more than d(c) column blocks, the two rows
   agree in some whole block. That holds as well when the commonest columns (at most `common`, which
   popular passages have) are left out of both rows; it is then no longer enough to share a passage. Each row emits a
   signature of each of its filled blocks, under its own class and under the class below where a smaller partner may lie
   there. Rows with too few filled blocks to be sure of agreeing in a filled one are dealt again with all their
   columns, under other seeds, and at last emit the prefix of their n-grams, so no pair is lost.
2. Row blocks. Rows that share signatures, directly or through others, and whose sizes allow a link form clusters (connected
   components of chains by size; no pairs within a group are written). Where up to `apart` rows share one, each two are compared by
   parities of their n-grams in 64 classes (rows of `parity` n-grams at most): these differ in no more classes than the sets in n-grams, so
   texts that merely share a phrase don't chain up to a cluster that grows faster than the table. A cluster of more than `rows`
   rows or `entries` entries is dealt into blocks, and each two blocks meet in one task. They meet in rounds, so that at once
   about `moved` bytes lie on disk, or two copies of the large clusters.
3. Product. A task multiplies the incidence of its rows, posting list by posting list, accumulating the
   overlaps of one row with all others at a time, and drops those below the size-derived
   bound. Only a spanning set of its links leaves the task; components of these give the classes.

Nulls: a null text is empty; an empty set links with nothing. A null doc_id takes part and stays null.
Repeated rows share a class. component_id is the smallest doc_id of a class (its own where a text is
empty). An empty table gives an empty result. Extra columns don't matter. N-grams and
whole sets are 64-bit hashes that no regular text can make meet: with 10^10 different n-grams, one in 10^9 pairs of texts may share a
false one, and among m different sets two are taken for one with a probability of m * m / 2**65.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components, local_components
from .store import arrow_limits, documents, dropped, free_names, looked_up, written
from .words import U, Words, chunks, column, mix, release, signed


@dataclass(frozen=True)
class Join:
    words: int = 4
    percent: int = 85  # of the union that the overlap must reach
    growth: float = 1.6  # of size classes
    spare: float = 0.25  # blocks beyond the least number
    common: int = 1 << 19
    least_common: int = 3  # texts of one task that make a column a candidate
    seeds: int = 6
    rows: int = 3000
    entries: int = 2_000_000
    parity: int = 128
    apart: int = 64
    moved: int = 1 << 30  # bytes of text that large clusters move in one round, about
    bits: int = 1 << 26  # of the filter of rows at most


class Sets:
    """The n-gram sets of the texts of one chunk: sorted, distinct values of text d at [first[d], first[d+1])."""

    def __init__(self, arr: pa.Array, words: int):
        w = Words(arr, lower=True)
        at, doc = w.windows(words)
        h = w.seq_hash(at, at + words)
        short = np.flatnonzero((w.n > 0) & (w.n < words))
        if len(short):
            h = np.concatenate((h, w.seq_hash(w.first[short], w.first[short + 1])))
            doc = np.concatenate((doc, short))
        order = np.argsort(h, kind="stable")
        small = np.uint16 if w.rows < 65536 else np.int64
        order = order[np.argsort(doc[order].astype(small), kind="stable")]
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.h, self.doc = h[new], doc[new]
        self.n = np.bincount(self.doc, minlength=w.rows)
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        total = np.zeros(w.rows, U)
        np.add.at(total, self.doc, mix(self.h ^ U(0xA0761D6478BD642F)))
        self.node = signed(mix(total + self.n.astype(U)))

    def parities(self, most: int) -> np.ndarray:
        """64 bits of each text: of how many n-grams of a class it has, the parity; 0 beyond `most` n-grams."""
        out, some = np.zeros(len(self.n), U), np.flatnonzero((self.n > 0) & (self.n <= most))
        pos, at = _entries(self, some)
        bits = U(1) << (mix(self.h[pos] ^ U(0x8EBC6AF09C88C6E3)) >> U(58))
        if len(some):
            out[some] = np.bitwise_xor.reduceat(bits, np.cumsum(self.n[some]) - self.n[some])
        return out


class Classes:
    """Size classes, and for each the number of n-grams in which a pair at the threshold may differ."""

    def __init__(self, join: Join, most: int):
        up = [1]
        while up[-1] < most:
            up.append(max(up[-1] + 1, int(up[-1] * join.growth)))
        self.up = np.array(up)
        larger = self.up * 100 // join.percent
        self.differ = (self.up + larger) * (100 - join.percent) // (100 + join.percent)
        self.blocks = np.where(self.differ > 0, self.differ + 1 + np.ceil(join.spare * (self.differ + 1)).astype(int), 1)


class Common:
    """The commonest columns, with a table that answers most questions for them without a search."""

    def __init__(self, h: np.ndarray):
        self.h = np.sort(h)
        self.may = np.zeros(1 << 22, bool)
        self.may[(self.h >> U(42)).astype(np.int64)] = True

    def rare(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        ask = np.flatnonzero(self.may[(h >> U(42)).astype(np.int64)])
        if len(ask):
            at = np.minimum(np.searchsorted(self.h, h[ask]), len(self.h) - 1)
            out[ask[self.h[at] == h[ask]]] = False
        return out


def signatures(sets: Sets, join: Join, common: Common | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(signature, node, size, parities) of every column block that may decide a pair."""
    if not len(sets.h):
        return (np.zeros(0, np.int64),) * 4
    classes = Classes(join, int(sets.n.max()))
    own = np.searchsorted(classes.up, np.maximum(sets.n, 1))
    _, rep = np.unique(sets.node, return_index=True)
    rep = rep[sets.n[rep] > 0]
    least = -(-sets.n * join.percent // 100)  # of a smaller partner
    out: list[tuple[np.ndarray, np.ndarray]] = []
    rare = common.rare(sets.h) if common else np.ones(len(sets.h), bool)
    down = 0
    while len(rep):
        c = own[rep] - down
        ok = (c >= 0) & ((down == 0) | (classes.up[np.maximum(c, 0)] >= least[rep]))
        rep, c = rep[ok], c[ok]
        out += _dealt(sets, rep, c, classes, join, rare)
        down += 1
    rows = np.concatenate([r for _, r in out])
    return np.concatenate([s for s, _ in out]), sets.node[rows], sets.n[rows], signed(sets.parities(join.parity)[rows])


def _entries(sets: Sets, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all entries of rows, and for each the number of its row among rows."""
    n = sets.n[rows]
    at = np.repeat(np.arange(len(rows)), n)
    first = np.cumsum(n) - n
    return np.arange(n.sum()) - first[at] + sets.first[rows][at], at


def _dealt(sets: Sets, rows: np.ndarray, cls: np.ndarray, classes: Classes, join: Join, rare: np.ndarray) -> list:
    """(signatures, rows): the first deal leaves common columns out, later ones are for rows that it can't decide."""
    out = []
    for seed in range(-1, join.seeds):
        if not len(rows):
            return out
        pos, at = _entries(sets, rows)
        if seed < 0:
            own = rare[pos]
            pos, at = pos[own], at[own]
        blocks = classes.blocks[cls]
        off = np.cumsum(blocks) - blocks
        salt = U((seed * 2654435761 + 97) & 0xFFFFFFFF)
        block = off[at] + (mix(sets.h[pos] + salt) % blocks[at].astype(U)).astype(np.int64)
        sums = np.zeros(int(blocks.sum()), U)
        np.add.at(sums, block, mix(sets.h[pos] ^ U(0xE7037ED1A0B428DB)))
        row = np.repeat(np.arange(len(rows)), blocks)
        filled = np.flatnonzero(np.bincount(block, minlength=len(sums)))
        row = row[filled]
        number = (filled - off[row]).astype(U)
        tag = mix(number * U(0x9E3779B97F4A7C15) + cls[row].astype(U) * U(1315423911) + salt)
        out.append((signed(mix(sums[filled] ^ tag)), rows[row]))
        sure = np.bincount(row, minlength=len(rows)) > classes.differ[cls]
        rows, cls = rows[~sure], cls[~sure]
    if len(rows):  # the prefix: as many of the first n-grams as can be missing, and one
        pos, at = _entries(sets, rows)
        n = sets.n[rows]
        prefix = n - -(-n * join.percent // 100) + 1
        inside = pos - sets.first[rows][at] < prefix[at]
        tag = mix(cls[at[inside]].astype(U) + U(0x51ED270B))
        out.append((signed(mix(sets.h[pos[inside]] ^ tag)), rows[at[inside]]))
    return out


def _common_columns(join: Join):
    """Columns that several texts of a task hold: what is common in the whole is so in some task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            k, n = np.unique(np.concatenate(held), return_counts=True)
            top = n >= join.least_common
            return pa.RecordBatch.from_arrays([pa.array(signed(k[top])), pa.array(n[top])], ["h", "n"])

        for b in batches:
            for c in chunks(b):
                s = Sets(column(c, "text"), join.words)
                _, rep = np.unique(s.node, return_index=True)
                own = np.zeros(len(s.n), bool)
                own[rep] = True  # copies count once
                held.append(s.h[own[s.doc]])
                size += len(held[-1])
                if size > 2_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return run


def common_columns(text: DataFrame, join: Join) -> Common:
    """The commonest columns; `common` values of eight bytes at most reach the driver."""
    found = text.select("text").mapInArrow(_common_columns(join), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "h").limit(join.common).select("h").toArrow()
    return Common(rows.column("h").to_numpy().view(np.uint64))


def _set_rows(join: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                s = Sets(column(c, "text"), join.words)
                node = pa.array(s.node, mask=s.n == 0)
                yield pa.RecordBatch.from_arrays([column(c, "doc_id").cast(pa.int64()), column(c, "row"), pa.array(s.n.astype(np.int64)), node], ["doc_id", "row", "n_shingles", "node"])

    return run


def _signature_rows(join: Join, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                sig, node, n, odd = signatures(Sets(column(c, "text"), join.words), join, common.value)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(node), pa.array(n.astype(np.int32)), pa.array(odd)], ["sig", "node", "n", "odd"])

    return run


def related(sig: np.ndarray, node: np.ndarray, n: np.ndarray, odd: np.ndarray, join: Join, torn: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows that chain the nodes of each signature, in the order of signature, size and node: no linked pair is left apart.

    torn: a signature of which other rows came before.
    """
    percent, n = join.percent, n.astype(np.int64)
    near = lambda i, j: (100 * n[i] >= percent * n[j]) & (node[i] != node[j])
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(sig)))
    large = size > join.apart
    if torn is not None:
        large |= sig[first] == torn
    i = np.flatnonzero(np.repeat(large, size) & ~np.append(new[1:], True))  # by size alone: no pair lies across a gap of sizes
    i = i[near(i, i + 1)]
    yield i, i + 1
    i, end = np.flatnonzero(np.repeat(~large & (size > 1), size)), np.repeat(first + size, size)
    for lag in range(1, join.apart):
        i = i[i + lag < end[i]]
        if not len(i):
            break
        j = i + lag
        differ = np.where(n[j] <= join.parity, np.bitwise_count(odd[i] ^ odd[j]), 0).astype(np.int64)
        pair = near(i, j) & (differ * (100 + percent) <= (100 - percent) * (n[i] + n[j]))
        yield i[pair], j[pair]


def _chains(join: Join, chunk: int = 1_000_000, together: int = 16):
    """Edges that connect the nodes of each signature of a task, as one star per local component; packed, with the group of
    `together` tasks in which they are to be merged.

    Rows come in the order of signature, size and node. A chunk ends with its last whole signature; where one fills a chunk, the
    last row is handed on, so a task holds a chunk or two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        last, torn = [], None

        def edges(held: list, more: bool) -> pa.RecordBatch:
            nonlocal last, torn
            cols = [np.concatenate([*last[i : i + 1], *(h[i] for h in held)]) for i in range(4)]
            other = np.ones(len(cols[0]), bool)  # copies count once
            other[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
            cols = [c[other] for c in cols]
            sig = cols[0]
            cut = keep = int(np.searchsorted(sig, sig[-1])) if more else len(sig)
            if more and not cut:
                cut, keep, torn = len(sig), len(sig) - 1, int(sig[-1])
            last = [c[keep:].copy() for c in cols]
            a = b = np.zeros(0, np.int64)
            for i, j in related(*(c[:cut] for c in cols), join, torn):
                a, b = np.concatenate((a, cols[1][j])), np.concatenate((b, cols[1][i]))
                if len(a) > 2 * chunk:
                    a, b = _star(a, b)
            a, b = _star(a, b)
            group = TaskContext.get().partitionId() // together
            return pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (a, b))], ["part", "a", "b"])

        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append([column(b, c).to_numpy() for c in ("sig", "node", "n", "odd")])
            size += b.num_rows
            if size >= chunk:
                yield edges(held, True)
                held, size = [], 0
        if held or last:
            yield edges(held, False)
        release()

    return run


def _star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = local_components(a, b)
    return a[a != b], b[a != b]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed edges of several tasks as one star per component of them."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        for x, y in zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist(), strict=True):
            a, b = local_components(np.concatenate((a, np.frombuffer(x, np.int64))), np.concatenate((b, np.frombuffer(y, np.int64))))
            a, b = a[a != b], b[a != b]
    for i in range(0, len(a), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 100_000]), pa.array(b[i : i + 100_000])], ["a", "b"])


def links(h: np.ndarray, doc: np.ndarray, n: np.ndarray, percent: int, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of one incidence block: entries (doc, h), row sizes n.

    apart: the side of each row; only pairs across sides are wanted. Accumulates the overlaps of
    one row with the rows after it.
    """
    _, col, df = np.unique(h, return_inverse=True, return_counts=True)
    keep = df[col] > 1  # a column of one row adds to no overlap
    doc, col = doc[keep], col[keep]
    by_col = np.argsort(col, kind="stable")  # rows stay in order inside a posting list
    posted, start = doc[by_col], np.searchsorted(col[by_col], np.arange(len(df) + 1))
    first = np.searchsorted(doc, np.arange(len(n) + 1))
    out_a, out_b = [], []
    for i in range(len(n)):
        cols = col[first[i] : first[i + 1]]
        if not len(cols):
            continue
        length = start[cols + 1] - start[cols]
        total = int(length.sum())
        skip = np.repeat(start[cols] - (np.cumsum(length) - length), length)
        overlap = np.bincount(posted[np.arange(total) + skip], minlength=len(n))[i + 1 :]
        if not overlap.any():
            continue
        j = np.flatnonzero(100 * overlap >= percent * (n[i] + n[i + 1 :] - overlap)) + i + 1
        if apart is not None:
            j = j[apart[j] != apart[i]]
        out_a.append(np.full(len(j), i))
        out_b.append(j)
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def _products(join: Join):
    """Spanning links of each block of rows; the rows of one block come together."""

    def product(rows: list[tuple[np.ndarray, np.int64, int]]) -> tuple[np.ndarray, np.ndarray]:
        sets: dict[int, tuple[np.ndarray, int]] = {}
        for h, node, side in rows:
            sets.setdefault(node, (h, side))
        nodes = np.array(sorted(sets, key=lambda x: len(sets[x][0])), np.int64)
        n = np.array([len(sets[x][0]) for x in nodes.tolist()], np.int64)
        h = np.concatenate([sets[x][0] for x in nodes.tolist()])
        side = np.array([sets[x][1] for x in nodes.tolist()])
        # blocks on the diagonal have one side only
        a, b = links(h, np.repeat(np.arange(len(n)), n), n, join.percent, side if len(set(side.tolist())) > 1 else None)
        x, root = local_components(nodes[a], nodes[b])
        return x[x != root], root[x != root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, a, b = None, [], [], []
        for batch in batches:
            for c in chunks(batch):
                s = Sets(column(c, "text"), join.words)
                keys = zip(column(c, "cluster").to_pylist(), column(c, "one").to_pylist(), column(c, "two").to_pylist(), strict=True)
                for d, (k, side) in enumerate(zip(keys, column(c, "side").to_pylist(), strict=True)):
                    if k != key:
                        if len(rows) > 1:
                            x, y = product(rows)
                            a.append(x)
                            b.append(y)
                        key, rows = k, []
                    if s.n[d]:
                        rows.append((s.h[s.first[d] : s.first[d + 1]], int(s.node[d]), side))
        if len(rows) > 1:
            x, y = product(rows)
            a.append(x)
            b.append(y)
        none = [np.zeros(0, np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a or none)), pa.array(np.concatenate(b or none))], ["a", "b"])

    return run


def _row_key() -> Column:
    """A key of its own for each row, with or without an id; only rows equal in doc_id and text share one."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def _few(text: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """The rows of text whose row is in a written table, and a few others, where they lie.

    The table is broadcast as a field of 64 bits a row of it, `most` bits at most (in words of 64), so what it lets pass by chance is a 64th of the rows or the
    share of its rows in `most`. A join on row then moves these texts alone.
    """
    bits = min(most, 1 << max(6, (64 * wanted.count()).bit_length()))
    place = F.pmod("row", F.lit(bits))
    word, bit = F.shiftright(place, 6).alias("word"), F.expr(f"int(pmod(row, {bits}) % 64)")
    field = wanted.select(word, F.expr(f"shiftleft(1L, int(pmod(row, {bits}) % 64))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("field"))
    return text.withColumn("word", word).join(F.broadcast(field), "word").filter(F.getbit("field", bit) == 1).drop("word", "field")


def _meetings(rows: DataFrame, begin: int, step: int) -> DataFrame:
    """Rows at each meeting of their block with those that lie begin, begin + 1, ... of `step` blocks on, round the blocks of their cluster."""
    on = F.filter(F.sequence(F.lit(begin), F.lit(begin + step - 1)), lambda d: 2 * d <= F.col("blocks"))
    pair = lambda x, y: F.struct(F.least(x, y).alias("one"), F.greatest(x, y).alias("two"))
    both = lambda d: F.array(pair(F.col("block"), F.pmod(F.col("block") + d, "blocks")), pair(F.col("block"), F.pmod(F.col("block") - d, "blocks")))
    dealt = rows.withColumn("m", F.explode(F.array_distinct(F.flatten(F.transform(on, both)))))
    return dealt.select("cluster", "m.one", "m.two", F.col("block").alias("side"), "text").repartition("cluster", "one", "two").sortWithinPartitions("cluster", "one", "two")


def _classes(docs: DataFrame, join: Join) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row (its key), n_shingles, node (null without words)) of each row of docs, and (node, class) of nodes that have links."""
    spark = docs.sparkSession
    arrow_limits(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row"), "text")
    sets = written(text.mapInArrow(_set_rows(join), "doc_id long, row long, n_shingles long, node long"), "sets")
    common = spark.sparkContext.broadcast(common_columns(text, join))
    sigs = text.select("text").mapInArrow(_signature_rows(join, common), "sig long, node long, n int, odd long")
    packed = sigs.repartition("sig").sortWithinPartitions("sig", "n", "node").mapInArrow(_chains(join), "part int, a binary, b binary")
    edges = packed.repartition("part").mapInArrow(_merged, "a long, b long")
    cluster = connected_components(edges)

    # one text of each node, dealt to blocks of its cluster
    node = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min("row").alias("row"), F.max("n_shingles").alias("n"))
    node = node.join(cluster, "node").withColumnRenamed("label", "cluster")
    size = node.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / join.rows, F.sum("n") / join.entries)).cast("int").alias("blocks"))
    node = node.join(size, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    node = written(node.select("row", "cluster", "block", "blocks", "n"), "dealt")
    rows = _few(text.select("row", "text"), node, join.bits).join(node, "row")
    found = [written(_meetings(rows.filter("blocks = 1"), 0, 1).mapInArrow(_products(join), "a long, b long"), "links")]
    size = node.filter("blocks > 1").agg(F.max("blocks").alias("blocks"), F.sum("n").alias("n")).first()
    if size.blocks:
        large = written(rows.filter("blocks > 1"), "large")
        step = min(max(1, join.moved // (16 * size.n + 1)), size.blocks)  # about eight bytes of text an n-gram, two copies for each distance of blocks
        for begin in range(0, size.blocks // 2 + 1, step):
            found.append(written(_meetings(large, begin, step).mapInArrow(_products(join), "a long, b long"), "links"))
        dropped(large)
    dropped(node)
    label = connected_components(functools.reduce(DataFrame.unionByName, found))
    dropped(*found)
    return sets, label.withColumnRenamed("label", "class")


def _nodes(sets: DataFrame, classes: DataFrame, *least) -> DataFrame:
    """A row for each node: node, class, copies and the given minima over its rows; a node without links is its own class."""
    node = sets.filter("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), *least)
    return node.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))


def jaccard_classes(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (see above), node (null without words)."""
    sets, classes = _classes(docs, join)
    node = written(_nodes(sets, classes, F.min("doc_id").alias("least")), "nodes")
    least = written(node.groupBy("class").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes")), "least")
    node = written(looked_up(node.select("node", "class", "copies"), least, ["class"], "nodes").select("node", "component_id", "copies"), "components")
    dropped(least)
    out = looked_up(sets.filter("node IS NOT NULL"), node, ["node"], "copies").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "node")
    return out.unionByName(sets.filter("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "node"))


def one_of_each(docs: DataFrame, join: Join = Join(words=5, percent=80)) -> DataFrame:
    """The rows of docs without near duplicates: of each class, the row of the smallest doc_id.

    A null doc_id stands behind all others. Of rows equal in doc_id and text one stays; texts without words are
    classes of their own otherwise. All columns stay, whatever their names.
    """
    sets, classes = _classes(docs, join)
    (key,) = free_names(docs, "__row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = _nodes(sets, classes, F.min(order).alias("least")).groupBy("class").agg(F.min("least")["row"].alias(key)).select(key)
    kept = written(kept.unionByName(sets.filter("node IS NULL").select(F.col("row").alias(key)).distinct()), "kept")
    rows = docs.withColumn(key, _row_key()).join(kept, key, "left_semi").drop(key)
    twice = sets.groupBy("row").count().filter("count > 1")
    return rows if twice.isEmpty() else rows.dropDuplicates(["doc_id", "text"])


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir)).drop("node")
