"""Extremes that operators must pass without crash or loss: tiny texts, odd ids, null lists, long vectors, and bounds set too low."""

from __future__ import annotations

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmill.llm import ann, packing, warc

from .test_operators import check_packed, plain_nearest


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(segments=10), packing.Limits(loss=500)])
def test_tiny_texts_are_hardly_padded(spark, limits):
    rows = [(i, "a b") for i in range(5000)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), limits=limits).collect()
    check_packed(rows, got, packing.byte_bpe())
    sizes, pieces = collections.Counter(), collections.Counter()
    for p in got:
        sizes[p.sequence_id] += p.length
        pieces[p.sequence_id] += 1
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes.values())
    assert padding < 0.02 * sum(sizes.values()) and max(pieces.values()) <= limits.segments and max(sizes.values()) <= min(2048, limits.loss)


def test_conversations_with_null_and_unequal_lists(spark):
    rows = [(1, None, ["x y", "z"]), (2, ["assistant"], None), (3, ["user", None, "assistant"], ["a", None, "b c"]), (4, ["assistant", "user"], ["q"]), (5, None, None), (6, [], []), (None, ["assistant"], ["r"])]
    encode = packing.byte_bpe()
    got = packing.pack_conversations(spark.createDataFrame(rows, "doc_id long, roles array<string>, texts array<string>").withColumn("rank", F.lit(1))).collect()
    tokens, loss = collections.Counter(), collections.Counter()
    for p in got:
        tokens[p.doc_id] += p.length
        loss[p.doc_id] += p.loss_tokens
    n = lambda *texts: sum(len(encode(t)) for t in texts)
    assert tokens == {1: n("x y", "z"), 2: n(""), 3: n("a", "", "b c"), 4: n("q", ""), None: n("r")}
    assert (loss[1], loss[2], loss[3], loss[4], loss[None]) == (0, n(""), n("b c"), n("q"), n("r"))


def test_warc_of_far_ids(spark, tmp_path):
    ids = [10**13, 3 * 10**11, -7 * 10**10, 1, 0, -(2**63), 2**63 - 1, 253402300800, None]
    df = spark.createDataFrame([(i, "http://a/", f"page {i}", "x") for i in ids], "page_id long, url string, html string, digest string").withColumns({"n": F.lit(1), "o": F.lit("o"), "value": F.lit("v")})
    warc.write_archives(df, str(tmp_path / "w"), per_file=2)
    got = [r.page_id for r in warc.merge_index(warc.read_index(spark, str(tmp_path / "w"))).collect()]
    assert [i for i in got if i is not None] == sorted(i for i in ids if i is not None) and len(got) == len(ids)


def test_warc_of_long_pages(spark, tmp_path):
    rows = [(1, "http://a/", "x" * 20_000_000), (2, "http://a/", "x" * 20_000_000), (3, "http://b/", "é" * 5_000_000)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.merge_index(warc.read_index(spark, str(tmp_path / "w"))).collect()}
    assert got == {1: (20_000_000, "revisit", 2), 2: (20_000_000, "response", None), 3: (10_000_000, "response", None)}


def recall(spark, base, index):
    df = spark.createDataFrame(base, "vec_id long, embedding array<double>").withColumns({"key": F.lit(1), "ids": F.lit("x"), "rank": F.lit(None)}).repartition(3)
    got = collections.defaultdict(set)
    for r in ann.search(df.filter("vec_id % 20 = 0"), df, index).collect():
        got[r.query_id].add(r.vec_id)
    return float(np.mean([len(got[q] & {i for _, i in w}) / len(w) for q, w in plain_nearest(base, index.k).items() if w]))


def grouped(n, d=32):
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(n // 30, d)), 30, 0) + 0.3 * rng.normal(size=(n // 30 * 30, d))
    return x / np.sqrt((x * x).sum(1))[:, None]


def test_long_vectors_leave_the_index_as_it_is(spark):
    x = grouped(1500)
    long = np.concatenate((x, 1000 * x[:1], 1e-3 * x[1:3], 1e170 * x[5:6]))
    assert recall(spark, [(i + 1, v.tolist()) for i, v in enumerate(long[:-1])], ann.Index()) >= 0.9
    ranges = lambda v: ann.ranges_of([(int(e), float(n.min()), float(n.max())) for e in np.unique(np.frexp(ann.norm_of(v))[1]) for n in [ann.norm_of(v)[np.frexp(ann.norm_of(v))[1] == e]]])
    assert len(ranges(x)) == 1 and len(ranges(long)) == 4  # norms on both sides of 1 are one range
    index = ann.Index(hashes=9, probes=4)
    alone, with_long = ann.visited(x[::20], x, index), ann.visited(x[::20], long, index)
    assert with_long[0] <= 1.05 * alone[0] and with_long[0] < 0.6


def test_squares_that_overflow_and_probes_that_do_not_suffice(spark):
    x = grouped(600)
    assert recall(spark, [(i, (v * (1e160 if i % 20 else 1)).tolist()) for i, v in enumerate(x)], ann.Index()) >= 0.9
    rng = np.random.default_rng(1)
    even = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 32)))]
    assert recall(spark, even, ann.Index(probes=1, tables=1, hashes=9)) == 1.0
