"""Importance resampling and fill in the middle against plain versions of their contracts, on hard rows and small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cardmill.llm import fill_middle, importance


def ident(i) -> str:
    return hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()


# 11. importance resampling


def features(text) -> list[str]:
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def check_resampled(docs, target, s=importance.Sampling()):
    bucket = lambda g: zlib.crc32(g.encode()) % s.buckets
    rows = [(r.doc_id, *features(r.text)) for r in docs.select("doc_id", "text").collect()]
    have, want = (collections.Counter(bucket(g) for fs in x for g in fs) for x in ([f for _, _, f in rows], [features(r.text)[1] for r in target.select("text").collect()]))
    a, b = sum(have.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[k] + 1) * (a + s.buckets) / ((have[k] + 1) * (b + s.buckets)))) for k in range(s.buckets)]
    scored = []
    for i, w, fs in rows:
        weight = sum(gain[bucket(g)] for g in fs)
        h = int(ident(i)[:8], 16)
        scored.append((i, len(w), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((x for x in scored if x[1] >= s.least_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    ranks = collections.defaultdict(list)
    for n, x in enumerate(may[: s.percent * len(may) // 100], 1):
        ranks[x].append(n)
    expected = sorted(repr((*x[:1], *x[2:], ranks[x].pop() if x[1] >= s.least_words and ranks[x] else None)) for x in scored)
    got = sorted(repr((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in importance.resampled(docs, target, s).collect())
    assert got == expected


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resampling_is_the_plain_one(spark, hard, small, percent):
    target = spark.read.parquet(f"{small}/benchmark.parquet")
    s = importance.Sampling(percent=percent)
    if percent != 100:  # rows that repeat share scores and ids, so which of them has a rank is open
        check_resampled(spark.read.parquet(f"{small}/documents.parquet"), target, s)
    check_resampled(hard, target, s)


def test_resampling_edges(spark, hard, empty):
    assert importance.resampled(empty, hard).collect() == []
    check_resampled(hard, empty)
    nulls = spark.createDataFrame([(None, "w " * 30)] * 40 + [(i, None) for i in range(5)], "doc_id long, text string")
    out = importance.resampled(nulls, hard, importance.Sampling(percent=50)).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 21))
    assert all(r.weight == r.n_features == 0 for r in out if r.doc_id is not None)


def test_slices_keep_words_and_ring(monkeypatch):
    text = " ".join(f"Wört{i} x-{i}" for i in range(500)) + "e" * 300 + " "
    s = importance.Sampling()
    whole = [x.tolist() for _, x in importance.bucket_runs(text.encode(), s)]
    monkeypatch.setattr(importance, "SLICE", 50)
    parts = [x.tolist() for _, x in importance.bucket_runs(text.encode(), s)]
    assert len(whole) == 1 and len(parts) > 50 and sum(parts, []) == whole[0]
    assert sorted(whole[0]) == sorted(zlib.crc32(g.encode()) % s.buckets for g in features(text)[1])


def test_target_documents_are_drawn(spark):
    """Documents in the target's words come out first."""
    r = random.Random(3)
    text = lambda words: " ".join(r.choice(words) for _ in range(60))
    a, b = ["alpha", "beta", "gamma", "delta"], ["one", "two", "three", "four"]
    docs = spark.createDataFrame([(i, text(a if i % 10 == 0 else b)) for i in range(200)], "doc_id long, text string")
    target = spark.createDataFrame([(text(a),) for _ in range(5)], "text string")
    out = importance.resampled(docs, target, importance.Sampling(percent=10)).filter("rank IS NOT NULL").collect()
    assert len(out) == 20 and all(x.doc_id % 10 == 0 for x in out)


# 12. fill in the middle


def check_fill(df):
    want = []
    for i, text in [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]:
        u = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        h = [int(ident(i)[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
        p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
        assert p + m + s == text
        if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
            want.append((i, len(u), "plain", None, None, text))
        elif h[3] % 100 < 80:
            want.append((i, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"))
        else:
            want.append((i, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))
    out = fill_middle.transformed(df)
    got = out.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got)
    texts = sorted(r.text or "" for r in df.select("text").collect())
    assert sorted(r.back for r in got) == texts


def test_fill_middle(spark, hard, small, empty):
    check_fill(hard)
    check_fill(spark.read.parquet(f"{small}/documents.parquet"))
    assert fill_middle.transformed(empty).collect() == []


def test_fill_middle_marks_and_spaces(spark):
    odd = ["<", "<<S", "a <S", "<S>", "x<P>y", "<M>", "P> <", " \t\n", "  a", "a  ", " b c", "é😀 ß\x1c\x0b日本", "<P <S <M ", "\x85 \x1f"]
    check_fill(spark.createDataFrame([(i * 100 + k, t + " " * (k % 3)) for i, t in enumerate(odd) for k in range(12)], "doc_id long, text string"))


def test_fill_middle_long_text_stays_bounded():
    """The matcher holds one match at a time: ten million characters cost no list of tokens."""
    import tracemalloc

    text = memoryview(b"word\n " * 1_500_000)
    tracemalloc.start()
    n, a, b = fill_middle.cut(text, 10**9 + 7, 10**9 + 7_000_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1_500_001 and 0 < a < b < len(text) and peak < 100_000
