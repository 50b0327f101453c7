"""What each stage of the pipeline takes away and what it leaves, on planted documents among the given ones."""

from __future__ import annotations

import collections

from pyspark.sql import functions as F

from cardmill.llm import packing
from cardmill.llm.store import written

JUNK, ONE, TWO, LEFT, RIGHT, TOXIC = (10**6 + i for i in range(6))


def test_decisions_take_effect(spark, small):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.join(labels, "doc_id").filter("toxic = 0 AND quality = 1 AND lang = 'en'").select("doc_id", "text").collect()}
    long = sorted((t.split() for t in texts.values() if len(t.split()) > 250), key=len)[:3]
    assert len(long) == 3
    a, b, c = long
    passage = c[40:90]
    bad = next(r.text for r in docs.join(labels, "doc_id").filter("toxic = 1").orderBy("doc_id").collect() if len(r.text.split()) > 20)
    planted = {JUNK: "too few words", ONE: " ".join(a[:150]), TWO: " ".join([*a[:149], "changed"]), LEFT: " ".join([*a[150:210], *passage]), RIGHT: " ".join([*b[100:170], *passage]), TOXIC: bad}
    more = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in planted.items()], docs.schema)
    now, seen = docs.unionByName(more), []
    for name, stage in p.STAGES:
        now = written(stage(spark, now, small), name)
        seen.append(now)
    ids = [{r.doc_id for r in s.select("doc_id").distinct().collect()} for s in seen]
    assert JUNK not in ids[0] and {ONE, TWO, LEFT, RIGHT, TOXIC} <= ids[0]
    assert TOXIC not in ids[1] and {ONE, TWO, LEFT, RIGHT} <= ids[1]
    assert len({ONE, TWO} & ids[2]) == 1 and {LEFT, RIGHT} <= ids[2]
    assert ids[3] == ids[2]  # no document goes for its passages
    for s in seen[:-1]:
        assert s.columns == docs.columns
    after = {r.doc_id: r.text for r in seen[3].select("doc_id", "text").collect()}
    for i in (LEFT, RIGHT):
        assert " ".join(passage) not in after[i] and set(after[i].split()) <= set(planted[i].split())
    given = {r.doc_id: r.text for r in seen[2].select("doc_id", "text").collect()}
    assert sum(after[i] == given[i] for i in given if i < JUNK) > 0.5 * len(given)  # texts without repeats are as they were
    encode, packed = packing.byte_bpe(), collections.Counter()
    for r in seen[4].collect():
        packed[r.doc_id] += r.length
    assert packed == {i: len(encode(t)) for i, t in after.items()}
    clean = docs.join(labels, "doc_id").filter("toxic = 0 AND quality = 1").select(F.col("doc_id"))
    n = clean.count()
    assert clean.join(seen[1].select("doc_id"), "doc_id", "left_semi").count() >= 0.95 * n
