"""Words and hashes against plain splitting."""

from __future__ import annotations

import subprocess
import sys

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cardmill.llm.words import Words, chunks, column

from .conftest import split

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té日 \x1f\xa0", max_size=30)), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_words(texts):
    w = Words(pa.array(texts, pa.string()), lower=True)
    assert [[w.word(i) for i in range(w.first[d], w.first[d + 1])] for d in range(len(texts))] == [split(t) for t in texts]
    seen = {}
    for i, h in enumerate(w.hashes().tolist()):
        assert seen.setdefault(h, w.word(i)) == w.word(i)
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=40, deadline=None)
@given(TEXT, st.integers(1, 4))
def test_sequences(texts, k):
    w = Words(pa.array(texts, pa.string()))
    at, doc = w.windows(k)
    seen = {}
    for a, d, h0, h1 in zip(at.tolist(), doc.tolist(), w.seq_hash(at, at + k).tolist(), w.seq_hash(at, at + k, 1).tolist(), strict=True):
        seq = tuple(w.word(i) for i in range(a, a + k))
        assert w.first[d] <= a and a + k <= w.first[d + 1]
        assert seen.setdefault((h0, h1), seq) == seq
    assert len(set(seen.values())) == len(seen)


def test_chunks_keep_all_rows():
    b = pa.record_batch({"text": pa.array(["a" * 10, None, "b" * 3000, "", "c"], pa.string()), "k": pa.array(range(5))})
    parts = list(chunks(b, limit=100))
    assert sum((column(p, "k").to_pylist() for p in parts), []) == list(range(5)) and len(parts) > 1


def test_freed_arrays_keep_their_pages_until_release():
    """Without retain() each of the arrays would fault its 1500 pages in again."""
    code = """if True:
        import resource, numpy as np
        from cardmill.llm.words import release, retain
        faults = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_minflt
        retain()
        x = np.ones(3_100_000, np.int8), np.ones(3_100_000, np.int8)
        del x
        before = faults()
        for _ in range(50):
            x = np.ones(3_100_000, np.int8), np.ones(3_100_000, np.int8)
            del x
        assert faults() - before < 5000, faults() - before
        release()
    """
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60)
