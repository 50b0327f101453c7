"""Each operator against a plain version of its contract, on hard rows and on the smallest tables."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardmill.llm import ann, components, lattice, licenses, ngram_join, packing, quality, substring, suffix_tree, toxicity, warc

from .conftest import split, words


def pairs(df) -> list[tuple]:
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# 1. language model


def check_scores(df, scored):
    n_of = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7
    rows, c = pairs(df), collections.Counter()
    for i, t in rows:
        if n_of(i) != 2:
            c.update([*split(t), b" "])
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), n_of(i) == 2, len(split(t)) + 1, sum(c[w] > 0 for w in [*split(t), b" "]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*split(t), b" "]), 4)) for i, t in rows)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in scored.collect())
    assert got == want
    assert all(r.score < 0 for r in scored.collect())


def learn():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2


def test_suffix_tree_scores(spark, small, hard, empty):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    scored = suffix_tree.score_documents(docs, learn())
    check_scores(docs, scored)
    held = scored.filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held.s > held.b
    check_scores(hard, suffix_tree.score_documents(hard, learn()))
    assert suffix_tree.score_documents(empty, learn()).collect() == []
    assert suffix_tree.score_documents(hard, F.lit(False)).filter("n_known > 0 OR train_tokens > 0").count() == 0


class PlainTree:
    """The tree of some texts by counting, a context after the other."""

    def __init__(self, texts, t):
        self.t, self.words = t, [[*split(x), b" "] for x in texts]
        seqs = [[b" ", *w] for w in self.words]
        self.n, self.total, self.next, self.states = [], collections.Counter(), collections.defaultdict(list), set()
        for d in itertools.count():
            self.n.append(collections.Counter(tuple(w[i - d : i + 1]) for w in seqs for i in range(max(d, 1), len(w))))
            for s, n in self.n[d].items():
                self.total[s[:-1]] += n
                if n >= t.pair_count:
                    self.next[s[:-1]].append((s[-1], n))
            self.tokens = self.total[()]
            found = {c for c in self.next if 0 < len(c) == d and self.total[c] >= t.context_count and self.gain(c) > 0.5 * math.log(max(self.tokens, 2)) * len(self.next[c])}
            self.states |= found
            fruitful = d if d == 0 or len(found) >= max(1, t.share * len(self.states)) else fruitful
            if d == t.depth or d - fruitful >= t.barren:
                break
        self.types = collections.Counter(self.spelling(w) for (w,) in self.n[0])

    @staticmethod
    def spelling(w):
        if w == b" ":
            return 6
        last = w[-1]
        return 3 * any(x >= 128 for x in w) + (1 if last == 46 else 2 if 33 <= last <= 64 and not 48 <= last <= 57 else 0)

    def gain(self, c):
        above = lambda s: self.n[len(c) - 1][(*c[1:], s)] / self.total[c[1:]]
        return sum(n * math.log(n / self.total[c] / above(s)) for s, n in self.next[c])

    def p(self, context, s):
        """P(s) behind context, where a symbol not in training stands for its spelling."""
        n = self.n[0][(s,)]
        unseen = self.t.word_discount * self.types[self.spelling(s)] + 0.5
        p = (n + 0.5 if s == b" " else n - self.t.word_discount if n else unseen) / (self.tokens + 3.5)
        for d in range(1, len(context) + 1):
            c = tuple(context[-d:])
            if c in self.states:
                own = dict(self.next[c])
                rest = 1 - sum(x - self.t.discount for x in own.values()) / self.total[c]
                p = max(own.get(s, 0) - self.t.discount, 0) / self.total[c] + rest * p
        return p

    def score(self, text):
        w = [b" ", *split(text), b" "]
        return sum(math.log10(self.p(w[max(0, i - len(self.n)) : i], w[i])) for i in range(1, len(w)))


def test_scores_are_those_of_a_plain_tree(spark, small, hard):
    for df, t in ((spark.read.parquet(f"{small}/documents.parquet"), suffix_tree.Tree(segment=3000, part=500)), (hard, suffix_tree.Tree(depth=2, context_count=3)), (hard, suffix_tree.Tree(pair_count=3, segment=500))):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        plain = PlainTree([x for i, x in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2], t)
        assert plain.states
        got = sorted((str(r.doc_id), round(r.score, 6)) for r in suffix_tree.score_documents(df, learn(), t).collect())
        want = sorted((str(i), round(plain.score(x), 6)) for i, x in rows)
        assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-9)
        unseen = [b"\xff" * (k > 2) + (b"zq", b"zq.", b"zq!")[k % 3] for k in range(6)]
        for c in sorted(plain.states, key=repr)[:: max(1, len(plain.states) // 4)]:
            assert abs(sum(plain.p(c, s) for s in [w for (w,) in plain.n[0]] + unseen) - 1) < 1e-9


def test_contexts_of_any_length(spark, tmp_path):
    """What follows a phrase hangs on a word five words back, then on one ten words back."""
    r, rows, own = random.Random(6), [], suffix_tree.Tree(share=0, barren=6, segment=4000, part=500)
    for i in range(900):
        far, near = r.choice(["red", "blue"]), r.choice(["cat", "dog"])
        rows.append((i, f"{far} one two three {near} a b c d " + {"cat": "purrs", "dog": "barks"}[near] + {"red": " x", "blue": " y"}[far] + " " + " ".join(r.choices(words(9, 50), k=20))))
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    plain = PlainTree([x for i, x in rows if zlib.crc32(str(i).encode()) % 7 != 2], own)
    assert tuple(b"cat a b c d".split()) in plain.states and tuple(b"blue one two three dog a b c d barks".split()) in plain.states
    got = sorted((r.doc_id, r.score) for r in suffix_tree.score_documents(docs, learn(), own).collect())
    assert np.allclose([s for _, s in got], [plain.score(x) for _, x in rows], rtol=1e-9)


def thue_morse(n: int) -> tuple[str, str]:
    x = "a"
    for _ in range(n):
        x += x.translate(str.maketrans("ab", "ba"))
    return x, x.translate(str.maketrans("ab", "ba"))


def thue_morse_rows() -> list[tuple]:
    """Texts whose words, lines and windows a polynomial hash modulo 2**64 can't tell apart."""
    x, y = thue_morse(10)
    fill = words(40, 34)
    return [(1, f"{x} one two three four"), (2, f"{y} one two three four"), (3, " ".join([*fill, x])), (4, " ".join([*fill, y])), (5, f"{x} b\n{y} b\n{x} b\nc"), (6, " ".join(x)), (7, " ".join(y)), (8, f"{x} a b c d {y} a b c d")]


def test_words_that_linear_hashes_confuse(spark, tmp_path):
    rows = thue_morse_rows()
    path = str(tmp_path / "d")
    spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string").write.parquet(path)
    df = spark.read.parquet(path)
    check_scores(df, suffix_tree.score_documents(df, learn()))
    one = suffix_tree.score_documents(df, F.col("doc_id") == 1).filter("doc_id = 2").first()
    assert (one.n_tokens, one.n_known) == (6, 5)
    got = sorted((str(r.doc_id), hashlib.sha256(b" ".join(split(r.text, False))).hexdigest()) for r in substring.deduplicated(df).collect())
    assert got == sorted((i, h) for i, _, _, h in plain_removed(rows))
    for k in (2, 4):
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.jaccard_classes(df, ngram_join.Join(words=k)).collect())
        assert got == plain_classes(rows, k, 85)
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.quality_rules(df).collect())
    assert got == sorted((str(i), *plain_counts(t)) for i, t in rows)


def test_context_is_used(spark, tmp_path):
    r = random.Random(3)
    flow = lambda: " ".join(x for _ in range(200) for x in r.choice((["red", "fox", "runs"], ["blue", "whale", "swims"])))
    path = str(tmp_path / "d")
    spark.createDataFrame([(i, flow()) for i in range(60)], "doc_id long, text string").write.parquet(path)
    got = suffix_tree.score_documents(spark.read.parquet(path), learn()).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > 0.55 * got.b


def test_rare_contexts_are_states(spark, tmp_path):
    r = random.Random(4)
    vocabulary = words(8, 200)
    rows = [(i, " ".join(r.choices(vocabulary, k=500) + ["zig", "zag"] * (i % 40 == 0))) for i in range(2, 250)]
    path = str(tmp_path / "d")
    spark.createDataFrame([(0, "zig zag"), (1, "zag zig"), *rows], "doc_id long, text string").coalesce(1).write.parquet(path)
    got = {x.doc_id: x.score for x in suffix_tree.score_documents(spark.read.parquet(path), F.col("doc_id") > 1).filter("held_out").collect()}
    assert got[0] - got[1] > 2  # zig is seen 6 times in 124000 tokens


def test_sorting_of_hashes_that_share_leading_bits():
    r = np.random.default_rng(3)
    h = np.concatenate([r.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)] * 2)
    for x in (h, np.concatenate((h, h[:9] + np.uint64(1))), h[:1], h[:0], np.repeat(h[:3], 5)):
        assert (suffix_tree.sorting(x) == np.argsort(x, kind="stable")).all()


def test_carried_states_are_small_and_lose_nothing(spark):
    t, r, one = suffix_tree.Tree(), random.Random(8), np.uint64(1)
    base = [f"w{r.randrange(400)}" for _ in range(3000)]
    texts = [" ".join("x" if r.random() < 0.02 else w for w in base[a : a + 300]) for a in (r.randrange(2700) for _ in range(120))]
    rows = spark.createDataFrame([(k, x, True) for k, x in enumerate(texts)], "doc_id long, text string, learn boolean").coalesce(1)
    (row,) = rows.mapInArrow(suffix_tree._segments(t), "seg long, words binary, texts binary, more binary").collect()
    whole, late = (suffix_tree.Segment(t, row.words, row.texts) for _ in range(2))
    counts = suffix_tree._unbundle(row.more, 2)[1]
    whole.tokens = late.tokens = int(counts.sum())
    whole.answered(0, counts << one | one)
    for d in range(1, 9):
        x = whole.extended(d)
        value = whole.question(x)[1] << one | one
        if d >= suffix_tree._SPARSE:
            data = whole.carried(x)
            assert len(data) < 8 * len(x.at)  # no hash of a context travels
            late.resumed(d, data, value)
        whole.answered(d, value)
        if d >= suffix_tree._SPARSE:
            both = [(*s.question(s.extended(d + 1)), s.open_contexts(d)[0], *s.open_contexts(d)[1]) for s in (whole, late)]
            assert len(both[0][0]) and all((a == b).all() for a, b in zip(*both, strict=True))


def test_scores_do_not_depend_on_segments(spark, tmp_path):
    r = random.Random(5)
    phrases = [" ".join(words(100 + i, 3)) for i in range(400)]
    weights = [k**-1.5 for k in range(1, 401)]
    follow = [r.sample(range(400), 400) for _ in range(400)]

    def text() -> str:
        out, at = [], r.randrange(400)
        for rank in r.choices(range(400), weights, k=700):
            out.append(phrases[at])
            at = follow[at][rank]
        return " ".join(out)

    path = str(tmp_path / "d")
    spark.createDataFrame([(i, text()) for i in range(500)], "doc_id long, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    one, other = ({x.doc_id: x.score for x in suffix_tree.score_documents(docs, learn(), suffix_tree.Tree(segment=n)).collect()} for n in (500_000, 100_000))
    assert one.keys() == other.keys() and all(abs(one[i] - other[i]) < 1e-6 * abs(one[i]) for i in one)


# 2. substring deduplication


def plain_removed(rows, k=35):
    c = collections.Counter()
    for _, t in rows:
        w = split(t, False)
        c.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for i, t in rows:
        w = split(t, False)
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if c[tuple(w[a : a + k])] > 1:
                gone[a : a + k] = [True] * k
        out.append((str(i), len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def test_substring_dedup(spark, small, hard, empty):
    for df in (spark.read.parquet(f"{small}/documents.parquet"), hard):
        got = []
        for r in substring.deduplicated(df).collect():
            got.append((str(r.doc_id), hashlib.sha256(b" ".join(split(r.text, False))).hexdigest()))
        assert sorted(got) == sorted((i, h) for i, _, _, h in plain_removed(pairs(df)))
    out = substring.deduplicated(hard)
    assert out.schema == hard.schema
    kept = {r.doc_id: r for r in out.filter("doc_id IN (4, 5, 6, 15)").collect()}
    assert kept[4].text is None and kept[6].text == " \n\t " and kept[15].text.endswith("line\nline\n")
    assert substring.deduplicated(empty).collect() == []
    runs = substring.repeats(hard).filter("doc_id = 10").collect()
    assert [(r.first_word, r.n_words) for r in runs] == [(50, 60)]


def test_spans_of_repeated_rows(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = [(1, " ".join(words(11, 300)))] * 30 + [(2, " ".join(words(11, 300)[50:200] + words(12, 100)))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    df = spark.read.parquet(path)
    spans = [r[-1] for part in substring.repeated_spans(df) for r in part.collect()]
    assert len(spans) == 31 and all(len(x) == len(set(x)) for x in spans)
    got = sorted((str(r.doc_id), hashlib.sha256(b" ".join(split(r.text, False))).hexdigest()) for r in substring.deduplicated(df).collect())
    assert got == sorted((i, h) for i, _, _, h in plain_removed(pairs(df)))


def test_columns_with_inner_names(spark, hard, tmp_path):
    inner = ["__rid", "__spans", "__more", "__row", "__id", "spans", "node", "class", "component_id", "a", "words", "texts", "seg"]
    path = str(tmp_path / "d")
    hard.select("doc_id", "text", "lang", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in inner)).write.parquet(path)
    df = spark.read.parquet(path)
    for f in (substring.deduplicated, ngram_join.one_of_each, quality.keep_documents):
        out = f(df)
        assert out.schema == df.schema
        for r in out.collect():
            assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for c in inner)
    assert sorted(pairs(substring.deduplicated(df)), key=repr) == sorted(pairs(substring.deduplicated(hard)), key=repr)
    assert sorted(pairs(ngram_join.one_of_each(df)), key=repr) == sorted(pairs(ngram_join.one_of_each(hard)), key=repr)
    check_scores(df, suffix_tree.score_documents(df, learn()))


def test_many_places_of_one_key(spark, tmp_path):
    """Keys that very many rows have take another way than the others."""
    passage = words(60, 50)
    rows = [(i, " ".join(words(5000 + i, 20) + passage + words(9000 + i, 20))) for i in range(400)] + [(1000 + i, " ".join(words(61, 45))) for i in range(300)]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    df = spark.read.parquet(path)
    got = sorted((str(r.doc_id), hashlib.sha256(b" ".join(split(r.text, False))).hexdigest()) for r in substring.deduplicated(df).collect())
    assert got == sorted((i, h) for i, _, _, h in plain_removed(rows))
    classes = collections.Counter(r.component_id for r in ngram_join.jaccard_classes(df).collect())
    assert classes[1000] == 300 and len(classes) == 401


def test_op2_query(spark, small):
    from cardmill.llm.queries import QUERIES

    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op2_substring_dedup"](spark, small).collect())
    assert got == plain_removed(pairs(spark.read.parquet(f"{small}/documents.parquet")))


# 3. packing


def check_packed(rows, packed, encode):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in packed:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for s in by_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048 and (at >= 2016 or at & (at - 1) == 0)
    want = collections.Counter()
    for i, t in rows:
        want[i] += len(encode(t or ""))
    assert {i: sum(p.length for p in ps) for i, ps in by_doc.items()} == dict(want)
    texts = collections.Counter(i for i, _ in rows)
    for i, t in rows:
        if texts[i] > 1:
            continue
        ids, at = encode(t or ""), 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].astype("<u4").tobytes())
            at += p.length


def test_packing(spark, small, hard, empty):
    encode = packing.byte_bpe()
    for df in (spark.read.parquet(f"{small}/documents.parquet"), hard):
        check_packed(pairs(df), packing.pack_documents(df).collect(), encode)
    assert packing.pack_documents(empty).collect() == []


def test_ids_are_the_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    t, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.byte_bpe()
    for text in ("", "a <|endoftext|> b", "Ünïcode 日本  \x85  x\r\n\t1234's I'LL", "A" * 3000, " " * 999 + "."):
        assert encode(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]


def test_long_white_space(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    t, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.byte_bpe()
    rows = [(i, c * 1_000_000 + "x") for i, c in enumerate(" \n")] + [(2, "plain text")]
    for _, text in rows:
        assert encode(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]
    check_packed(rows, packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), encode)


def test_all_limits_hold():
    r = random.Random(1)
    p = packing.Packer(packing.Limits(tokens=64, segments=4, loss=40, pending=10), 0)
    out, total = [], 0
    for i in range(300):
        ids = np.arange(r.randint(1, 90), dtype=np.uint32)
        total += len(ids)
        out += p.add(i, ids, np.array([r.random() < 0.7 for _ in ids]))
    out += p.finish()
    by = collections.defaultdict(list)
    for _, _, n, _, loss, seq, _ in out:
        by[seq].append((n, loss))
    assert sum(n for s in by.values() for n, _ in s) == total
    for s in by.values():
        assert sum(n for n, _ in s) <= 64 and len(s) <= 4 and sum(x for _, x in s) <= 40


def test_conversations(spark):
    rows = [(1, ["user", "assistant"], ["hello there", "general answer " * 50]), (2, None, None), (3, ["assistant"], [None])]
    got = packing.pack_conversations(spark.createDataFrame(rows, "doc_id long, roles array<string>, texts array<string>")).collect()
    assert {r.doc_id for r in got} == {1, 3} and sum(r.loss_tokens for r in got if r.doc_id == 1) == len(packing.byte_bpe()("general answer " * 50))


# 4. toxicity


def test_toxicity(spark, small, hard, empty):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(1200):
        bad = i % 8 == 0
        w = words(10_000 + i, 60)
        if bad:
            w[10:13] = [r.choice(["nasty", "awful!", "stemxx" + words(i, 1)[0], "Foul,"]) for _ in range(3)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    train = lab.filter(toxicity.is_training(F.col("doc_id")))
    model = toxicity.train(docs, train)
    got = {x.doc_id: x.score for x in toxicity.scores(docs, model).collect()}
    held = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == (i % 8 == 0) for i in held) >= 0.98 * len(held)
    out = toxicity.scores(hard, model).collect()
    assert len(out) == hard.count() and all(0 <= x.score <= 1 for x in out)
    assert toxicity.scores(empty, model).collect() == []
    assert toxicity.clean_documents(hard, lab.limit(0)).count() == hard.count()
    kept = toxicity.clean_documents(docs, lab)
    assert kept.schema == docs.schema and kept.count() <= 1060
    odd = lab.unionByName(spark.createDataFrame([(None, 1), (1, 1), (3, None), (5, 7)], "doc_id long, toxic int"))
    assert len(toxicity.train(docs, odd).voters) > 0


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    rates = [(0.8, 0.05), (0.7, 0.02), (0.6, 0.1), (0.5, 0.5)]
    votes = np.stack([np.where(y, rng.random(4000) < a, rng.random(4000) < b) for a, b in rates], 1).astype(float)
    votes = np.column_stack((votes, votes[:, 0]))  # a voter that repeats another
    p, found = toxicity.label_model(votes, (np.where(rng.random(4000) < 0.05, ~y, y)).astype(int), toxicity.Supervision())
    assert ((p > 0.5) == y).mean() > 0.95 and abs(found["rates"][1][1] - 0.7) < 0.1
    assert found["parents"].tolist() == [-1, -1, -1, -1, 0, -1]  # the voter that repeats another hangs from it and adds nothing
    assert (found["given"][:, 1, 4] > 0.99).all() and (found["given"][:, 0, 4] < 0.01).all()


def test_label_model_finds_joint_rates():
    """Planted voters in a chain and a pair, with known rates for either vote of their parents; one pair repels."""
    rng = np.random.default_rng(1)
    n = 20_000
    y = rng.random(n) < 0.3
    given = {0: (None, (0.05, 0.6), None), 1: (0, (0.02, 0.2), (0.5, 0.9)), 2: (1, (0.03, 0.1), (0.6, 0.8)), 3: (None, (0.3, 0.5), None), 4: (3, (0.4, 0.7), (0.1, 0.2)), 5: (None, (0.02, 0.5), None)}
    votes = np.zeros((n, 6))
    for j, (parent, off, on) in given.items():
        rate = np.where(y, off[1], off[0])
        if parent is not None:
            rate = np.where(votes[:, parent] == 1, np.where(y, on[1], on[0]), rate)
        votes[:, j] = rng.random(n) < rate
    label = np.where(rng.random(n) < 0.1, ~y, y).astype(int)
    p, found = toxicity.label_model(votes, label, toxicity.Supervision())
    assert found["parents"].tolist() == [-1, 0, 1, -1, 3, -1, -1]
    assert abs(found["prior"] - 0.3) < 0.05 and abs(found["rates"][0, -1] - 0.1) < 0.05 and abs(found["rates"][1, -1] - 0.9) < 0.05
    for j, (parent, off, on) in given.items():
        for c in (0, 1):
            assert abs(found["given"][c, 0, j] - off[c]) < 0.05 and (parent is None or abs(found["given"][c, 1, j] - on[c]) < 0.05), (j, c)
    # posteriors mend the annotator, who is wrong in a tenth of the rows
    assert ((p >= 0.5) == y).mean() > (label == y).mean() + 0.02
    # without the joint rates the voters that repeat each other would count several times
    plain = 1 / (1 + np.exp(-(np.log(found["prior"] / (1 - found["prior"])) + np.column_stack((votes, label)) @ np.log(found["rates"][1] / found["rates"][0]) + (1 - np.column_stack((votes, label))) @ np.log((1 - found["rates"][1]) / (1 - found["rates"][0])))))
    brier = lambda q: ((q - y) ** 2).mean()
    assert brier(p) < brier(plain)


def test_forest_without_voters_or_variation():
    for votes in (np.zeros((5, 0)), np.zeros((5, 3)), np.ones((5, 3)), np.zeros((0, 2))):
        p, found = toxicity.label_model(votes, np.zeros(len(votes), int), toxicity.Supervision())
        assert len(p) == len(votes) and np.isfinite(p).all() and (found["parents"] == -1).all()


def plain_forest(rows, p, m):
    """Edges by falling gain, as long as they close no ring; parents away from the smallest voter of each tree that was entered first."""
    gain = {}
    for j in range(m):
        for k in range(j):
            g = 0.0
            for w in ([1 - q for q in p], p):
                n = sum(w)
                for a in (0, 1):
                    for b in (0, 1):
                        joint = sum(q for q, x in zip(w, rows, strict=True) if x[j] == a and x[k] == b)
                        own, other = sum(q for q, x in zip(w, rows, strict=True) if x[j] == a), sum(q for q, x in zip(w, rows, strict=True) if x[k] == b)
                        g += joint * math.log(joint * n / (own * other)) if joint > 0 else 0
            if g > math.log(len(rows)):
                gain[k, j] = g
    near = {j: [] for j in range(m)}
    root = list(range(m))
    for k, j in sorted(gain, key=gain.get, reverse=True):
        if root[k] != root[j]:
            root = [root[k] if r == root[j] else r for r in root]
            near[k].append(j)
            near[j].append(k)
    parent = [None] * m
    for start in range(m):
        if parent[start] is None:
            parent[start], todo = -1, [start]
            while todo:
                at = todo.pop()
                for other in near[at]:
                    if parent[other] is None:
                        parent[other] = at
                        todo.append(other)
    return parent


def plain_label_model(votes, label, rounds):
    """Expectation maximisation of the two-class model with a forest of voters, one row and one voter after the other."""
    rows = [[*map(float, v), float(x)] for v, x in zip(votes, label, strict=True)]
    m, n = len(rows[0]), len(rows)
    p = [0.95 if x[-1] == 1 else min(0.02 + 0.1 * sum(x[:-1]), 0.3) for x in rows]
    parent = [-1] * m
    for r in range(rounds):
        prior = (sum(p) + 1) / (n + 2)
        if r % 5 == 0:
            parent = [*plain_forest(rows, p, m - 1), -1]
        classes = ([1 - q for q in p], p)
        rate = [[(sum(q * x[j] for q, x in zip(w, rows, strict=True)) + 0.5) / (sum(w) + 1) for j in range(m)] for w in classes]

        def told(c, j, a):
            under = [(q, x[j]) for q, x in zip(classes[c], rows, strict=True) if (x[parent[j]] if parent[j] >= 0 else 0) == a]
            return min(max((sum(q * v for q, v in under) + rate[c][j]) / (sum(q for q, _ in under) + 1), 1e-5), 1 - 1e-5)

        given = [[[told(c, j, a) for a in (0, 1)] for j in range(m)] for c in (0, 1)]
        after = []
        for x in rows:
            f = math.log(prior / (1 - prior))
            for j in range(m):
                a = int(x[parent[j]]) if parent[j] >= 0 else 0
                f += math.log(given[1][j][a] / given[0][j][a]) if x[j] else math.log((1 - given[1][j][a]) / (1 - given[0][j][a]))
            after.append(1 / (1 + math.exp(-min(max(f, -40), 40))))
        done = max(abs(a - b) for a, b in zip(after, p, strict=True)) < 1e-4
        p = after
        if done:
            break
    return p, parent


def test_label_model_is_that_of_plain_em():
    rng = np.random.default_rng(4)
    y = rng.random(300) < 0.25
    votes = np.stack([np.where(y, rng.random(300) < a, rng.random(300) < b) for a, b in ((0.7, 0.05), (0.5, 0.1), (0.6, 0.02), (0.3, 0.2))], 1).astype(float)
    twin = np.where(rng.random(300) < 0.9, votes[:, 2], 1 - votes[:, 2])
    votes = np.column_stack((votes, twin, np.where(rng.random(300) < 0.85, twin, 1 - twin)))
    label = np.where(rng.random(300) < 0.1, ~y, y).astype(int)
    p, found = toxicity.label_model(votes, label, toxicity.Supervision())
    plain, parents = plain_label_model(votes, label, toxicity.Supervision().rounds)
    assert found["parents"].tolist() == parents and parents.count(-1) <= 5
    assert np.allclose(p, plain, atol=1e-9)


def test_training_holds_runs_of_the_sample():
    """What the driver makes of a sample is smaller than one table of its counts in doubles."""
    rng, n, m = np.random.default_rng(5), 6000, 400
    y = rng.random(n) < 0.1
    counts = (rng.random((n, m)) < np.where(y[:, None], 0.05, 0.004)).astype(np.uint16)
    votes, hits, n_words = (counts > 0).astype(np.uint8), counts.sum(1).astype(np.int64), np.full(n, 100)
    tracemalloc.start()
    p, _ = toxicity.label_model(votes, y.astype(int), toxicity.Supervision(rounds=2))
    toxicity.fit(lambda i: toxicity._design(counts[i], hits[i], n_words[i]), p, toxicity.Supervision())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 * n * m + 20e6, most


def test_held_out_toxicity(spark):
    """At least nine tenths of the held-out toxic texts are caught, and one clean text of a hundred at most is flagged."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic IN (0, 1)").select("doc_id", "toxic")
    held = toxicity.op4_weak_supervision_toxicity(spark, sf).filter("held_out").join(labels, "doc_id")
    got = {r.toxic: (r.n, r.flagged) for r in held.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("predicted").alias("flagged")).collect()}
    assert got[1][1] >= 0.9 * got[1][0] and got[0][1] <= 0.01 * got[0][0], got


def test_votes_are_plain_counts():
    import pyarrow as pa

    from cardmill.llm.words import Words

    s, texts = toxicity.Supervision(), ["Nasty, nastiest (nasty) folk!", "", "other nas words nastyish", None]
    (key,) = toxicity.features(Words(pa.array(["nasty"], pa.string()), lower=True), s).__next__()[1:]
    begin = [h for _, h in toxicity.features(Words(pa.array(["nastyx"], pa.string()), lower=True), s)][2]
    voters = np.sort(np.concatenate((key, begin)))
    counts, hits = toxicity.vote_counts(Words(pa.array(texts, pa.string()), lower=True), voters, s)
    whole, start = np.searchsorted(voters, key[0]), np.searchsorted(voters, begin[0])
    assert counts[:, whole].tolist() == [2, 0, 0, 0] and counts[:, start].tolist() == [0, 0, 1, 0] and hits.tolist() == [2, 0, 1, 0]


def test_toxicity_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "bad words here")] * 50 + [(1, "a text")] + [(i, "plain text") for i in range(2, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 30)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert len(toxicity.scores(docs, model).collect()) == 79


# 5. licenses


def test_licenses(spark, hard, empty):
    filler = words(50, 300)
    t = licenses.TEMPLATES
    rows = [(i, " ".join(filler[: i * 7] + [t[n]] + filler[i * 7 :])) for i, n in enumerate(sorted(t))]
    edited = t["MIT-permission"].replace("obtaining", "getting").replace("Permission", "permission")
    rows += [(100, " ".join(filler)), (101, f"// {edited.upper()}"), (102, "Released under the MIT"), (103, None), (104, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.defaultdict(dict)
    for r in licenses.scan(df).collect():
        got[r.doc_id][r.license] = r.containment
    for i, n in enumerate(sorted(t)):
        assert got[i][n] == 1.0
    assert 100 not in got and 103 not in got and 0.8 <= got[101]["MIT-permission"] < 1
    assert licenses.scan(hard).collect() == [] and licenses.scan(empty).collect() == []


def plain_matches(text, templates, s):
    """The best share of each template in any of its windows of the text, for words of letters."""
    import re

    clean = lambda x: [w for w in (re.sub(r"^[^a-z]+|[^a-z]+$", "", w) for w in x.lower().split()) if w]
    grams = lambda w: {tuple(w[i : i + s.shingle]) for i in range(len(w) - s.shingle + 1)}
    out, own = {}, clean(text)
    for name, t in templates.items():
        t = clean(t)
        stride = max(1, int(len(t) * s.slack))
        shares = [len(grams(own[a : a + len(t) + stride]) & grams(t)) / len(grams(t)) for a in range(0, max(len(own), 1), stride)]
        if max(shares) >= s.containment:
            out[name] = round(max(shares), 9)
    return out


def test_licenses_are_those_of_all_windows(spark):
    import re

    r = random.Random(12)
    s, t = licenses.Scan(), {n: re.sub(r"[^A-Za-z ]", "", x) for n, x in licenses.TEMPLATES.items()}
    t = {n: x for n, x in t.items() if len(x.split()) >= 8}
    rows = []
    for i in range(120):
        w = r.choice(list(t.values())).split()
        for _ in range(r.randint(0, len(w) // 12)):  # edits around the threshold
            k = r.randrange(len(w))
            w[k : k + 1] = r.choice(([], ["edited"], [w[k], "added"]))
        a, b = r.randint(0, 60), r.randint(0, 60)
        rows.append((i, " ".join([*words(i, a), *w, *words(500 + i, b), *(r.choice(list(t.values())).split()[:20])])))
    got = collections.defaultdict(dict)
    for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), t).collect():
        got[x.doc_id][x.license] = round(x.containment, 9)
    want = {i: plain_matches(x, t, s) for i, x in rows}
    assert sum(map(len, want.values())) > 100 and any(v < 1 for m in want.values() for v in m.values())
    assert dict(got) == {i: m for i, m in want.items() if m}


@pytest.mark.parametrize("similarity", [0.3, 0.5, 0.8])
def test_bands_guarantee(similarity):
    b = licenses.bands_for(similarity, 2, 1e-4)
    assert (1 - similarity**2) ** b <= 1e-4 < (1 - similarity**2) ** (b - 1)


# 6. archives


def test_warc(spark, small, tmp_path):
    pages = [(1, "http://b.example.org/x", "same"), (2, "http://a.example.org/", "same"), (3, None, None), (4, "https://www.a.example.org:443/p?q#f", ""), (5, "u\r\nWARC/1.1", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n"), (6, "http://b.example.org/x", "é😀" * 5000), (None, "http://n", "alone"), (7, "http://b.example.org/x", "same")]
    for rows in (pages, [], None):
        df = spark.read.parquet(f"{small}/pages.parquet") if rows is None else spark.createDataFrame(rows, "page_id long, url string, html string")
        path = str(tmp_path / f"w{0 if rows is None else len(rows) + 1}")
        warc.write_archives(df, path, per_file=3 if rows is not None else 4096)
        got = [] if rows == [] else warc.merge_index(warc.read_index(spark, path)).collect()
        data = [(r.page_id, r.html or "") for r in df.collect()]
        groups = collections.defaultdict(list)
        for i, h in data:
            groups[h].append(i)
        want = []
        for i, h in data:
            m = max((x for x in groups[h] if x is not None), default=None)
            d = h.encode()
            want.append((i, len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(), "response" if i == m else "revisit", None if i == m else m))
        assert sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got))) == sorted(map(repr, want))
        order = [(r.url_key, r.captured, r.page_id or 0) for r in got]
        assert order == sorted(order)
    assert warc.url_key("https://User@WWW.A.example.org:443/P?q#f") == "org,example,a)/p?q"


def test_loser_tree():
    r = random.Random(4)
    for k in range(12):
        runs = [sorted(r.randint(0, 50) for _ in range(r.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree([[(x,) for x in run] for run in runs], key=lambda t: t)) == [(x,) for x in sorted(sum(runs, []))]


# 7. sampled segmentation


def test_segmentation_is_lossless_and_reproducible(spark, hard, empty):
    s = lattice.Sampling()
    once = lattice.encode(hard, s)
    back = sorted(lattice.decode(once, s).collect(), key=repr)
    assert [(r.doc_id, r.text) for r in back] == sorted(((i, t or "") for i, t in pairs(hard)), key=lambda x: repr((x[0], x[1]))) or sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in pairs(hard))
    again = lattice.encode(hard.repartition(1).orderBy("n_chars"), s)
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in once.collect()) == sorted((str(r.doc_id), tuple(r.ids)) for r in again.collect())
    other = lattice.encode(hard.filter("doc_id = 1"), lattice.Sampling(seed=99)).first()
    assert other.ids != once.filter("doc_id = 1").first().ids
    assert lattice.encode(empty, s).collect() == []


def test_segmentation_follows_the_lattice():
    v = lattice.vocabulary("", 2.0)
    text, n = " token", 20_000
    ids, at = lattice.encode_block(v, lattice.Sampling(), np.frombuffer((text * n).encode(), np.uint8), np.arange(n + 1) * len(text), np.arange(n))
    got = collections.Counter(tuple(ids[at[i] : at[i + 1]].tolist()) for i in range(n))
    piece = {v.bytes[v.at[i] : v.at[i] + v.lens[i]].tobytes(): i for i in range(259, len(v.lens))}
    paths = {}

    def walk(p, acc, w):
        if p == len(text):
            paths[tuple(acc)] = math.exp(w)
        for k in range(1, len(text) - p + 1):
            if (b := text[p : p + k].encode()) in piece:
                walk(p + k, [*acc, piece[b]], w + v.weight[piece[b]])

    walk(0, [], 0.0)
    total = sum(paths.values())
    assert set(got) <= set(paths) and max(abs(got[k] / n - x / total) for k, x in paths.items()) < 0.015


# 8. n-gram Jaccard join


def plain_classes(rows, k, percent):
    sets = []
    for _, t in rows:
        w = split(t)
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(sets[i]), str(least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard_classes(spark, small, hard, empty, k, percent):
    join = ngram_join.Join(words=k, percent=percent)
    for df in (hard, spark.read.parquet(f"{small}/documents.parquet")):
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.jaccard_classes(df, join).collect())
        assert got == plain_classes(pairs(df), k, percent)
    assert ngram_join.jaccard_classes(empty, join).collect() == []


def test_jaccard_of_many_near_copies(spark):
    """Copies around the threshold, whose words are common, in blocks much smaller than their cluster."""
    r = random.Random(8)
    base = words(77, 60)
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(60)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    join = ngram_join.Join(rows=20, common=200)
    got = sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in ngram_join.jaccard_classes(df, join).collect())
    assert got == plain_classes(rows, 4, 85)


def test_phrases_shared_by_short_texts_make_no_cluster(spark):
    """Signatures that unrelated short texts share chain only those whose parities allow a link; one of many rows stays chained."""
    r, join = random.Random(5), ngram_join.Join(words=1, percent=80)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(40)) for _ in range(30)]
    texts += [x.replace(" ", " one ", 1) for x in texts[:10]]
    sets = ngram_join.Sets(pa.array(texts), join.words)
    order = np.lexsort((sets.node, sets.n))
    node, n, odd = sets.node[order], sets.n[order], sets.parities(join.parity).view(np.int64)[order]
    one = np.zeros(len(node), np.int64)
    found = {frozenset((int(node[a]), int(node[b]))) for x in ngram_join.related(one, node, n, odd, join) for a, b in zip(*x, strict=True)}
    assert {frozenset((int(sets.node[i]), int(sets.node[30 + i]))) for i in range(10)} <= found and len(found) < 15
    for own, torn in ((ngram_join.Join(words=1, percent=80, apart=20), None), (join, 0)):
        assert sum(len(x) for x, _ in ngram_join.related(one, node, n, odd, own, torn)) == len(node) - 1


@pytest.mark.parametrize("most", [1 << 6, 1 << 26])
def test_texts_without_a_cluster_stay_where_they_lie(spark, tmp_path, most):
    text = spark.range(20_000).select(F.xxhash64("id").alias("row"), F.col("id").cast("string").alias("text"))
    text.filter("text % 100 = 7").select("row").write.parquet(str(tmp_path / "wanted"))
    few = ngram_join._few(text, spark.read.parquet(str(tmp_path / "wanted")), most)
    got = {int(r.text) for r in few.collect()}
    assert few.columns == ["row", "text"] and {x for x in range(20_000) if x % 100 == 7} <= got
    assert most == 1 << 6 or len(got) < 700
    assert "Exchange hashpartitioning(row" not in few._jdf.queryExecution().executedPlan().toString()


def test_chains_of_small_chunks_lose_no_pair(spark):
    r, base, rows = random.Random(9), words(78, 50), []
    for i in range(120):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(50)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    join = ngram_join.Join(rows=15, apart=4, moved=1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole = ngram_join._chains
    try:
        ngram_join._chains = lambda j: whole(j, 7)
        got = sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in ngram_join.jaccard_classes(df, join).collect())
    finally:
        ngram_join._chains = whole
    assert got == plain_classes(rows, 4, 85)


def test_one_of_each(spark, hard):
    kept = ngram_join.one_of_each(hard)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.schema == hard.schema and ids.count(1) == 1 and 2 not in ids and 3 not in ids and {4, 5, 6, 10, 12, 13} <= set(ids)


def test_one_of_each_without_ids(spark, tmp_path):
    base, other = words(21, 300), words(22, 300)
    near = lambda x, i: " ".join([*x[:i], f"new{i}", *x[i + 1 :]])
    rows = [(None, near(base, i)) for i in range(10, 20)] + [(None, near(other, i)) for i in range(10, 20)]
    rows += [(5, near(other, 30)), (None, ""), (None, ""), (6, ""), (7, " ".join(words(23, 50))), (7, near(other, 40))]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    kept = pairs(ngram_join.one_of_each(spark.read.parquet(path)))
    assert sorted(str(i) for i, _ in kept) == ["5", "6", "7", "None", "None"]
    assert sorted(t for i, t in kept if i is None)[0] == "" and (7, " ".join(words(23, 50))) in kept


def test_components(spark):
    r = random.Random(6)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(3000 - i, 2000 + i) for i in range(40)] + [(9000, i) for i in range(8000, 8050)]
    a, b = np.array([e[0] for e in edges]), np.array([e[1] for e in edges])
    nodes, label = components.local_components(a, b)
    local = dict(zip(nodes.tolist(), label.tolist(), strict=True))
    got = {x.node: x.label for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: v for n, v in local.items() if n in got} and all(local[x] == local[y] for x, y in edges) and local[1060] == 1000
    assert {n for e in edges if e[0] != e[1] for n in e} == set(got)
    assert components.connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


# 9. quality rules


def plain_counts(t):
    w = split(t, False)
    seen, dup = set(), 0
    for line in (t or "").encode().split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = [False] * len(w)
    for i in range(len(w) - 4):
        if c[tuple(w[i : i + 5])] > 1:
            cover[i : i + 5] = [True] * 5
    return len(w), sum(len(x.decode()) for x in w), sum((t or "").count(x) for x in "#*$%&|<>"), dup, sum(cover)


def test_quality_rules(spark, small, hard, empty):
    for df in (hard, spark.read.parquet(f"{small}/documents.parquet")):
        got = quality.quality_rules(df).collect()
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted((str(i), *plain_counts(t)) for i, t in pairs(df))
        for r in got:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
        kept = quality.keep_documents(df)
        assert kept.schema == df.schema and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert quality.quality_rules(empty).collect() == []


def test_quality_verdict(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    j = quality.quality_rules(df).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("NOT base_failed AND n_words >= 60")
    r = j.agg(F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))).alias("good"), F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("junk")).first()
    assert r.good > 0.99 and r.junk < 0.3


def test_small_languages_are_kept(spark, tmp_path):
    r = random.Random(9)
    cyrillic = ["".join(r.choice("абвгдежзийклмн") for _ in range(r.randint(2, 8))) for _ in range(80)]
    prose = lambda v, n: " ".join(r.choices(v, range(len(v), 0, -1), k=n)) + "."
    rows = [(i, prose(words(10, 80), 300), "en") for i in range(700)]
    rows += [(i, prose(cyrillic, 100), "ru") for i in range(1000, 1020)]  # 1 % of the words would be 2100
    rows += [(2000, prose(cyrillic[::-1], 100), "uk"), (2001, prose(cyrillic, 100), "en"), (2002, "{} = 7; " * 80, "en")]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(path)
    df = spark.read.parquet(path)
    assert set(quality.references(df)) == {"en", "ru"}
    kept = {x.doc_id for x in quality.quality_rules(df).filter("kept").collect()}
    assert {*range(1000, 1020), 2000, 2001} <= kept and 2002 not in kept
    assert {x.doc_id for x in quality.keep_documents(df).collect()} == kept


def plain_js(p, q):
    keys = {*p, *q}
    half = lambda a, b: sum(x * math.log2(x / ((x + b.get(k, 0)) / 2)) for k, x in a.items() if x)
    return math.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2)) if keys else 0.0


def plain_verdicts(rows, rules=quality.Rules()):
    """(id, distances, kept) of rows (id, text, lang), by counting words and characters one after the other."""
    marks = set(".,;:'\"-?()")

    def cls(c):
        if "a" <= c <= "z":
            return 0
        if "A" <= c <= "Z":
            return 1
        if "0" <= c <= "9":
            return 2
        if c in "\t\x0b\x0c\r ":
            return 3
        if c == "\n":
            return 4
        return 5 if c in marks else 6 if ord(c) < 128 else 7 if ord(c) < 0x800 else 8

    share = lambda c: {k: v / max(sum(c.values()), 1) for k, v in c.items()}
    words_of, chars_of = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, t, lang in rows:
        if lang is not None:
            words_of[lang].update(split(t))
            chars_of[lang].update(map(cls, t or ""))
    refs = {}
    for lang, c in words_of.items():
        n = sum(c.values())
        if n >= rules.lang_words:
            top = {w for w, k in sorted(c.items(), key=lambda x: -x[1])[: rules.common] if k * rules.share >= n}
            refs[lang] = top, share(chars_of[lang]), share(collections.Counter({**{w: c[w] for w in top}, None: n - sum(c[w] for w in top)}))
    out = []
    for i, t, lang in rows:
        n, _, _, _, repeats = plain_counts(t)
        near = [(plain_js(share(collections.Counter(map(cls, t or ""))), rc), plain_js(share(collections.Counter(w if w in top else None for w in split(t))), rw)) for top, rc, rw in refs.values()]
        a, b = min(near, key=sum, default=(0.0, 0.0))
        failed = n < rules.least_words or 100 * repeats > rules.most_repeat_percent * n
        far = a > rules.max_char_js or b > rules.max_word_js or a + b > rules.max_sum_js
        out.append((str(i), round(a, 6), round(b, 6), not failed and (lang not in refs and lang is not None or n < rules.min_words or not far)))
    return sorted(out)


@pytest.mark.parametrize("partitions", [1, 7])
def test_distances_are_those_of_plain_counts(spark, tmp_path, partitions):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    # words of one frequency would leave the choice of common words open
    extra = spark.createDataFrame([(-1, None, "en"), (-2, "", None), (-3, "чужие слова " * 50, "ru"), (-4, "no language here " * 9, None)], docs.schema)
    path = str(tmp_path / "d")
    docs.unionByName(extra).repartition(partitions).write.parquet(path)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.unionByName(extra).collect()]
    rules = quality.Rules(common=12)
    got = sorted((str(r.doc_id), round(r.char_js, 6), round(r.word_js, 6), r.kept) for r in quality.quality_rules(spark.read.parquet(path), rules).collect())
    assert got == plain_verdicts(rows, rules)


# 10. nearest neighbours


def plain_nearest(base, k):
    ok = [(i, np.array(v, float)) for i, v in base if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            out[q] = sorted(((-float((x * y).sum()), i) for i, y in ok if i != q and len(y) == len(x)))[:k]
    return out


def test_nearest(spark, small):
    rng = np.random.default_rng(3)
    base = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * (1 + i % 3)]) for i in range(300)]
    base += [(i, base[0][1]) for i in range(300, 360)] + [(400, None), (420, [0.0] * 8), (440, [1.0] * 7 + [None]), (460, [float("nan")] * 8), (480, [1.0, 2.0]), (481, [2.0, 1.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(base, "vec_id long, embedding array<float>").repartition(3)
    got = collections.defaultdict(list)
    for r in ann.search(df.filter("vec_id % 20 = 0"), df).collect():
        got[r.query_id].append((r.rank, -r.score, r.vec_id))
    want, hits, total = plain_nearest(base, 20), 0, 0
    assert set(got) == {q for q, w in want.items() if w}
    for q, w in want.items():
        mine = [(s, i) for _, s, i in sorted(got[q])]
        assert [r for r, _, _ in sorted(got[q])] == list(range(1, len(w) + 1)) and mine == sorted(mine)
        hits += len({i for _, i in mine} & {i for _, i in w})
        total += len(w)
    assert hits >= 0.9 * total
    assert [i for _, i in want[480]] == [i for _, _, i in sorted(got[480])] == [481]
    assert ann.search(df.limit(0), df.limit(0)).collect() == []


def test_recall_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = plain_nearest([(r.vec_id, r.embedding) for r in df.collect()], 20)
    got = collections.defaultdict(set)
    for r in ann.search(df.filter("vec_id % 20 = 0"), df).collect():
        got[r.query_id].add(r.vec_id)
    assert np.mean([len(got[q] & {i for _, i in w}) / len(w) for q, w in want.items()]) >= 0.9


def test_probes(spark):
    order = ann.probe_order(8, 200)
    assert order.shape == (200, 16) and len({tuple(x) for x in order.tolist()}) == 200 and not order[0].any()
    assert not (order[:, :8] & order[:, :7:-1]).any()  # never both ways along one projection
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(100, 64))
    groups = np.repeat(centre, 30, 0) + 0.35 * rng.normal(size=(3000, 64))  # with neighbours to find, a small share is enough
    given = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()], float)
    for x, most in ((given, 0.9), (groups / np.sqrt((groups * groups).sum(1))[:, None], 0.5)):
        s = x[::20] @ x.T
        s[np.arange(len(s)), np.arange(0, len(x), 20)] = -9
        top = np.argsort(-s, 1)[:, :20]
        index = ann.Index(hashes=ann.hashes_for(len(x)))
        n = ann.fitted_probes(index, {64: float(np.sqrt((x * x).sum(1)).max())}, [(q, v) for q in range(0, 50) for v in top[q].tolist()], dict(enumerate(x[::20].tolist())), dict(enumerate(x.tolist())))
        share, work = ann.visited(x[::20], x, ann.Index(hashes=index.hashes, probes=n))
        print(f"{n} probes visit {share:.3f}, products {work:.3f} of all, 20th neighbour at {np.median(np.sort(s, 1)[:, -20]):.2f}")
        assert share < most


def test_nearest_of_repeated_ids(spark):
    rng = np.random.default_rng(5)
    base = [(i % 100, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(200)]
    base = base * 2 + [(50, [9.0 + k / 1000] * 8) for k in range(500)]  # copies, other vectors of an id, and one id with most rows
    best = collections.defaultdict(lambda: -math.inf)
    for q, x in base:
        if q % 20 == 0:
            for i, y in base:
                if i != q:
                    best[q, i] = max(best[q, i], float(np.dot(x, y)))
    df = spark.createDataFrame(base, "vec_id long, embedding array<float>").repartition(3)
    index = ann.Index(k=100)  # of 99 candidates, so each query is compared with all blocks
    got = collections.defaultdict(list)
    for r in ann.search(df.filter("vec_id % 20 = 0"), df, index).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q in (0, 20, 40, 60, 80):
        want = sorted((-s, i) for (a, i), s in best.items() if a == q)
        assert [i for _, i, _ in sorted(got[q])] == [i for _, i in want]
        assert np.allclose([s for _, _, s in sorted(got[q])], [-s for s, _ in want], rtol=1e-5)


# the pipeline


def test_pipeline_of_hard_and_empty_tables(spark, hard, empty, tmp_path):
    import corpus_pipeline as p

    labels = spark.createDataFrame([(1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for name, docs in (("hard", hard), ("empty", empty)):
        path = str(tmp_path / name)
        docs.withColumn("__rid", F.lit(1)).withColumn("__row", F.lit("x")).write.parquet(f"{path}/documents.parquet")
        labels.write.parquet(f"{path}/labels.parquet")
        out = p.run(spark, path)
        assert out.columns[0] == "doc_id" and (out.count() > 0) == (name == "hard")


def test_pipeline(spark, small):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    n = docs.count()
    for name, stage in p.STAGES:
        docs = p.written(stage(spark, docs, small), name)
        if name != p.STAGES[-1][0]:
            assert docs.columns == names and docs.count() <= n
            n = docs.count()
    assert docs.agg(F.count_distinct("doc_id")).first()[0] == n and len(p.STAGES) == 5
