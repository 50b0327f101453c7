"""Toxicity by weak supervision.

1. Voters. From a bounded sample of labelled training rows: words (a lexicon) and beginnings of words of 4 to 9
   bytes (patterns) that are far more frequent in texts labelled toxic. Each votes where a text
   has it. The label of a sampled row is one more voter, with an accuracy to be estimated like the others'.
2. Label model. A two-class generative model of the votes, fitted by expectation maximisation. Its correlations are factors of
   pairs: within the classes voters form a forest (the spanning forest of what they tell of each other beyond the cost of two more
   parameters), and a voter's rates are given for either vote of its parent, so voters that repeat each other add
   nothing twice. The annotator depends on the class alone. The posterior is the training label.
3. Classifier. Logistic regression on how often each voter occurs in a text and on the share of its words that do,
   fitted to the posteriors. It scores all rows in one pass.

Inputs of a score are the text's words alone. `sample` bounds what is gathered (rows by the order of a hash of their id);
everything else covers all rows. With no usable label every score is `prior`.

Nulls: a null text is empty and scored like one; a null doc_id is a training row that no label can
belong to. Labels that are null, or contradict each other for one doc_id, aren't used; of texts with one doc_id the least is learnt from.
Repeated rows get equal scores; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import arrow_limits, documents, written
from .words import U, Words, chunks, column, mix, signed


@dataclass(frozen=True)
class Supervision:
    sample: int = 20_000
    voters: int = 400
    least_texts: int = 3
    lift: float = 6.0
    prefixes: tuple[int, ...] = (4, 5, 6, 7, 8, 9)
    rounds: int = 30
    ridge: float = 0.02
    prior: float = 0.05


def trimmed(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words without ASCII marks and digits at either end."""
    letter = np.ones(256, bool)
    letter[:128] = False
    letter[97:123] = letter[65:91] = True
    starts, ends = w.starts.copy(), w.ends.copy()
    ok = letter[w.data]
    while len(more := np.flatnonzero((starts < ends) & ~ok[np.minimum(starts, len(ok) - 1)])) if len(ok) else False:
        starts[more] += 1
    while len(more := np.flatnonzero((starts < ends) & ~ok[np.maximum(ends - 1, 0)])) if len(ok) else False:
        ends[more] -= 1
    return starts, ends


def features(w: Words, s: Supervision) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, hashes) of the whole words, then of their beginnings of each length."""
    starts, ends = trimmed(w)
    full = np.flatnonzero(ends > starts)
    yield full, w.span_hash(starts[full], ends[full])
    for k in s.prefixes:
        long = np.flatnonzero(ends - starts > k)
        yield long, mix(w.span_hash(starts[long], starts[long] + k) + U(k))


def _feature_counts(s: Supervision):
    """Per task: in how many toxic and other texts each feature occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, toxic = [], []
        for b in batches:
            for c in chunks(b):
                w = Words(column(c, "text"), lower=True)
                doc, label = w.doc(), np.array(column(c, "toxic"))
                for word, h in features(w, s):
                    pair = np.unique(np.stack((h, doc[word].astype(U))), axis=1)
                    keys.append(pair[0])
                    toxic.append(label[pair[1].astype(np.int64)])
        if not keys:
            return
        k, at = np.unique(np.concatenate(keys), return_inverse=True)
        t = np.bincount(at, np.concatenate(toxic))
        n = np.bincount(at) - t
        for a in range(0, len(k), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(signed(k[a : a + 100_000])), pa.array(t[a : a + 100_000].astype(np.int64)), pa.array(n[a : a + 100_000].astype(np.int64))], ["feature", "t", "n"])

    return run


def vote_counts(w: Words, voters: np.ndarray, s: Supervision) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of each voter in each text, and of how many words of a text some voter is part."""
    doc, m = w.doc(), len(voters)
    out = np.zeros(w.rows * m)
    hit = np.zeros(len(doc), bool)
    for word, h in features(w, s):
        at = np.minimum(np.searchsorted(voters, h), m - 1)
        own = voters[at] == h
        out += np.bincount(doc[word[own]] * m + at[own], minlength=len(out))
        hit[word[own]] = True
    return out.reshape(w.rows, m), np.bincount(doc[hit], minlength=w.rows)


_LN = np.log1p(np.arange(1 << 16))


def _runs(n: int) -> Iterator[slice]:
    """Runs of rows: what the driver makes of the sample beside its counts and votes is as large as a run."""
    return (slice(a, a + 1024) for a in range(0, n, 1024))


def _sums(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """q @ x, run by run."""
    return sum((q[i] @ x[i] for i in _runs(len(q))), np.zeros(x.shape[1]))


def _design(counts: np.ndarray, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    share = hits / np.maximum(words, 1)
    return np.column_stack((_LN[counts] if counts.dtype == np.uint16 else np.log1p(counts), np.log1p(hits), np.minimum(20 * share, 3), np.minimum(hits, 3), hits > 0))


def dependence(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """For each pair of voters, the likelihood (ln) that joint rates within the classes gain over independent ones; 0 where it doesn't pay
    for a parameter more in each class."""
    gain = np.zeros((x.shape[1], x.shape[1]))
    for q in (1 - p, p):
        n, one = q.sum(), _sums(x, q)
        both = sum(((x[i] * q[i, None]).T @ x[i].astype(float) for i in _runs(len(p))), np.zeros(gain.shape))
        for own, other, joint in ((one, one, both), (one, n - one, one[:, None] - both), (n - one, one, one[None, :] - both), (n - one, n - one, n - one[:, None] - one[None, :] + both)):
            joint = np.maximum(joint, 0)
            expected = np.maximum(np.outer(own, other) / max(n, 1e-9), 1e-12)
            gain += joint * np.log(np.maximum(joint, 1e-12) / expected)
    gain = (gain + gain.T) / 2
    np.fill_diagonal(gain, 0)
    return np.where(gain > np.log(max(len(p), 2)), gain, 0)


def forest(gain: np.ndarray) -> np.ndarray:
    """Parents of the maximum spanning forest, -1 for roots; pairs without gain aren't edges."""
    m = len(gain)
    parent, done, best, link = np.full(m, -1), np.zeros(m, bool), np.zeros(m), np.full(m, -1)
    for _ in range(m):
        at = int(np.where(done, -1, best).argmax())
        parent[at], done[at] = link[at], True
        nearer = ~done & (gain[at] > best)
        best[nearer], link[nearer] = gain[at][nearer], at
    return parent


def label_model(votes: np.ndarray, label: np.ndarray, s: Supervision) -> tuple[np.ndarray, dict]:
    """Posteriors of the rows, and what was estimated: prior, rates (class, voter), parents of voters (-1: none), and given (class, vote
    of the parent, voter), the rates under either vote of the parent. The annotator is the last voter.

    votes: rows by voters, 0 or 1. label: 0 or 1, the annotator's vote.
    """
    x = np.column_stack((votes, label)).astype(np.uint8)
    p = np.where(label == 1, 0.95, np.minimum(0.02 + 0.1 * votes.sum(1), 0.3))
    parents = prior = rates = given = None

    def with_parents() -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for i in _runs(len(p)):
            yield i, x[i].astype(float), np.where(parents >= 0, x[i][:, parents], 0.0)

    for r in range(s.rounds):
        if r % 5 == 0:
            parents = np.append(forest(dependence(x[:, :-1], p)), -1)
        prior = (p.sum() + 1) / (len(p) + 2)
        rates = np.stack([(_sums(x, q) + 0.5) / (q.sum() + 1) for q in (1 - p, p)])
        both, of_parent = np.zeros((2, 2, 2, x.shape[1]))
        for i, own, above in with_parents():
            for k, q in enumerate((1 - p[i], p[i])):
                for vote, a in enumerate((1 - above, above)):
                    both[k, vote] += q @ (own * a)
                    of_parent[k, vote] += q @ a
        # a parent's rare vote says little, so its rates lean on those of the class by one row's weight
        given = np.clip((both + rates[:, None]) / (of_parent + 1), 1e-5, 1 - 1e-5)
        yes, no = np.log(given[1] / given[0]), np.log((1 - given[1]) / (1 - given[0]))
        logit = np.full(len(p), np.log(prior / (1 - prior)) + no[0].sum())
        for i, own, above in with_parents():
            logit[i] += above @ (no[1] - no[0]) + own @ (yes[0] - no[0]) + (own * above) @ (yes[1] - no[1] - yes[0] + no[0])
        after = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        if np.abs(after - p).max(initial=0) < 1e-4:
            p = after
            break
        p = after
    return p, {"prior": prior, "rates": rates, "parents": parents, "given": given}


def fit(x: Callable[[slice], np.ndarray], p: np.ndarray, s: Supervision) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, intercept and scales of a ridge logistic regression on soft labels, by Newton steps. x: makes the features of a run of rows."""
    squares = sum((x(i) ** 2).sum(0) for i in _runs(len(p)))
    scale = np.maximum(np.sqrt(squares / len(p)), 1e-6)
    ridge = np.append(np.full(len(scale), s.ridge * len(p) / 100), 1e-6)
    beta = np.zeros(len(ridge))

    def scaled() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in _runs(len(p)):
            f = x(i)
            yield np.column_stack((f / scale, np.ones(len(f)))), p[i]

    def loss(b: np.ndarray) -> float:
        total = 0.0
        for z, y in scaled():
            f = z @ b
            total += float((np.logaddexp(0, f) - y * f).sum())
        return total + 0.5 * float((ridge * b * b).sum())

    now = loss(beta)
    for _ in range(50):
        grad, bend = ridge * beta, np.diag(ridge + 1e-9)
        for z, y in scaled():
            q = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
            grad += z.T @ (q - y)
            bend += (z * (q * (1 - q))[:, None]).T @ z
        step = np.linalg.solve(bend, grad)
        size = 1.0
        while (after := loss(beta - size * step)) > now and size > 1e-4:
            size /= 2
        beta = beta - size * step
        if now - after < 1e-7 * max(now, 1):
            break
        now = after
    return beta[:-1], float(beta[-1]), scale


@dataclass
class Classifier:
    voters: np.ndarray
    beta: np.ndarray
    intercept: float
    scale: np.ndarray
    labels: dict

    def score(self, arr: pa.Array, s: Supervision) -> np.ndarray:
        w = Words(arr, lower=True)
        if not len(self.voters):
            return np.full(w.rows, 1 / (1 + np.exp(-self.intercept)))
        counts, hits = vote_counts(w, self.voters, s)
        f = _design(counts, hits, w.n) / self.scale @ self.beta + self.intercept
        return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, s: Supervision = Supervision()) -> Classifier:
    """labels: doc_id and toxic, training rows only."""
    spark = docs.sparkSession
    arrow_limits(spark)
    usable = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").select("doc_id", "toxic")
    some = written(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample), "labelled")
    # of rows with one id the least text counts, so the sample bounds the texts too
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").cast("int").alias("toxic"))
    rows = written(rows.select("text", "toxic"), "sample")
    total = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    t_all, n_all = total.get(1, 0), total.get(0, 0)
    none = Classifier(np.zeros(0, np.uint64), np.zeros(0), float(np.log(s.prior / (1 - s.prior))), np.zeros(0), {})
    if not t_all or not n_all:
        return none
    found = rows.mapInArrow(_feature_counts(s), "feature long, t long, n long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    share = (F.col("t") / t_all) / ((F.col("n") + 0.5) / n_all)
    expected = (F.col("t") + F.col("n")) * (t_all / (t_all + n_all))
    z = (F.col("t") - expected) / F.sqrt(expected)
    best = found.filter((F.col("t") >= s.least_texts) & (share >= s.lift)).orderBy(F.desc(z), "feature").limit(s.voters).select("feature").collect()  # s.voters rows
    if not best:
        return none
    voters = np.sort(np.array([r.feature for r in best], np.int64).view(np.uint64))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                w = Words(column(c, "text"), lower=True)
                counts, hits = vote_counts(w, voters, s)
                yield pa.RecordBatch.from_arrays([column(c, "toxic"), pa.array(w.n), pa.array(hits), pa.array([x.astype(np.uint16).tobytes() for x in np.minimum(counts, 65535)], pa.binary())], ["toxic", "words", "hits", "counts"])

    table = rows.mapInArrow(votes, "toxic int, words long, hits long, counts binary").toArrow()  # s.sample rows of s.voters counts
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint16).reshape(-1, len(voters))
    label, words, hits = (table.column(c).to_numpy() for c in ("toxic", "words", "hits"))
    # an order of the rows that doesn't depend on how they came
    order = np.lexsort((*counts.T[:8], words, hits, label))
    counts, label, words, hits = counts[order], label[order], words[order], hits[order]
    p, estimated = label_model((counts > 0).astype(np.uint8), label, s)
    beta, intercept, scale = fit(lambda i: _design(counts[i], hits[i], words[i]), p, s)
    return Classifier(voters, beta, intercept, scale, estimated)


def is_training(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text isn't 0 modulo 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 != 0


def scores(docs: DataFrame, model: Classifier, s: Supervision = Supervision()) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                yield pa.RecordBatch.from_arrays([column(c, "doc_id").cast(pa.int64()), pa.array(model.score(column(c, "text"), s))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def clean_documents(docs: DataFrame, labels: DataFrame, s: Supervision = Supervision(), most: float = 0.5) -> DataFrame:
    """The rows of docs that score under `most`, with all their columns."""
    model = train(docs, labels.filter(is_training(F.col("doc_id"))), s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                yield c.filter(pa.array(model.score(column(c, "text"), s) < most))

    return docs.mapInArrow(run, docs.schema)


def op4_weak_supervision_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    model = train(docs, labels.filter(is_training(F.col("doc_id"))))
    out = scores(docs, model)
    return out.select("doc_id", (~is_training(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
