"""Quality rules: counted rules, then distribution divergence from language references.

Two histograms are taken of each text: its bytes' and code points' character classes,
and which of a language's commonest words its words are (all others in one bin). Each is
compared by Jensen-Shannon distance (base 2, 0 to 1) with the references of every
language, and the smallest sum of both weighs. References are counted from all texts:
for each value of `lang` with at least `lang_words` words, whatever its share, its `common`
commonest words and both histograms. A text is compared with each of them, so a reference of about
1 KB for each language reaches all tasks. A text whose own language has no reference isn't
rejected for its distances; one without a language is judged by all references.

Texts under `min_words` words have too little mass for a histogram to mean anything:
the guards keep them unless a counted rule rejects them.

Nulls: a null text is empty (no words, base_failed); a null lang builds no reference.
Repeated rows are judged alike; an empty table gives an empty result; extra columns are
left out by `quality_rules` and kept by `keep_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import arrow_limits, documents, dropped, written
from .words import U, Words, chunks, column, mix, per_row

# Character classes of bytes: lower and upper case letters, digits, space, line break,
# marks of prose, other marks, and by lead byte the code points beyond ASCII.
PROSE_MARKS = b".,;:'\"-?()"
CLASSES = 10
_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4
_CLASS[list(PROSE_MARKS)] = 5
_CLASS[0xC2:0xE0] = 7  # Latin with marks, Greek, Cyrillic and others of two bytes
_CLASS[0xE0:0xF5] = 8
_CLASS[0x80:0xC0] = 255  # later bytes of a code point
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True  # fixed values of the contract
_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, char_js double, word_js double, judged boolean"


@dataclass(frozen=True)
class Rules:
    least_words: int = 10
    most_repeat_percent: int = 20
    window: int = 5
    min_words: int = 60
    common: int = 40
    share: int = 5000  # a common word holds 1/share of its language's words at least
    lang_words: int = 1000
    max_char_js: float = 0.28
    max_word_js: float = 0.5
    max_sum_js: float = 0.6


def _duplicates(key: np.ndarray) -> np.ndarray:
    """For each value: the size of its class."""
    if not len(key):
        return np.zeros(0, np.int64)
    order = np.argsort(key, kind="stable")
    k = key[order]
    begin = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    n = np.diff(np.concatenate((begin, [len(k)])))
    out = np.empty(len(k), np.int64)
    out[order] = np.repeat(n, n)
    return out


def counts(w: Words, window: int = 5) -> dict[str, np.ndarray]:
    """The base counts of each text of a chunk."""
    data, offs = w.data, w.offs
    lead = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, w.starts, 1)
    np.add.at(inside, w.ends, -1)
    inside = np.cumsum(inside[:-1]) > 0
    # lines
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    newline = np.flatnonzero(data == 10)
    row_of = np.repeat(np.arange(w.rows), np.diff(offs))
    starts = np.concatenate((offs[:-1][np.diff(offs) > 0], newline + 1))
    rows = np.concatenate((np.flatnonzero(np.diff(offs) > 0), row_of[newline]))
    ends = np.concatenate((newline, offs[1:][np.diff(offs) > 0]))
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    ends = np.sort(ends)
    worded = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, rows = starts[worded], ends[worded], rows[worded]
    dup_lines = np.zeros(w.rows, np.int64)
    many = np.bincount(rows, minlength=w.rows)[rows] > 1
    seen: set[tuple[int, bytes]] = set()  # lines are compared by their bytes
    for r, a, b in zip(rows[many].tolist(), starts[many].tolist(), ends[many].tolist(), strict=True):
        line = (r, data[a:b].tobytes())
        dup_lines[r] += line in seen
        seen.add(line)
    # windows of words found twice or more in one text
    at, doc = w.windows(window)
    h = w.seq_hash(at, at + window)
    twice = at[_duplicates(mix(h + doc.astype(U) * U(0x9E3779B97F4A7C15))) > 1]
    cover = np.zeros(len(w.starts) + 1, np.int32)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + window, -1)
    return {
        "n_words": w.n,
        "word_chars": per_row(lead & inside, offs),
        "n_symbols": per_row(_SYMBOL[data], offs),
        "n_dup_lines": dup_lines,
        "n_repeat_words": per_row(np.cumsum(cover[:-1]) > 0, w.first),
    }


def _char_histogram(w: Words) -> np.ndarray:
    """Code points of each class, by text."""
    cls = _CLASS[w.data]
    row = np.repeat(np.arange(w.rows), np.diff(w.offs))
    ok = cls < CLASSES
    return np.bincount(row[ok] * CLASSES + cls[ok], minlength=w.rows * CLASSES).reshape(w.rows, CLASSES).astype(float)


def _word_keys(arr: pa.Array) -> tuple[Words, np.ndarray]:
    """Lower-cased words."""
    w = Words(arr, lower=True)
    return w, w.hashes()


def _heavy_words(share: int, size: int = 1_000_000):
    """(lang, word hash, count, of) of words that hold 1/share of a language's words in a segment of `size` words, where `of` is
    the language's number of words there; and that number alone, with a null word.

    What holds such a share of the whole holds it in some segment, so the candidates are complete.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held, n = [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            lang, h = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((h, lang))
            lang, h = lang[order], h[order]
            new = np.flatnonzero(np.concatenate(([True], (lang[1:] != lang[:-1]) | (h[1:] != h[:-1]))))
            count, total = np.diff(np.append(new, len(h))), np.bincount(lang, minlength=len(names))
            own, word = lang[new], h[new].view(np.int64)
            top = count * share >= total[own]
            known = np.flatnonzero(total)
            values = pa.array(list(names), pa.string())
            out = pa.RecordBatch.from_arrays([
                pa.concat_arrays([values.take(pa.array(own[top])), values.take(pa.array(known))]), pa.concat_arrays([pa.array(word[top]), pa.nulls(len(known), pa.int64())]),
                pa.array(np.concatenate((count[top], total[known]))), pa.array(np.concatenate((total[own[top]], total[known]))),
            ], ["lang", "word", "n", "of"])
            for a in range(0, out.num_rows, 50_000):
                yield out.slice(a, 50_000)

        for batch in batches:
            for c in chunks(batch):
                w, h = _word_keys(column(c, "text"))
                langs = np.array([-1 if x is None else names.setdefault(x, len(names)) for x in column(c, "lang").to_pylist()], np.int64)
                of = np.repeat(langs, w.n)
                held.append((of[of >= 0], h[of >= 0]))
                n += len(held[-1][0])
                if n >= size:
                    yield from rows()
                    held, n = [], 0
        if n:
            yield from rows()

    return run


def _pairs(common: dict[str, np.ndarray]):
    """The histogram sums of each language, of all texts."""
    langs = sorted(common)
    place = {x: i for i, x in enumerate(langs)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars = np.zeros((len(langs), CLASSES))
        words = [np.zeros(len(common[x]) + 1) for x in langs]
        for batch in batches:
            for c in chunks(batch):
                w, h = _word_keys(column(c, "text"))
                # classes want the case that lower-casing takes
                by_row = _char_histogram(Words(column(c, "text")))
                given = column(c, "lang").to_pylist()
                for lang in {x for x in given if x in place}:
                    i = place[lang]
                    rows = np.array([x == lang for x in given])
                    chars[i] += by_row[rows].sum(0)
                    own = h[np.repeat(rows, w.n)]
                    words[i] += np.bincount(_bin(own, common[lang]), minlength=len(words[i]))
        out = [(x, 0, k, float(v)) for x, row in zip(langs, chars, strict=True) for k, v in enumerate(row)]
        out += [(x, 1, k, float(v)) for x, row in zip(langs, words, strict=True) for k, v in enumerate(row)]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.float64()))], ["lang", "kind", "bin", "n"])

    return sums


def _bin(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Bins of words: 0 for others, then the common ones, sorted by hash."""
    if not len(common):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    return np.where(common[at] == h, at + 1, 0)


def references(docs: DataFrame, rules: Rules = Rules()) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each language: its common words' hashes, its histogram of characters and of words.

    The common words are the `common` most frequent of those that hold 1/`share` of the language's words. Candidates are those
    that can be among them by what the segments tell; they are counted exactly in the pass of the histograms. These
    words and two histograms of each language with `lang_words` words reach the driver.
    """
    arrow_limits(docs.sparkSession)
    heavy = docs.select("text", "lang").mapInArrow(_heavy_words(rules.share), "lang string, word long, n long, of long")
    found = written(heavy.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("of").alias("of")), "heavy-words")
    large = found.filter("word IS NULL").select("lang", F.col("n").alias("total")).filter(F.col("total") >= rules.lang_words)
    # n is what the segments say where a word is heavy; elsewhere it has less than that share of their words
    most = F.col("n") + (F.col("total") - F.col("of")) / rules.share
    words = found.filter("word IS NOT NULL").join(large, "lang").select("lang", "word", "n", most.alias("most"))
    least = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    kth = words.withColumn("r", F.row_number().over(least)).filter(F.col("r") == rules.common).select("lang", F.col("n").alias("kth"))
    candidates = words.join(F.broadcast(kth), "lang", "left").filter(F.col("kth").isNull() | (F.col("most") >= F.col("kth")))
    held: dict[str, list[int]] = {r.lang: [] for r in large.collect()}
    for r in candidates.select("lang", "word").collect():
        held[r.lang].append(r.word)
    dropped(found)
    common = {k: np.sort(np.array(v, np.int64).view(np.uint64)) for k, v in held.items()}
    if not common:
        return {}
    sums = docs.select("text", "lang").mapInArrow(_pairs(common), "lang string, kind int, bin int, n double").groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n"))
    chars, counts_ = {k: np.zeros(CLASSES) for k in common}, {k: np.zeros(len(v) + 1) for k, v in common.items()}
    for r in sums.collect():
        (counts_ if r.kind else chars)[r.lang][r.bin] = r.n
    out = {}
    for k, words_ in common.items():
        if not chars[k].sum():
            continue
        n = counts_[k][1:]  # exact
        top = np.flatnonzero(n * rules.share >= counts_[k].sum())
        top = np.sort(top[np.lexsort((words_[top], -n[top]))[: rules.common]])
        h = np.concatenate(([counts_[k].sum() - n[top].sum()], n[top]))
        out[k] = words_[top], chars[k] / chars[k].sum(), h / max(h.sum(), 1)
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from q, base 2."""
    m = (p + q) / 2

    def kl(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(-1)

    return np.sqrt(np.maximum((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0))


def _score(refs: dict, rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                raw = Words(column(c, "text"))
                w, h = _word_keys(column(c, "text"))
                chars = _char_histogram(raw)
                p = chars / np.maximum(chars.sum(1, keepdims=True), 1)
                best = np.full((w.rows, 3), np.inf)
                doc = w.doc()
                for common, ref_c, ref_w in refs.values():
                    bins = len(common) + 1
                    q = np.bincount(doc * bins + _bin(h, common), minlength=w.rows * bins).reshape(w.rows, bins)
                    a, b = js_distance(p, ref_c), js_distance(q / np.maximum(q.sum(1, keepdims=True), 1), ref_w)
                    nearer = a + b < best[:, 0]
                    best[nearer] = np.stack((a + b, a, b), 1)[nearer]
                best[~np.isfinite(best)] = 0
                n = counts(raw, rules.window)
                judged = [x is None or x in refs for x in column(c, "lang").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [column(c, "doc_id").cast(pa.int64()), *(pa.array(n[k].astype(np.int64)) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), pa.array(best[:, 1]), pa.array(best[:, 2]), pa.array(judged, pa.bool_())],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_js", "word_js", "judged"],
                )

    return run


def with_verdict(df: DataFrame, rules: Rules) -> DataFrame:
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.most_repeat_percent * F.col("n_words"))
    far = (F.col("char_js") > rules.max_char_js) | (F.col("word_js") > rules.max_word_js) | (F.col("char_js") + F.col("word_js") > rules.max_sum_js)
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & (~F.col("judged") | (F.col("n_words") < rules.min_words) | ~far)).drop("judged")


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of docs: doc_id, the counts, both distances, base_failed and kept."""
    refs = references(docs, rules)
    return with_verdict(docs.select("doc_id", "text", "lang").mapInArrow(_score(refs, rules), _SCHEMA), rules)


def keep_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns.

    The verdict is taken in the pass that carries the rows, so nothing is joined.
    """
    refs = references(docs, rules)
    score = _score(refs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(batch):
                (s,) = score([c.select(["doc_id", "text", "lang"])])
                n, r, a, b, judged = (s.column(i).to_numpy(zero_copy_only=False) for i in (1, 5, 6, 7, 8))
                failed = (n < rules.least_words) | (100 * r > rules.most_repeat_percent * n)
                far = (a > rules.max_char_js) | (b > rules.max_word_js) | (a + b > rules.max_sum_js)
                yield c.filter(pa.array(~failed & (~judged | (n < rules.min_words) | ~far)))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))
