"""Character n-gram profiles of languages: what X15 asks about short texts of both scripts.

A profile counts the runs of 1 to `longest` characters inside the words of labelled texts, a space on either side of each word. A text's
score in a language is the sum over its runs of floor(1000 ln((c + 1) / (C + V))): c counts the run in the language, C all
runs of its length there, V the distinct runs of that length in all languages, and one. Runs that no language has tell nothing. The
highest score wins, ties go to the smaller code, and a text without a known run has no language.

Words are counted before they are cut, so only distinct words of a language are. Null languages and null texts take no part.
`most` bounds the runs that are kept of a language, the most frequent ones, and `languages` the languages; more of these raise an error.
So the table that travels to the tasks is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import let


@dataclass(frozen=True)
class Shape:
    longest: int = 3
    most: int = 20_000
    languages: int = 64


def words(text: Column) -> Column:
    """Runs of letters in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def runs(word: Column, n: int) -> Column:
    """Runs of n characters of a word with a space on either side, but for the space alone."""

    def cut(c: Column) -> Column:
        starts = F.when(F.size(c) >= n, F.sequence(F.lit(1), F.size(c) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(F.transform(starts, lambda i: F.array_join(F.slice(c, i, n), "")), lambda g: g != " ")

    return let(F.filter(F.split(F.concat(F.lit(" "), word, F.lit(" ")), ""), lambda x: x != ""), cut)


def profiles(texts: DataFrame, s: Shape = Shape()) -> DataFrame:
    """lang, n, run, c of texts with lang and text: how often each language has its most frequent runs of n characters."""
    spoken = texts.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.explode(words(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("c"))
    cut = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), runs(F.col("word"), n).alias("runs")) for n in range(1, s.longest + 1)))).alias("x")
    counted = spoken.select("lang", "c", cut).select("lang", "c", "x.n", F.explode("x.runs").alias("run")).groupBy("lang", "n", "run").agg(F.sum("c").alias("c"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c"), "n", "run"))
    return counted.withColumn("place", place).filter(F.col("place") <= s.most).drop("place")


@dataclass
class Scorer:
    """The weights of a profile: a row of `weights` for each run, a column for each language."""

    languages: list[str]
    rows: dict[str, int]
    weights: np.ndarray
    longest: int

    def word(self, word: str) -> list[int] | None:
        """A word's scores; None without a known run."""
        w = f" {word} "
        found = [r for n in range(1, self.longest + 1) for i in range(len(w) - n + 1) if (r := self.rows.get(w[i : i + n])) is not None]
        return self.weights[found].sum(0).tolist() if found else None

    def language(self, words: list[str], known: dict[str, list[int] | None] | None = None, most: int = 1 << 16) -> str | None:
        """known holds scores of at most `most` words from call to call."""
        known, total = {} if known is None else known, None
        for w in words:
            if w in known:
                x = known[w]
            else:
                x = self.word(w)
                if len(known) < most and len(w) < 64:
                    known[w] = x
            if x is not None:
                total = x if total is None else [a + b for a, b in zip(total, x)]
        return None if total is None else self.languages[total.index(max(total))]


def scorer(profile: DataFrame, s: Shape = Shape()) -> Scorer:
    """Collects a profile: s.most runs of each of s.languages languages at most."""
    kept = profile.limit(s.most * s.languages + 1).toPandas()
    languages = sorted(kept["lang"].unique())
    if len(languages) > s.languages or len(kept) > s.most * s.languages:
        raise ValueError(f"more than {s.languages} languages")
    rows = {r: i for i, r in enumerate(sorted(kept["run"].unique()))}
    length = np.array([len(r) for r in rows], np.int64)
    counts = np.zeros((len(rows), len(languages)))
    counts[kept["run"].map(rows).to_numpy(np.int64), kept["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(np.int64)] = kept["c"]
    sizes = np.array([counts[length == n].sum(0) + (length == n).sum() + 1 for n in range(s.longest + 1)])
    return Scorer(languages, rows, np.floor(1000 * np.log((counts + 1) / sizes[length])).astype(np.int64), s.longest)


def detector(profile: DataFrame, s: Shape = Shape()) -> Callable[[Column], Column]:
    """The function that `field_language` takes as `short`. A task scores a word once, as far as it holds them."""
    held = profile.sparkSession.sparkContext.broadcast(scorer(profile, s))

    @F.pandas_udf("string")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        profile, known = held.value, {}
        for batch in batches:
            yield pd.Series([t and profile.language(t.split(" "), known) or None for t in batch], index=batch.index, dtype=object)

    return lambda text: judged(F.array_join(words(text), " "))  # letters hold no space, and strings travel faster than lists
