"""Hard rows: nulls, empty and very long texts, ties, repeated rows, odd characters, and columns with clashing names."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, node string, score string, spans string, label int, rank int, n_words int"


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n)]


def rows() -> list[tuple]:
    base = words(1, 400)
    near = base[:200] + ["changed"] + base[201:]
    passage = words(2, 60)
    texts = {
        1: " ".join(base), 2: " ".join(base), 3: " ".join(near), 4: None, 5: "", 6: " \n\t ", 7: "one", 8: "one two three", 9: "One TWO three",
        10: " ".join(words(3, 50) + passage + words(4, 50)), 11: " ".join(words(5, 9) + passage + words(6, 30)), 12: " ".join(passage), 13: " ".join(words(7, 30_000)),
        14: "same same " * 300, 15: "日本語 テキスト ▁ é ß 😀\nline\nline\n", 16: "x" * 5000, 17: " ".join(base[:35]), 18: "a b c d e f g h i j " * 4,
    }
    out = [(k, t, "en" if k % 2 else "de", f"s{k % 3}", None if t is None else len(t), k, "n", "s", "p", 1, 1, 1) for k, t in texts.items()]
    out.append(out[0])  # a whole row again
    out.append((None, "a row without an id but with some words in it", None, None, None, None, None, None, None, None, None, None))
    out.append((None, None, None, None, None, None, None, None, None, None, None, None))
    out.append((7, "the same id with another text", "en", "s", 3, 1, "n", "s", "p", 1, 1, 1))
    return out


@pytest.fixture(scope="session")
def hard_rows():
    return rows()


@pytest.fixture(scope="session")
def hard(spark, hard_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hard") / "documents.parquet")
    spark.createDataFrame(hard_rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def split(text: str | None, lower: bool = True) -> list[bytes]:
    data = (text or "").encode()
    return (data.lower() if lower else data).split()
