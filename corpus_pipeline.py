"""The corpus pipeline: quality rules, toxicity, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is
written as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardmill.llm import ngram_join, packing, quality, substring, toxicity
from cardmill.llm.store import dropped, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counted rules or their distance from every language reject go."""
    return quality.keep_documents(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go. It learns from the labels of training rows."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: five-word shingles, Jaccard similarity 0.8 or more."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that a repeated passage of 35 words or more covers go from the texts; no document goes."""
    return substring.deduplicated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens at most."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("packing", packed),
]

#: Language references, a fitted classifier and a tokenizer: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            dropped(before)  # nothing reads the stage before any more
        before = docs
    return docs
