"""Corpus preparation in stages; each reads what its predecessor kept, as Parquet.

Every stage works on all rows it is given.  All but the last return the columns of
``documents``.  Null texts stay null up to packing, where they are the closing id alone; rows
that share a doc_id are documents of their own for every stage but line dedup, which counts
them as one; extra columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm import line_dedup, ngram_join, packing, pii, quality
from rowmill.llm.common import table, written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents hold go, but in one of them."""
    return line_dedup.drop_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest doc_id."""
    return ngram_join.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into training sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good),
    ("line_dedup", lines),
    ("ngram_jaccard_join", one_of_each),
    ("pii", private),
    ("best_fit_packing", packed),
]

#: A trained model, disguises and a tokenizer aren't SQL: the tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
