"""A training corpus from documents: STAGES in order, each on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns the rows of ``docs`` that it keeps with
the columns of documents; the last returns what its operator makes of them.  Labels come
from the labels table in ``sf_dir``.  ``run`` writes what a stage keeps to the shared folder
and reads it back for the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gradeflow.llm import bpe, mixing, near_dedup, quality, toxicity
from gradeflow.llm.common import landed, ship, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "word_bpe_49k.json"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the toxicity operator rejects."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    index = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, index).filter("predicted = 0").select(*COLUMNS)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality operator rejects."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    field = quality.trained(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, field).filter("predicted = 1").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id."""
    ship(spark)
    return near_dedup.one_of_each(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents as often as the mix of sources takes them, some not at all."""
    ship(spark)
    return mixing.apply_mix(docs.select(*COLUMNS)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes every row."""
    ship(spark)
    return bpe.encoded(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("near_dedup", one_of_each),
    ("mixing", mixed),
    ("bpe", tokens),
]

#: Learnt classifiers and a tokenizer's encoding have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
