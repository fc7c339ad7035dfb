"""A training corpus from documents: quality, lines, near copies, mixture, tokens.

Each stage reads the table the one before has written and works on all of it.  All but the last give
back rows with the columns of documents.
"""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from accessgrid.llm import bpe, jaccard_join, lines, mixing, quality, ready
from accessgrid.llm.common import KEY, row_key, written
from accessgrid.llm.queries import VOCABULARY, WEIGHTS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; rows that agree in id and text are judged alike."""
    ready(spark)
    keyed = docs.withColumn(KEY, row_key("doc_id", "text"))
    kept = quality.quality(keyed, KEY, by_own_limits=True).filter("kept").select(KEY).distinct()
    return keyed.join(kept, KEY, "left_semi").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand elsewhere go; all documents stay, some with an empty text."""
    return lines.without_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    ready(spark)
    return jaccard_join.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by target weights; one drawn in two epochs is there twice.

    Null languages and sources are leaves of their own, texts without words are not drawn.  Repeated
    rows are drawn each.
    """
    return mixing.mixed(docs, WEIGHTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the decoded text; null is the empty text.

    A row for each row, repeated ones too.
    """
    ready(spark)
    return bpe.round_trip(docs, "text", public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_copies),
    ("mixing", mixture),
    ("byte-level BPE", tokens),
]

#: Components, trees of budgets and merges to a fixpoint are beyond SQL; the tests hold each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs) if n < len(STAGES) else docs
    return docs
