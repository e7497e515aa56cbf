"""A training corpus from the documents: five stages, each written and reread.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of ``documents``; the last returns one
row per copy in the mix, numbered in ``mix_copy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carebasin.llm import decontaminate, language, line_dedup, mixing, ngram_join
from carebasin.llm.common import table
from carebasin.sources.writers import stage


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a dominating language go."""
    return language.accepted(docs, language.train(language.training_rows(docs)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three-line passages stay where they occur first."""
    return line_dedup.shortened(docs)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return ngram_join.one_per_group(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are sampled to their target weights."""
    return mixing.mixed(docs)


STAGES = [
    ("language", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_near_copy),
    ("decontaminate", drop_benchmark_leaks),
    ("mix", mix_sources),
]

#: The language stage infers mixtures by expectation-maximisation: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"corpus-{name}")
    return docs
