"""The queries of the corpus operators and, where possible, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carebasin.llm import (
    bbit_minhash,
    decontaminate,
    language,
    lattice_lm,
    line_dedup,
    mixing,
    ngram_join,
    periodic_runs,
    quality_crf,
    quality_rules,
    suffix_dedup,
    token_alignment,
    warc,
)
from carebasin.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql.strip()
        return function

    return register


@query()
def op1_ngram_join(spark, sf_dir):
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


@query()
def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


@query()
def op3_language(spark, sf_dir):
    return language.report(table(spark, sf_dir, "documents"))


@query()
def op4_warc(spark, sf_dir):
    return warc.report(table(spark, sf_dir, "pages"))


@query(mixing.SQL)
def op5_mix_sources(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


@query(line_dedup.SQL)
def op6_line_dedup(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query(quality_rules.SQL)
def op9_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query()
def op7_lattice_lm(spark, sf_dir):
    return lattice_lm.report(table(spark, sf_dir, "documents"))


@query(decontaminate.SQL)
def op8_decontaminate(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op10_quality_classifier(spark, sf_dir):
    return quality_crf.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.report(table(spark, sf_dir, "documents"))


@query()
def op12_bbit_minhash(spark, sf_dir):
    return bbit_minhash.report(table(spark, sf_dir, "documents"))


@query()
def op13_token_alignment(spark, sf_dir):
    return token_alignment.report(table(spark, sf_dir, "documents"))
