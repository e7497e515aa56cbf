"""Clinical columns: timestamps, durations, flags, code enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.functions import columns as fx
from carebasin.operators.conform import change_present
from carebasin.operators.dedup import one_per_key
from carebasin.operators.people import add_age
from carebasin.sources.readers import inline_table
from carebasin.sources.writers import stage


def normalize_timestamps(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """ISO-8601 text to timestamps, where the columns are present."""
    return change_present(df, {name: fx.text_to_moment for name in names})


def add_patient_age(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    parsed = df.withColumn("birth_date_parsed", fx.text_to_day(F.col("birth_date"), "yyyy-MM-dd"))
    return add_age(parsed, "birth_date_parsed", as_of)


def add_encounter_columns(df: DataFrame) -> DataFrame:
    start, end = F.col("period_start"), F.col("period_end")
    return df.withColumns(
        {
            "encounter_duration_hours": fx.hours_between(start, end),
            "is_emergency": F.col("encounter_class") == schemas.EMERGENCY_CLASS,
            "visit_year": F.year(start),
            "visit_month": F.month(start),
        }
    )


def flag_abnormal(df: DataFrame) -> DataFrame:
    """High or low results are abnormal; no interpretation counts as normal."""
    abnormal = F.col("interpretation_code").isin(*schemas.ABNORMAL_CODES)
    return df.withColumn("is_abnormal", F.coalesce(abnormal, F.lit(False)))


def flag_conditions(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_resolved": F.col("abatement_datetime").isNotNull(),
            "is_chronic": F.col("icd10_code").isin(*schemas.CHRONIC_CONDITIONS),
        }
    )


def flag_medications(df: DataFrame) -> DataFrame:
    chronic = fx.mentions_any(F.col("drug_name"), schemas.CHRONIC_MEDICATIONS)
    return df.withColumn("is_chronic_med", chronic)


# -- code enrichment ----------------------------------------------------------

#: Values over which rows without a code are spread in the join.
NULL_SPREAD = 1024


def enrich(
    df: DataFrame, code: str, lookup: DataFrame, key: str, outputs: dict[str, str]
) -> DataFrame:
    """Left join with a code table; unknown codes keep their row.

    ``outputs`` maps lookup columns to result names. The lookup is cut to one
    row per key, so rows never multiply, and written once: the join then reads
    two plain shuffles, and adaptive execution splits a code that holds many
    rows. Rows without a code match nothing and are spread over the tasks. No
    hint is given: Spark broadcasts a lookup whose size it knows to be small.
    """
    slim = one_per_key(lookup.where(F.col(key).isNotNull()).select(key, *outputs), [key])
    slim = slim.select(
        F.col(key).alias("_lookup_key"), F.lit(0).alias("_lookup_spread"),
        *[F.col(c).alias(name) for c, name in outputs.items()],
    )
    slim = stage(slim, "lookup")
    other = F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SPREAD)).cast("int") + 1
    spread = df.withColumn("_spread", F.when(F.col(code).isNull(), other).otherwise(F.lit(0)))
    on = (F.col(code) == F.col("_lookup_key")) & (F.col("_spread") == F.col("_lookup_spread"))
    return spread.join(slim, on, "left").drop("_lookup_key", "_lookup_spread", "_spread")


def _enrich_fixed(df: DataFrame, code: str, rows: list[tuple], names: Sequence[str]) -> DataFrame:
    # A fixed list of about ten rows, unique by code: always safe to broadcast.
    columns = ["_lookup_key", *names]
    lookup = inline_table(df.sparkSession, rows, dict.fromkeys(columns, "string"))
    joined = df.join(F.broadcast(lookup), F.col(code) == F.col("_lookup_key"), "left")
    return joined.drop("_lookup_key")


def enrich_icd10(df: DataFrame, code: str, lookup: DataFrame | None = None) -> DataFrame:
    """Description and category of ICD-10 codes.

    ``lookup`` may be a cleaned diagnosis-code table (code, description,
    category) instead of the built-in codes.
    """
    names = ("icd10_description", "icd10_category")
    if lookup is None:
        return _enrich_fixed(df, code, schemas.ICD10_CODES, names)
    return enrich(df, code, lookup, "code", dict(zip(("description", "category"), names)))


def enrich_loinc(df: DataFrame, code: str) -> DataFrame:
    names = ("loinc_display_enriched", "loinc_category")
    return _enrich_fixed(df, code, schemas.LOINC_CODES, names)


def enrich_rxnorm(df: DataFrame, code: str) -> DataFrame:
    names = ("drug_name_enriched", "drug_class")
    return _enrich_fixed(df, code, schemas.RXNORM_CODES, names)
