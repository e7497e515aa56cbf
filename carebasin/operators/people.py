"""Patient-level columns: decoding, null flags, age, risk, masking, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.functions import columns as fx
from carebasin.operators.conform import change_present


def decode_gender(df: DataFrame) -> DataFrame:
    return df.withColumn("gender_label", fx.decode(F.col("gender_code"), schemas.GENDER_LABELS))


def decode_race(df: DataFrame) -> DataFrame:
    return df.withColumn("race_label", fx.decode(F.col("race_code"), schemas.RACE_LABELS))


def flag_missing_facts(df: DataFrame) -> DataFrame:
    """Death and missing-birth flags; unknown chronic conditions become false."""
    flags = {
        "is_deceased": F.col("death_date").isNotNull(),
        "missing_birth_date_flag": F.col("birth_date").isNull(),
    }
    known = {c: F.coalesce(F.col(c), F.lit(False)) for c in schemas.CHRONIC_FLAGS}
    return df.withColumns({**flags, **known})


def add_age(
    df: DataFrame, birth: str = "birth_date", as_of: Column | None = None,
    null_label: str | None = None,
) -> DataFrame:
    """Age in years and age group, on the current date unless ``as_of`` is given."""
    age = fx.age_in_years(F.col(birth), as_of)
    return df.withColumns({"age": age, "age_group": fx.age_band(age, null_label)})


def add_risk(df: DataFrame, flags: Sequence[str] = schemas.CHRONIC_FLAGS) -> DataFrame:
    """Score = number of chronic conditions; tier and chronic flag from it."""
    score = fx.count_flags(F.col(c) for c in flags)
    return df.withColumns(
        {
            "risk_score": score,
            "risk_tier": fx.risk_tier(score),
            "is_chronic": score >= fx.CHRONIC_FROM,
        }
    )


def add_key(df: DataFrame, source: str, key: str) -> DataFrame:
    """Surrogate key: SHA-256 hex of the business key."""
    return df.withColumn(key, fx.sha_key(F.col(source)))


def mask_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace personal values by their SHA-256 hex, where present."""
    return change_present(df, {name: fx.sha_key for name in names})
