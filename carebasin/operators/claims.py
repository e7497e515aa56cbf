"""Claim-level columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.functions import columns as fx


def decode_claim_status(df: DataFrame) -> DataFrame:
    status = fx.decode(F.col("claim_status_code"), schemas.CLAIM_STATUS_LABELS)
    return df.withColumn("claim_status", status)


def add_date_parts(df: DataFrame, day: str) -> DataFrame:
    """Year, quarter, month, ISO week and integer date key of a date column."""
    return df.withColumns(fx.date_parts(F.col(day)))


def add_length_of_stay(df: DataFrame) -> DataFrame:
    stay = F.datediff(F.col("discharge_date"), F.col("admit_date"))
    return df.withColumn("length_of_stay", stay)
