"""The list of checked queries: a Spark callable and, where possible, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


# Whole-number results that hold NULLs are compared as doubles, since frames of
# the two engines show nullable whole numbers differently.
NULLABLE = {
    "dim_patient_cms": "gender_code age",
    "fact_claims": "utilization_days length_of_stay",
    "dim_patient_ehr": "age",
    "fact_encounters": "is_emergency",
    "fact_medications": "is_chronic_med",
    "conform_beneficiary_summary": "gender_code chronic_diabetes chronic_kidney chronic_cancer"
    " chronic_copd chronic_depression chronic_ischemic_heart chronic_osteoporosis chronic_ra_oa"
    " chronic_stroke",
    "partitioned_roundtrip": "is_open",
    "partition_overwrite": "is_open",
    "stream_file_load": "is_emergency",
    "age_bands": "age",
    "flag_keywords": "hit",
}


def comparable(df: DataFrame, nullable: list[str]) -> DataFrame:
    """Plain types for comparison: decimals as doubles, dates and times as
    text, flags as 0/1."""

    def plain(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.BooleanType):
            value = value.cast("int")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        if field.name in nullable:
            value = value.cast("double")
        return value.alias(field.name)

    return df.select([plain(field) for field in df.schema])


def add(name: str, query: Query, sql: str | None = None) -> None:
    nullable = NULLABLE.get(name, "").split()

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(query(apply_settings(spark), sf_dir), nullable)

    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = run
    if sql is not None:
        cells = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in nullable)
        SQL[name] = f"SELECT * REPLACE ({cells}) FROM ({sql}) n" if nullable else sql.strip()


def check(sql: str | None = None, name: str | None = None):
    def register(query: Query) -> Query:
        add(name or query.__name__, query, sql)
        return query

    return register
