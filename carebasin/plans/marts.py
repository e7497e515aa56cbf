"""Analytic queries over the clean tables.

Each mart takes a mapping of table name to DataFrame and returns a lazy
DataFrame. Amounts are summed as decimals, sort ties are broken by the group
key, and NULL aggregates sort last.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carebasin.functions import columns as fx
from carebasin.operators.profile import null_profile, row_counts
from carebasin.schemas import EMERGENCY_CLASS

Tables = Mapping[str, DataFrame]
MARTS: dict[str, Callable[[Tables], DataFrame]] = {}

SAMPLE_SIZE = 5

# Tables of the row-count and sample marts.
COUNTED = (
    "dim_patient_cms",
    "fact_claims",
    "fact_carrier_claims",
    "fact_prescriptions",
    "dim_patient_ehr",
    "fact_encounters",
    "fact_observations",
    "fact_medications",
)
SAMPLED = ("dim_patient_cms", "fact_claims", "fact_encounters", "fact_medications")

# Upper bound (exclusive) and label of each payment bucket.
PAYMENT_BUCKETS = [
    (500, "< $500"),
    (2000, "$500 – $2K"),
    (5000, "$2K – $5K"),
    (10000, "$5K – $10K"),
]
TOP_BUCKET = "> $10K"

# Tier labels of the risk distribution.
TIER_RANGES = {"Low": "Low (0-2)", "Medium": "Medium (3-5)", "High": "High (6+)"}


def mart(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    MARTS[build.__name__] = build
    return build


def run_query(spark: SparkSession, name: str, tables: Tables | None = None) -> DataFrame:
    """Run a mart by name (any case), on the given frames or on the catalog's tables."""
    return MARTS[name.lower()](CatalogTables(spark) if tables is None else tables)


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL text. It names the catalog's tables as they are, and given frames
    in braces: ``SELECT count(*) FROM {fact_claims}``. Only frames that the text
    names are looked up, so a lake that reads on demand stays lazy."""
    named = set(re.findall(r"\{(\w+)\}", text)) if tables is not None else set()
    return spark.sql(text, **{name: tables[name] for name in named})


class CatalogTables(Mapping):
    """The current database's tables as a mapping."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def __iter__(self):
        return (t.name for t in self.spark.catalog.listTables())

    def __len__(self) -> int:
        return sum(1 for _ in self)


def _or_unknown(*names: str) -> Column:
    return F.coalesce(*[F.col(n) for n in names], F.lit("Unknown"))


def _rows() -> Column:
    return F.count(F.lit(1))


def _hits(condition: Column) -> Column:
    return F.count_if(condition)


def _top(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(k)


def _by_month(
    df: DataFrame, day: str, amount: Column, names: tuple[str, str, str],
    total_of=fx.total, mean_of=fx.mean,
) -> DataFrame:
    """Count, total and mean per calendar month of a date or timestamp column."""
    count, total, mean = names
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(
            F.year(day).alias("yr"),
            F.month(day).alias("mo"),
            F.date_format(day, "yyyy-MM").alias("month_label"),
        )
        .agg(_rows().alias(count), total_of(amount).alias(total), mean_of(amount).alias(mean))
        .orderBy("yr", "mo")
    )


# -- totals -------------------------------------------------------------------

@mart
def kpi_summary(tables: Tables) -> DataFrame:
    """One row of nine totals, each a scalar subquery."""
    claims = tables["fact_claims"]
    spend = claims.agg(fx.total(F.col("payment_amount"), 0).alias("n"))

    def rows(name: str) -> Column:
        return tables[name].agg(_rows().alias("n")).scalar()

    return claims.sparkSession.range(1).select(
        rows("dim_patient_cms").alias("cms_patients"),
        rows("fact_claims").alias("total_claims"),
        spend.scalar().alias("total_claims_spend"),
        rows("fact_carrier_claims").alias("carrier_claims"),
        rows("fact_prescriptions").alias("total_prescriptions"),
        rows("dim_patient_ehr").alias("ehr_patients"),
        rows("fact_encounters").alias("total_encounters"),
        rows("fact_medications").alias("total_medications"),
        rows("fact_observations").alias("total_observations"),
    )


@mart
def table_row_counts(tables: Tables) -> DataFrame:
    return row_counts({name: tables[name] for name in COUNTED})


# -- patients -------------------------------------------------------------------

@mart
def patient_age_group(tables: Tables) -> DataFrame:
    """Patients, mean risk and chronic patients per age group, in age order."""
    labels = [label for _, label in fx.AGE_BANDS] + [fx.OLDEST_BAND]
    position = F.coalesce(
        F.array_position(F.array(*map(F.lit, labels)), F.col("age_group")), F.lit(0)
    )
    return (
        tables["dim_patient_cms"]
        .groupBy(_or_unknown("age_group").alias("age_group"))
        .agg(
            _rows().alias("patient_count"),
            fx.mean(F.col("risk_score"), 1).alias("avg_risk_score"),
            _hits(F.col("is_chronic")).alias("chronic_count"),
        )
        .orderBy(F.when(position == 0, len(labels) + 1).otherwise(position), "age_group")
    )


@mart
def patient_gender_race(tables: Tables) -> DataFrame:
    return (
        tables["dim_patient_cms"]
        .groupBy(
            _or_unknown("gender_label").alias("gender_label"),
            _or_unknown("race_label").alias("race_label"),
        )
        .agg(_rows().alias("patient_count"))
        .orderBy(F.desc("patient_count"), "gender_label", "race_label")
    )


@mart
def risk_score_distribution(tables: Tables) -> DataFrame:
    months = F.coalesce(F.col("coverage_months"), F.lit(0))
    return (
        tables["dim_patient_cms"]
        .where(F.col("risk_score").isNotNull())
        .groupBy(fx.risk_tier(F.col("risk_score"), TIER_RANGES).alias("risk_tier"))
        .agg(_rows().alias("patient_count"), fx.mean(months, 1).alias("avg_coverage_months"))
        .orderBy(F.desc("patient_count"), "risk_tier")
    )


# -- claims ---------------------------------------------------------------------

@mart
def claims_by_month(tables: Tables) -> DataFrame:
    names = ("claim_count", "total_payment", "avg_payment")
    return _by_month(tables["fact_claims"], "admit_date", F.col("payment_amount"), names)


@mart
def payment_buckets(tables: Tables) -> DataFrame:
    """Claims per payment bucket, ordered by the smallest payment in it."""
    payment = F.col("payment_amount")
    bucket = F.when(payment < PAYMENT_BUCKETS[0][0], PAYMENT_BUCKETS[0][1])
    for bound, label in PAYMENT_BUCKETS[1:]:
        bucket = bucket.when(payment < bound, label)
    return (
        tables["fact_claims"]
        .where(payment.isNotNull())
        .groupBy(bucket.otherwise(TOP_BUCKET).alias("payment_bucket"))
        .agg(
            _rows().alias("claim_count"),
            fx.total(payment).alias("total_payment"),
            F.min(payment).alias("smallest"),
        )
        .orderBy("smallest")
        .drop("smallest")
    )


@mart
def high_cost_patients(tables: Tables) -> DataFrame:
    """The 20 patients with the highest spend.

    Claims are summed per patient before the join, so a patient with very many
    claims reaches the join as one row per map task.
    """
    spend = (
        tables["fact_claims"]
        .groupBy("patient_id")
        .agg(
            F.count("claim_id").alias("claims"),
            F.count("payment_amount").alias("payments"),
            F.sum("payment_amount").alias("paid"),
        )
    )
    joined = tables["dim_patient_cms"].join(spend, "patient_id")
    grouped = joined.groupBy(
        "patient_id",
        _or_unknown("age_group").alias("age_group"),
        _or_unknown("gender_label").alias("gender_label"),
        fx.risk_tier(F.col("risk_score")).alias("risk_tier"),
        F.coalesce("risk_score", F.lit(0)).alias("risk_score"),
    ).agg(
        F.sum("claims").alias("total_claims"),
        F.round(F.sum("paid"), 2).alias("total_spend"),
        F.round(
            F.try_divide(F.sum("paid").cast("decimal(26,6)"), F.sum("payments")), 2
        ).alias("avg_claim_cost"),
    )
    return _top(grouped, 20, "total_spend", "patient_id", "age_group", "gender_label", "risk_score")


@mart
def top_drugs(tables: Tables) -> DataFrame:
    grouped = (
        tables["fact_prescriptions"]
        .groupBy(
            _or_unknown("generic_name").alias("generic_name"),
            _or_unknown("brand_name").alias("brand_name"),
        )
        .agg(
            _rows().alias("prescription_count"),
            fx.mean(F.col("days_supply"), 1).alias("avg_days_supply"),
            fx.total(F.col("total_cost")).alias("total_cost"),
            fx.mean(F.col("patient_pay_amount")).alias("avg_patient_pay"),
        )
    )
    return _top(grouped, 10, "prescription_count", "generic_name", "brand_name")


# -- encounters -----------------------------------------------------------------

@mart
def encounter_by_class(tables: Tables) -> DataFrame:
    cost = F.col("total_cost")
    return (
        tables["fact_encounters"]
        .groupBy(_or_unknown("encounter_class").alias("encounter_class"))
        .agg(
            _rows().alias("visit_count"),
            fx.double_mean(cost).alias("avg_cost"),
            fx.double_total(cost).alias("total_cost"),
            _hits(F.col("encounter_class") == EMERGENCY_CLASS).alias("emergency_count"),
        )
        .orderBy(F.desc("visit_count"), "encounter_class")
    )


@mart
def encounters_by_month(tables: Tables) -> DataFrame:
    names = ("encounter_count", "total_cost", "avg_cost")
    return _by_month(
        tables["fact_encounters"], "period_start", F.col("total_cost"), names,
        fx.double_total, fx.double_mean,
    )


# -- medications ------------------------------------------------------------------

@mart
def top_medications(tables: Tables) -> DataFrame:
    grouped = (
        tables["fact_medications"]
        .groupBy(_or_unknown("drug_name").alias("drug_name"))
        .agg(
            _rows().alias("prescription_count"),
            F.countDistinct("patient_ref").alias("unique_patients"),
            _hits(F.col("is_chronic_med")).alias("chronic_count"),
        )
    )
    return _top(grouped, 10, "prescription_count", "drug_name")


@mart
def medication_chronic_split(tables: Tables) -> DataFrame:
    chronic = F.when(F.col("is_chronic_med"), "Chronic").otherwise("Acute / Other")
    return (
        tables["fact_medications"]
        .groupBy(chronic.alias("med_type"))
        .agg(
            _rows().alias("count"),
            F.countDistinct("patient_ref").alias("unique_patients"),
            F.countDistinct("drug_name").alias("unique_drugs"),
        )
    )


# -- observations -----------------------------------------------------------------

@mart
def top_observations(tables: Tables) -> DataFrame:
    grouped = (
        tables["fact_observations"]
        .where(F.col("loinc_display").isNotNull() | F.col("loinc_code").isNotNull())
        .groupBy(
            _or_unknown("loinc_display", "loinc_code").alias("observation_name"),
            F.coalesce("unit", F.lit("")).alias("unit"),
        )
        .agg(
            _rows().alias("obs_count"),
            fx.double_mean(F.col("value")).alias("avg_value"),
            _hits(F.col("is_abnormal")).alias("abnormal_count"),
            fx.share(F.col("is_abnormal")).alias("abnormal_pct"),
        )
        .select(
            "observation_name", "obs_count", "avg_value", "unit", "abnormal_count", "abnormal_pct"
        )
    )
    return _top(grouped, 10, "obs_count", "observation_name", "unit")


@mart
def abnormal_by_test(tables: Tables) -> DataFrame:
    """The 10 tests with the highest abnormal share among those with over 5 results."""
    grouped = (
        tables["fact_observations"]
        .groupBy(_or_unknown("loinc_display", "loinc_code").alias("test_name"))
        .agg(
            _rows().alias("total"),
            _hits(F.col("is_abnormal")).alias("abnormal"),
            fx.share(F.col("is_abnormal")).alias("abnormal_pct"),
        )
        .where(F.col("total") > 5)
    )
    return _top(grouped, 10, "abnormal_pct", "test_name")


# -- samples ------------------------------------------------------------------------

def sample_rows(tables: Tables, name: str) -> DataFrame:
    """Any five rows of a table."""
    return tables[name].limit(SAMPLE_SIZE)


for _name in SAMPLED:
    MARTS[f"sample_{_name}"] = lambda tables, name=_name: sample_rows(tables, name)


def sample_null_profile(tables: Tables, name: str) -> DataFrame:
    """Null percentages of the columns of a five-row sample."""
    return null_profile(sample_rows(tables, name))
