"""Tables bucketed alike."""

import pytest
from pyspark.sql import functions as F

from carebasin.plans import marts
from carebasin.sources import catalog
from carebasin.sources.colocated import write_colocated


@pytest.fixture
def database(spark, tmp_path):
    catalog.create_database(spark, "colocated", str(tmp_path / "db"))
    yield "colocated"
    catalog.drop_database(spark, "colocated")


def tables(spark, patient):
    claims = spark.range(4000).select(
        F.col("id").cast("string").alias("claim_id"), patient.alias("patient_id"),
        (F.col("id") % 997).cast("decimal(12,2)").alias("payment_amount"),
        F.lit("x").alias("claim_id_bucket"),  # a name like that of the helper
    )
    patients = spark.range(300).select(
        F.concat(F.lit("p"), "id").alias("patient_id"), F.lit("65+").alias("age_group"),
        F.lit("Female").alias("gender_label"), (F.col("id") % 9).cast("int").alias("risk_score"),
    )
    return {"fact_claims": claims, "dim_patient_cms": patients}


def shuffles(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return final.count("Exchange hashpartitioning"), final


def test_joins_on_the_key_need_no_shuffle(spark, database):
    given = tables(spark, F.concat(F.lit("p"), F.col("id") % 300))
    want = marts.high_cost_patients(given).collect()
    assert write_colocated(spark, given, "patient_id", database, rows_per_bucket=1000) == {"fact_claims": 4, "dim_patient_cms": 4}
    held = {name: spark.table(f"{database}.{name}") for name in given}
    assert sorted(held["fact_claims"].columns) == sorted(given["fact_claims"].columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = marts.high_cost_patients(held)
        count, plan = shuffles(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got.collect() == want and want
    assert count == 0, plan


def test_a_table_with_a_hot_key_is_written_without_buckets(spark, database):
    given = tables(spark, F.when(F.col("id") % 3 == 0, "p7").otherwise(F.concat(F.lit("p"), F.col("id") % 300)))
    want = marts.high_cost_patients(given).collect()
    made = write_colocated(spark, given, "patient_id", database, rows_per_bucket=100)
    assert made == {"fact_claims": 0, "dim_patient_cms": 40}
    assert marts.high_cost_patients({n: spark.table(f"{database}.{n}") for n in given}).collect() == want


def test_empty_tables_and_rows_without_a_key(spark, database):
    given = tables(spark, F.lit(None).cast("string"))
    given["dim_patient_cms"] = given["dim_patient_cms"].limit(0)
    assert set(write_colocated(spark, given, "patient_id", database, rows_per_bucket=4000).values()) == {1}
    assert spark.table(f"{database}.fact_claims").count() == 4000
    assert spark.table(f"{database}.dim_patient_cms").count() == 0
