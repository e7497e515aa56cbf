from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from carebasin.functions import columns as fx


def evaluate(spark, value, kind, build):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(build(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("19500101", date(1950, 1, 1)), ("19600230", None), ("", None), (None, None), ("abc", None)],
)
def test_text_to_day(spark, text, want):
    assert evaluate(spark, text, "string", fx.text_to_day) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-06-15T10:30:00+05:30", datetime(2024, 6, 15, 5, 0)),
        ("2024-06-15T10:30:00Z", datetime(2024, 6, 15, 10, 30)),
        ("2024-06-15", datetime(2024, 6, 15)),
        ("soon", None),
        (None, None),
    ],
)
def test_text_to_moment_is_utc(spark, text, want):
    shown = evaluate(
        spark, text, "string",
        lambda c: F.date_format(fx.text_to_moment(c), "yyyy-MM-dd HH:mm:ss"),
    )
    assert shown == (want and want.strftime("%Y-%m-%d %H:%M:%S"))


@pytest.mark.parametrize(
    ("text", "want"), [("7", 7), ("7.9", 7), ("-3", -3), ("", None), ("x", None), (None, None)]
)
def test_text_to_int(spark, text, want):
    assert evaluate(spark, text, "string", fx.text_to_int) == want


@pytest.mark.parametrize(
    ("text", "want"), [("1", True), ("0", False), ("2", True), (None, None), ("", None)]
)
def test_text_to_flag(spark, text, want):
    assert evaluate(spark, text, "string", fx.text_to_flag) is want


@pytest.mark.parametrize(
    ("text", "want"), [("1.235", "1.24"), ("100.123", "100.12"), ("-50", "-50.00"), ("n/a", None)]
)
def test_to_money(spark, text, want):
    got = evaluate(spark, text, "string", fx.to_money)
    assert (None if got is None else str(got)) == want


@pytest.mark.parametrize(
    ("age", "want"),
    [(0, "0-17"), (17, "0-17"), (18, "18-34"), (34, "18-34"), (35, "35-49"), (49, "35-49"),
     (50, "50-64"), (64, "50-64"), (65, "65+"), (101, "65+"), (None, "65+")],
)
def test_age_band(spark, age, want):
    assert evaluate(spark, age, "int", fx.age_band) == want


def test_age_band_can_label_unknown_ages(spark):
    assert evaluate(spark, None, "int", lambda c: fx.age_band(c, "Unknown")) == "Unknown"
    assert evaluate(spark, 70, "int", lambda c: fx.age_band(c, "Unknown")) == "65+"


def test_age_in_years_truncates(spark):
    as_of = F.to_date(F.lit("2024-06-15"))
    for birth, want in [("1950-01-01", 74), ("2024-06-14", 0), ("2025-06-15", 0), (None, None)]:
        got = evaluate(spark, birth, "string", lambda c: fx.age_in_years(c.cast("date"), as_of))
        assert got == want


def test_age_defaults_to_the_current_date(spark):
    assert evaluate(spark, "1950-01-01", "string", lambda c: fx.age_in_years(c.cast("date"))) > 70


def test_risk_tier(spark):
    for score, want in [(0, "Low"), (2, "Low"), (3, "Medium"), (5, "Medium"), (6, "High"), (None, "High")]:
        assert evaluate(spark, score, "int", fx.risk_tier) == want


def test_mentions_any(spark):
    words = ["metformin", "warfarin"]
    for text, want in [("METFORMIN 500", True), ("aspirin", False), (None, None)]:
        assert evaluate(spark, text, "string", lambda c: fx.mentions_any(c, words)) is want


def test_date_parts(spark):
    frame = spark.createDataFrame([("2024-06-15",), ("2021-01-01",)], "d string")
    parts = frame.select(F.col("d").cast("date").alias("d")).select(
        *[c.alias(n) for n, c in fx.date_parts(F.col("d")).items()]
    )
    assert [tuple(r) for r in parts.collect()] == [
        (2024, 2, 6, 24, 20240615),
        (2021, 1, 1, 53, 20210101),
    ]


def test_hours_between(spark):
    frame = spark.createDataFrame([("2024-01-01 10:00:00", "2024-01-01 12:30:00"), (None, "x")], "a string, b string")
    got = frame.select(fx.hours_between(fx.text_to_moment(F.col("a")), fx.text_to_moment(F.col("b"))))
    assert [r[0] for r in got.collect()] == [2.5, None]


def test_sha_key(spark):
    first = evaluate(spark, "abc", "string", fx.sha_key)
    assert len(first) == 64
    assert first == evaluate(spark, "abc", "string", fx.sha_key)
    assert first != evaluate(spark, "abd", "string", fx.sha_key)
    assert evaluate(spark, None, "string", fx.sha_key) is None


def test_aggregates_round_half_up_once(spark):
    frame = spark.sql("SELECT cast(x AS decimal(12,2)) AS x FROM VALUES (0.01), (0.02), (null) t(x)")
    row = frame.agg(
        fx.mean(F.col("x")).alias("mean"), fx.total(F.col("x")).alias("total"),
        fx.share(F.col("x") > 0.015).alias("share"),
    ).first()
    assert (str(row["mean"]), str(row["total"]), str(row["share"])) == ("0.02", "0.03", "33.3")


def test_mean_of_nothing_is_null(spark):
    assert spark.range(0).agg(fx.mean(F.col("id"))).first()[0] is None
    assert spark.sql("SELECT cast(null AS int) AS x").agg(fx.mean(F.col("x"))).first()[0] is None
