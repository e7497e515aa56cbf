from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin import schemas
from carebasin.operators import claims, conform, money, packing, people
from carebasin.operators.dedup import one_per_key
from carebasin.operators.profile import null_profile, row_counts
from carebasin.operators.quantile import approximate_quantile, exact_quantile
from checks.measure import shuffled


def raw_rows(spark, layout, *rows):
    """Raw frame with the given values; other columns are NULL."""
    full = [tuple(row.get(c.raw) for c in layout) for row in rows]
    return spark.createDataFrame(full, schemas.raw_schema(layout))


# -- names and types ---------------------------------------------------------------


@pytest.mark.parametrize("entity", list(schemas.RAW_ENTITIES))
def test_rename_gives_clean_names_only(spark, entity):
    layout = schemas.RAW_ENTITIES[entity]
    renamed = conform.rename_columns(raw_rows(spark, layout), layout)
    assert renamed.columns == [c.clean for c in layout]


def test_layout_sizes():
    sizes = {name: len(layout) for name, layout in schemas.RAW_ENTITIES.items()}
    assert sizes == {
        "beneficiary_summary": 18, "providers": 8, "inpatient_claims": 29,
        "outpatient_claims": 24, "carrier_claims": 19, "prescription_drug_events": 11,
        "diagnosis_codes": 4,
    }
    assert len(schemas.CHRONIC_FLAGS) == 9


def test_beneficiary_types(spark):
    raw = raw_rows(
        spark, schemas.BENEFICIARY,
        {"DESYNPUF_ID": "A", "BENE_BIRTH_DT": "19500101", "BENE_DEATH_DT": "", "SP_DIABETES": "1",
         "BENE_STATE_CD": "01", "BENE_SEX_IDENT_CD": "2", "PLAN_TYPE": "10"},
    )
    typed = conform.cast_columns(conform.rename_columns(raw, schemas.BENEFICIARY), schemas.BENEFICIARY)
    kinds = dict(typed.dtypes)
    assert (kinds["birth_date"], kinds["chronic_stroke"], kinds["gender_code"]) == ("date", "boolean", "int")
    row = typed.first()
    assert (row.birth_date, row.death_date, row.chronic_diabetes) == (date(1950, 1, 1), None, True)
    assert (row.state_code, row.plan_type) == ("01", 10)


def test_claim_types(spark):
    raw = raw_rows(spark, schemas.INPATIENT, {"CLM_PMT_AMT": "12.345", "CLM_DRG_CD": "065"})
    typed = conform.cast_columns(conform.rename_columns(raw, schemas.INPATIENT), schemas.INPATIENT)
    assert typed.schema["payment_amount"].dataType == T.DecimalType(12, 2)
    assert typed.first().payment_amount == Decimal("12.35")
    assert typed.first().drg_code == "065"


def test_prescription_types(spark):
    raw = raw_rows(spark, schemas.PRESCRIPTION, {"TOT_RX_CST_AMT": "5", "PROD_SRVC_ID": "00093721401"})
    typed = conform.cast_columns(
        conform.rename_columns(raw, schemas.PRESCRIPTION), schemas.PRESCRIPTION
    )
    assert typed.schema["total_cost"].dataType == T.DecimalType(10, 2)
    assert typed.first().drug_code == "00093721401"
    filled = money.fill_missing_amounts(typed, schemas.FILLED_AMOUNTS)
    assert filled.schema["total_cost"].dataType == T.DecimalType(12, 2)
    assert "is_payment_missing" not in filled.columns


def test_casts_pass_over_absent_columns(spark):
    frame = spark.createDataFrame([("1",)], "other string")
    assert conform.cast_columns(frame, schemas.INPATIENT).columns == ["other"]
    assert money.fill_missing_amounts(frame, schemas.FILLED_AMOUNTS).columns == ["other"]
    assert people.mask_columns(frame, ["family_name"]).first().other == "1"


def test_stack_fills_absent_columns(spark):
    first = spark.createDataFrame([(1, "a")], "id int, x string")
    second = spark.createDataFrame([("b", 2)], "y string, id int")
    rows = conform.stack(first, second).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "a", None), (2, None, "b")]


def test_align_by_name(spark):
    target = T.StructType(
        [T.StructField("Id", T.IntegerType()), T.StructField("amount", T.DecimalType(12, 2)),
         T.StructField("gone", T.DateType())]
    )
    frame = spark.createDataFrame([("9", "x", "7"), ("y", "x", "8.126")], "ID string, extra string, Amount string")
    aligned = conform.align_by_name(frame, target)
    assert aligned.schema == target
    assert [tuple(r) for r in aligned.collect()] == [
        (9, Decimal("7.00"), None), (None, Decimal("8.13"), None)
    ]


# -- labels, flags, ages -------------------------------------------------------------


def test_labels(spark):
    frame = spark.createDataFrame([(1, 1, "A"), (2, 5, "N"), (9, 9, "X"), (None, None, None)],
                                  "gender_code int, race_code int, claim_status_code string")
    labelled = claims.decode_claim_status(people.decode_race(people.decode_gender(frame)))
    got = [(r.gender_label, r.race_label, r.claim_status) for r in labelled.collect()]
    assert got == [
        ("Male", "White", "Assigned"), ("Female", "Hispanic", "Non-assigned"),
        ("Unknown", "Unknown", "Unknown"), ("Unknown", "Unknown", "Unknown"),
    ]


def test_missing_facts(spark):
    names = ["birth_date", "death_date", *schemas.CHRONIC_FLAGS]
    schema = "birth_date date, death_date date, " + ", ".join(f"{c} boolean" for c in names[2:])
    frame = spark.createDataFrame(
        [(date(1950, 1, 1), None, *[None] * 9), (None, date(2020, 1, 1), *[True] * 9)], schema
    )
    rows = people.flag_missing_facts(frame).collect()
    assert (rows[0].is_deceased, rows[0].missing_birth_date_flag) == (False, False)
    assert (rows[1].is_deceased, rows[1].missing_birth_date_flag) == (True, True)
    assert rows[0].chronic_diabetes is False and rows[1].chronic_stroke is True


@pytest.mark.parametrize(
    ("count", "tier", "chronic"), [(0, "Low", False), (1, "Low", False), (3, "Medium", True),
                                   (4, "Medium", True), (6, "High", True), (7, "High", True)]
)
def test_risk(spark, count, tier, chronic):
    values = [i < count for i in range(9)]
    frame = spark.createDataFrame([values], ", ".join(f"{c} boolean" for c in schemas.CHRONIC_FLAGS))
    row = people.add_risk(frame).first()
    assert (row.risk_score, row.risk_tier, row.is_chronic) == (count, tier, chronic)


def test_age_groups_follow_the_given_date(spark):
    frame = spark.createDataFrame([(date(1950, 1, 1),), (date(2010, 1, 1),), (None,)], "birth_date date")
    rows = people.add_age(frame, as_of=F.to_date(F.lit("2024-06-15"))).collect()
    assert [(r.age, r.age_group) for r in rows] == [(74, "65+"), (14, "0-17"), (None, "65+")]


def test_length_of_stay(spark):
    frame = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 5))], "admit_date date, discharge_date date")
    assert claims.add_length_of_stay(frame).first().length_of_stay == 4


def test_masking(spark):
    frame = spark.createDataFrame([("Doe", "NYC"), ("Doe", "LA"), (None, "SF")], "family_name string, city string")
    rows = people.mask_columns(frame, ["family_name", "absent"]).collect()
    assert len(rows[0].family_name) == 64 and rows[0].family_name == rows[1].family_name
    assert rows[2].family_name is None
    assert [r.city for r in rows] == ["NYC", "LA", "SF"]


# -- duplicates ------------------------------------------------------------------------


def test_one_row_per_key(spark):
    frame = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), (None, 3), (None, 4)], "k string, v int")
    rows = sorted(one_per_key(frame, ["k"]).collect(), key=lambda r: str(r.k))
    assert [tuple(r) for r in rows] == [(None, 3), ("a", 1), ("b", 5)]


def test_survivor_can_be_chosen(spark):
    frame = spark.createDataFrame([("a", 2), ("a", 1), ("a", 9)], "k string, v int")
    assert one_per_key(frame, ["k"], [F.desc("v")]).first().v == 9


def test_unique_rows_are_kept(spark):
    frame = spark.range(50)
    assert one_per_key(frame, ["id"]).count() == 50
    assert one_per_key(frame.where("id < 0"), ["id"]).count() == 0


def test_hot_key_is_cut_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = one_per_key(frame, ["k"])._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


ODD = [None, "", "a", "\x00", "\x01", "\x01\x01", "\x01\x02", "\x00a", "a\x00", "aa", "é", "\U0001F600", "\n", " "]


def test_packed_texts_come_back_and_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHORTEST", 3)
    rows = [(k % 40, *(ODD[(k * p + k // 9) % len(ODD)] for p in (1, 3, 5)), k % 3, *(ODD[(k + k // p) % len(ODD)] for p in (2, 7, 11)))
            for k in range(1500)]
    frame = spark.createDataFrame(rows, "k int, a string, b string, c string, n int, e string, f string, g string")
    runs = packing.text_runs(frame, {"k"})
    assert runs == [["k"], ["a", "b", "c"], ["n"], ["e", "f", "g"]]
    packed = packing.pack(frame, runs)
    back = packing.unpack(packed.orderBy(*packed.columns), runs)
    assert back.columns == frame.columns
    assert back.collect() == frame.orderBy(*frame.columns).collect()
    ranking = Window.partitionBy("k").orderBy("a", "b", "c", "n", "e", "f", "g")
    first = frame.withColumn("r", F.row_number().over(ranking)).where("r = 1").drop("r")
    assert sorted(map(repr, one_per_key(frame, ["k"]).collect())) == sorted(map(repr, first.collect()))


def test_wide_texts_are_shuffled_packed(spark):
    frame = spark.range(20_000, numPartitions=4).select(
        F.col("id").cast("string").alias("k"),
        *[F.when(F.col("id") % 7 > i, F.concat(F.lit("D"), F.col("id") * (i + 3) % 97)).alias(f"c{i}") for i in range(20)],
    )

    def moved(df):
        before = set(shuffled(spark))
        df.write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return sum(n for stage, n in shuffled(spark).items() if stage not in before)

    plain = moved(frame.repartition(4, "k"))
    plan = one_per_key(frame, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "_run_1" in plan.split("Exchange hashpartitioning")[1] and "c0" not in plan.split("WindowGroupLimit")[1]
    assert 0 < moved(one_per_key(frame, ["k"])) < 0.9 * plain


# -- quantiles and amounts ----------------------------------------------------------------


def brute_quantile(values, fraction):
    ordered = sorted(v for v in values if v is not None)
    for position, value in enumerate(ordered, 1):
        if position >= Decimal(str(fraction)) * len(ordered):
            return value
    return None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.one_of(st.none(), st.decimals(-9_999_999_999, 9_999_999_999, places=2),
                  st.decimals(-20, 20, places=2)), min_size=1, max_size=60,
    ),
    fraction=st.sampled_from([0.0, 0.01, 0.07, 0.5, 0.99, 1.0]),
)
def test_exact_quantile_equals_brute_force(spark, values, fraction):
    frame = spark.createDataFrame([(v,) for v in values], "v decimal(12,2)")
    assert exact_quantile(frame, "v", fraction).first().threshold == brute_quantile(values, fraction)


def test_exact_quantile_equals_percentile_disc(spark):
    frame = spark.range(20_000).select(
        ((F.hash("id") % 1_000_000) / 7).cast("decimal(18,2)").alias("v")
    )
    want = frame.agg(F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY v)")).first()[0]
    assert exact_quantile(frame, "v", 0.99).first().threshold == want


def test_exact_quantile_with_one_hot_value(spark):
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id")).cast("int").alias("v")
    )
    values = [42 if i % 3 == 0 else i for i in range(3000)]
    for fraction in (0.01, 0.3, 0.99):
        assert exact_quantile(frame, "v", fraction).first().threshold == brute_quantile(values, fraction)


def test_exact_quantile_needs_countable_values(spark):
    with pytest.raises(ValueError, match="decimal"):
        exact_quantile(spark.sql("SELECT 1.5D AS v"), "v", 0.5)


def test_quantile_of_an_empty_frame_is_null(spark):
    frame = spark.createDataFrame([], "v decimal(12,2)")
    assert exact_quantile(frame, "v", 0.99).first().threshold is None
    assert approximate_quantile(frame, "v", 0.99).first().threshold is None


def amounts(spark, *values):
    return spark.createDataFrame([(None if v is None else Decimal(v),) for v in values], "payment_amount decimal(12,2)")


def test_missing_payments_are_flagged_and_filled(spark):
    rows = money.fill_missing_amounts(amounts(spark, None, "5"), schemas.FILLED_AMOUNTS).collect()
    assert [(r.payment_amount, r.is_payment_missing) for r in rows] == [
        (Decimal("0.00"), True), (Decimal("5.00"), False)
    ]


def test_negative_amounts_become_zero(spark):
    rows = money.clean_amounts(amounts(spark, "-50.0", "10.00"), ["payment_amount"]).collect()
    assert [(r.payment_amount, r.is_negative_payment_amount) for r in rows] == [
        (Decimal("0.00"), True), (Decimal("10.00"), False)
    ]


def test_high_costs_are_strictly_above_the_threshold(spark):
    frame = amounts(spark, *[str(i) for i in range(1, 201)])
    for method in ("exact", "approx"):
        cleaned = money.clean_amounts(frame, ["payment_amount"], method=method)
        high = {r.payment_amount for r in cleaned.where("is_high_cost").collect()}
        assert high == {Decimal("199.00"), Decimal("200.00")}


def test_known_threshold(spark):
    cleaned = money.clean_amounts(amounts(spark, "5", "7"), ["payment_amount"], threshold=6.0)
    assert [r.is_high_cost for r in cleaned.collect()] == [False, True]


def test_doubles_are_rounded_to_cents(spark):
    frame = spark.sql("SELECT 100.123D AS payment_amount")
    row = money.clean_amounts(frame, ["payment_amount"], method="approx").first()
    assert row.payment_amount == Decimal("100.12")


def test_clean_amounts_without_rows_or_column(spark):
    assert money.clean_amounts(amounts(spark), ["payment_amount"]).count() == 0
    frame = spark.range(1)
    assert money.clean_amounts(frame, ["payment_amount"]).columns == ["id"]


def test_further_amounts_are_cleaned_without_a_threshold_of_their_own(spark):
    frame = spark.sql("SELECT cast(1 AS decimal(12,2)) AS a, cast(-2 AS decimal(12,2)) AS b")
    row = money.clean_amounts(frame, ["a", "b", "absent"]).first()
    assert (row.b, row.is_negative_b, row.is_high_cost) == (Decimal("0.00"), True, False)


def test_threshold_and_table_share_one_shuffle(spark):
    frame = spark.range(1000).select(
        (F.col("id") % 400).alias("k"), (F.col("id") % 97).cast("decimal(12,2)").alias("v")
    )
    cleaned = money.clean_amounts(one_per_key(frame, ["k"]), ["v"])
    cleaned.collect()
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


# -- profiles -----------------------------------------------------------------------------


def test_null_profile(spark):
    frame = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c string")
    assert [tuple(r) for r in null_profile(frame).collect()] == [("c", 100.0), ("b", 50.0)]
    assert null_profile(frame.where("a > 9")).count() == 0


def test_row_counts(spark):
    counts = row_counts({"few": spark.range(2), "many": spark.range(5), "none": spark.range(0)})
    assert [tuple(r) for r in counts.collect()] == [("many", 5), ("few", 2), ("none", 0)]
