import csv
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.plans import claims, marts
from carebasin.sources import readers
from carebasin.sources.writers import stage, write_table


def land(folder, entity, day, *rows):
    place = folder / "year=2024" / "month=06" / f"day={day}"
    place.mkdir(parents=True, exist_ok=True)
    names = [c.raw for c in schemas.RAW_ENTITIES[entity]]
    with open(place / f"{entity}_{day}.csv", "w", newline="") as file:
        writer = csv.DictWriter(file, names, restval="")
        writer.writeheader()
        writer.writerows(rows)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    flags = [c.raw for c in schemas.BENEFICIARY if c.kind == "flag"]
    ann = {"DESYNPUF_ID": "A", "BENE_BIRTH_DT": "19500101", "BENE_SEX_IDENT_CD": "2",
           "BENE_RACE_CD": "1", "BENE_STATE_CD": "01", "BENE_HI_CVRAGE_TOT_MONS": "12",
           **dict.fromkeys(flags[:4], "1")}
    bob = {"DESYNPUF_ID": "B", "BENE_BIRTH_DT": "19600230", "BENE_DEATH_DT": "20200101",
           "BENE_SEX_IDENT_CD": "1", "BENE_STATE_CD": "02"}
    land(folder, "beneficiary_summary", "15", ann, bob)
    land(folder, "beneficiary_summary", "16", ann)
    land(folder, "providers", "15", {"PROVIDER_ID": "0001", "PRVDR_SPCLTY": "08", "PRVDR_STATE_CD": "01"})
    stay = {"DESYNPUF_ID": "A", "PROVIDER_ID": "0001", "CLM_FROM_DT": "20240101",
            "CLM_THRU_DT": "20240105", "CLM_DRG_CD": "065"}
    land(folder, "inpatient_claims", "15",
         {**stay, "CLM_ID": "i1", "CLM_PMT_AMT": "9000.126"},
         {**stay, "CLM_ID": "i2", "CLM_PMT_AMT": "-50"},
         {**stay, "CLM_ID": "i3", "DESYNPUF_ID": "B"},
         {**stay, "CLM_ID": "i1", "CLM_PMT_AMT": "9000.126"})
    land(folder, "outpatient_claims", "15",
         {"CLM_ID": "o1", "DESYNPUF_ID": "B", "CLM_FROM_DT": "20240615", "CLM_THRU_DT": "20240615",
          "CLM_PMT_AMT": "700", "NCH_CARR_CLM_SBMTD_CHRG_AMT": "900"},
         {"CLM_ID": "o2", "DESYNPUF_ID": "Z", "CLM_FROM_DT": "bad", "CLM_PMT_AMT": "100"})
    land(folder, "carrier_claims", "15",
         {"CLM_ID": "k1", "CLM_FROM_DT": "20240615", "LINE_PRCSG_IND_CD": "A", "LINE_SRVC_CNT": "2"})
    land(folder, "prescription_drug_events", "15",
         {"PDE_ID": "r1", "SRVC_DT": "20240615", "GNN": "metformin", "TOT_RX_CST_AMT": "10.50",
          "PROD_SRVC_ID": "00093721401", "DAYS_SUPLY_NUM": "30"})
    return str(folder)


@pytest.fixture(scope="module")
def lake(spark, landing, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    claims.run(spark, landing, folder, F.to_date(F.lit("2024-06-15")))
    return readers.open_lake(spark, claims=folder)


def test_codes_keep_their_zeros(lake):
    assert {r.state_code for r in lake["dim_provider_cms"].collect()} == {"01"}
    assert lake["fact_prescriptions"].first().drug_code == "00093721401"
    assert {r.drg_code for r in lake["fact_claims"].where("claim_type = 'inpatient'").collect()} == {"065"}


def test_patients(lake):
    rows = {r.patient_id: r for r in lake["dim_patient_cms"].collect()}
    assert len(rows) == 2 and lake["dim_patient_cms"].count() == 2
    assert (rows["A"].age, rows["A"].risk_score, rows["A"].risk_tier, rows["A"].is_chronic) == (
        74, 4, "Medium", True
    )
    assert (rows["B"].missing_birth_date_flag, rows["B"].is_deceased, rows["B"].gender_label) == (
        True, True, "Male"
    )


def test_claims(lake):
    rows = {r.claim_id: r for r in lake["fact_claims"].collect()}
    assert set(rows) == {"i1", "i2", "i3", "o1", "o2"}
    assert rows["i1"].payment_amount == Decimal("9000.13") and rows["i1"].length_of_stay == 4
    assert rows["i2"].payment_amount == Decimal("0.00")
    assert (rows["i3"].payment_amount, rows["i3"].is_payment_missing) == (Decimal("0.00"), True)
    assert rows["o1"].drg_code is None and rows["o1"].deductible_amount == Decimal("0.00")
    assert rows["o2"].admit_date is None and rows["o2"].year is None
    assert rows["o1"].date_key == 20240615 and not any(r.is_high_cost for r in rows.values())


def test_tables_have_their_fixed_types(lake):
    for name, frame in lake.items():
        assert frame.schema == schemas.WAREHOUSE[name]


def test_high_cost_patients(lake):
    rows = marts.high_cost_patients(lake).collect()
    assert [(r.patient_id, r.total_claims, str(r.total_spend), str(r.avg_claim_cost)) for r in rows] == [
        ("A", 2, "9000.13", "4500.07"), ("B", 2, "700.00", "350.00")
    ]


def test_age_groups_in_order(spark):
    frame = spark.createDataFrame(
        [("65+", 1, True), ("0-17", 2, False), (None, 3, None), ("18-34", 3, True)],
        "age_group string, risk_score int, is_chronic boolean",
    )
    rows = marts.patient_age_group({"dim_patient_cms": frame}).collect()
    assert [(r.age_group, r.chronic_count) for r in rows] == [
        ("0-17", 0), ("18-34", 1), ("65+", 1), ("Unknown", 0)
    ]


def test_payment_buckets_in_order(spark):
    frame = spark.sql(
        "SELECT cast(x AS decimal(12,2)) AS payment_amount FROM VALUES (10000), (499.99), (500), (4999), (5000), (null) t(x)"
    )
    rows = marts.payment_buckets({"fact_claims": frame}).collect()
    assert [(r.payment_bucket, r.claim_count) for r in rows] == [
        ("< $500", 1), ("$500 – $2K", 1), ("$2K – $5K", 1), ("$5K – $10K", 1), ("> $10K", 1)
    ]


def test_chronic_split_counts_unknown_as_other(spark):
    frame = spark.createDataFrame(
        [(True, "p1", "a"), (None, "p1", "b"), (False, "p2", None)],
        "is_chronic_med boolean, patient_ref string, drug_name string",
    )
    rows = {r.med_type: r for r in marts.medication_chronic_split({"fact_medications": frame}).collect()}
    assert tuple(rows["Acute / Other"])[1:] == (2, 2, 1)
    assert tuple(rows["Chronic"])[1:] == (1, 1, 1)


def test_top_k_is_not_a_full_sort(lake):
    plan = marts.top_drugs(lake)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_claims_are_summed_before_the_join(lake):
    plan = marts.high_cost_patients(lake)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [patient_id" in plan.split("Join Inner")[1]


def test_partition_filter_prunes_folders(lake):
    frame = lake["fact_claims"].where("year = 2024 AND claim_type = 'inpatient'").select("claim_id")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(year" in scan
    assert "ReadSchema: struct<claim_id:string>" in scan


def test_samples_and_names(lake):
    frame = marts.sample_rows(lake, "fact_claims")
    assert frame.count() == 5
    profile = {r.column_name for r in marts.sample_null_profile(lake, "fact_claims").collect()}
    assert "drg_code" in profile and "claim_id" not in profile
    assert len(marts.MARTS) == 19


def test_file_listing(spark, lake, tmp_path):
    write_table(spark.range(5), str(tmp_path / "t"))
    files = readers.list_files(spark, str(tmp_path / "t")).collect()
    assert files and all(f.file_size > 0 and f.file_path.endswith(".parquet") for f in files)


def test_wrong_headers_are_refused(spark, tmp_path):
    place = tmp_path / "year=2024" / "month=06" / "day=15"
    place.mkdir(parents=True)
    (place / "diagnosis_codes_1.csv").write_text("DGNS_CD,WRONG,DGNS_CATEGORY,CODE_SYSTEM\na,b,c,d\n")
    frame = readers.read_raw_entity(spark, str(tmp_path), "diagnosis_codes")
    with pytest.raises(Exception, match="CSV header"):
        frame.collect()


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        frame = spark.range(0, 60_000, 1, 8).select(F.lit("hot").alias("tier"), F.sha2(F.col("id").cast("string"), 256))
        write_table(frame.toDF("tier", "h"), str(tmp_path / "t"), ["tier"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "tier=hot").glob("*.parquet"))) > 1


def test_stage_reads_back_the_same_rows(spark):
    frame = spark.createDataFrame([(1, "01", None), (2, "02", True)], "a int, b string, c boolean")
    staged = stage(frame, "test", ["b"])
    assert staged.schema == frame.schema
    assert sorted(map(tuple, staged.select("a", "b", "c").collect())) == [(1, "01", None), (2, "02", True)]


def test_one_patient_with_a_third_of_all_claims(spark):
    claims_ = spark.range(3000).select(
        F.col("id").cast("string").alias("claim_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 200)).alias("patient_id"),
        (F.col("id") % 1000).cast("decimal(12,2)").alias("payment_amount"),
    )
    patients = claims_.select("patient_id").distinct().select(
        "patient_id", F.lit("65+").alias("age_group"), F.lit(None).cast("string").alias("gender_label"),
        F.lit(None).cast("int").alias("risk_score"),
    )
    rows = marts.high_cost_patients({"fact_claims": claims_, "dim_patient_cms": patients}).collect()
    spend = {}
    for i in range(3000):
        spend.setdefault("hot" if i % 3 == 0 else f"p{i % 200}", []).append(i % 1000)
    want = sorted(spend.items(), key=lambda item: (-sum(item[1]), item[0]))[:20]
    assert [(r.patient_id, r.total_claims, int(r.total_spend)) for r in rows] == [
        (name, len(paid), sum(paid)) for name, paid in want
    ]
    assert (rows[0].gender_label, rows[0].risk_tier, rows[0].risk_score) == ("Unknown", "High", 0)
