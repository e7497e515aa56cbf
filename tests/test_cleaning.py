"""Raw files to clean facts over several runs."""

import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.operators.quantile import exact_quantile, quantile_of_counts, unit_counts
from carebasin.plans import claims
from carebasin.sources import versions
from carebasin.sources.readers import read_raw_entity
from carebasin.streaming import cleaning

ENTITY = "prescription_drug_events"
NAMES = {c.clean: c.raw for c in schemas.RAW_ENTITIES[ENTITY]}


def land(spark, landing, day, number, rows):
    """Rows ``(prescription_id, service_date, total_cost)`` as one landed file."""
    records = spark.createDataFrame(rows, "prescription_id string, service_date string, total_cost string")
    columns = [F.col(n).alias(r) if n in records.columns else F.lit("1").alias(r) for n, r in NAMES.items()]
    path = f"{landing}/year=2024/month=06/day={day:02d}/{ENTITY}_{number:04d}.csv"
    records.select(columns).coalesce(1).write.option("header", True).csv(path)


@pytest.fixture
def job(tmp_path):
    return cleaning.Cleaning("fact_prescriptions", str(tmp_path / "landing"), str(tmp_path / "clean"), str(tmp_path / "checkpoint"))


def full(spark, job):
    built = claims.build_prescriptions(read_raw_entity(spark, job.landing, ENTITY))
    return in_order(built)


def in_order(df):
    columns = sorted(c for c in df.columns)
    return sorted((tuple(str(v) for v in r) for r in df.select(columns).collect()))


def files(job):
    return {str(p): p.stat().st_mtime_ns for p in Path(job.root).rglob("*.parquet")}


def held(spark, job, month):
    folders = versions.latest(spark, job.root).partitions("rows")
    return {k: v for k, v in folders.items() if k.endswith(f"month={month}")}


def test_late_repeated_and_changed_records_equal_one_build(spark, job):
    first = [(f"p{k}", f"2023{k % 3 + 1:02d}05", f"{k}.50") for k in range(60)] + [("bad", "not a date", "x"), (None, None, None)]
    land(spark, job.landing, 1, 1, first)
    cleaning.run_cleaning(spark, job)
    assert in_order(cleaning.read_fact(spark, job)) == full(spark, job)
    # a repeated file, a late record, a version that moves a claim to another month, one that loses
    land(spark, job.landing, 2, 1, first)
    land(spark, job.landing, 2, 2, [("late", "20200107", "-5"), ("p3", "20220909", "9000"), ("p4", "20991231", "1"), ("p4", "20991231", "1")])
    cleaning.run_cleaning(spark, job)
    assert in_order(cleaning.read_fact(spark, job)) == full(spark, job)
    land(spark, job.landing, 3, 1, [(f"q{k}", "20230305", f"{1000 + k}") for k in range(40)])
    cleaning.run_cleaning(spark, job)
    cleaning.run_cleaning(spark, job)
    rows = cleaning.read_fact(spark, job)
    assert in_order(rows) == full(spark, job)
    assert rows.where("is_high_cost").count() == 1 and rows.where("prescription_id = 'p3'").first().year == 2022


def test_versions_of_a_batch_and_of_the_table_meet_in_one_step(spark, job, monkeypatch):
    steps, inner = [], cleaning.one_per_key
    monkeypatch.setattr(cleaning, "one_per_key", lambda df, keys: (steps.append(df.columns), inner(df, keys))[1])
    land(spark, job.landing, 1, 1, [("a", "20230101", "1"), ("a", "20230201", "0"), ("b", "20230301", "2")])
    cleaning.run_cleaning(spark, job)
    land(spark, job.landing, 2, 1, [("b", "20230401", "0"), ("b", "20230201", "5"), ("a", "20221201", "3"), ("a", "20230601", "3")])
    cleaning.run_cleaning(spark, job)
    assert in_order(cleaning.read_fact(spark, job)) == full(spark, job)
    assert len(steps) == 2 and not any({"year", "month"} & set(columns) for columns in steps)


def test_repeated_files_are_dropped_by_state(spark, job, monkeypatch):
    sizes, merge = [], cleaning.merge_batch
    monkeypatch.setattr(cleaning, "merge_batch", lambda job, batch, n: (sizes.append(batch.count()), merge(job, batch, n)))
    for day in (1, 2, 3):
        land(spark, job.landing, day, 1, [("a", "20230101", "1"), ("b", "20230201", "2")])
        cleaning.run_cleaning(spark, job)
    assert sum(sizes) == 2


def test_only_touched_partitions_are_written(spark, job):
    land(spark, job.landing, 1, 1, [("a", "20230101", "1"), ("b", "20230201", "2"), ("c", "20230301", "3")])
    cleaning.run_cleaning(spark, job)
    before, old = files(job), held(spark, job, 2)
    land(spark, job.landing, 2, 1, [("late", "20230115", "7")])
    cleaning.run_cleaning(spark, job)
    after = files(job)
    assert {p: after[p] for p in before} == before
    assert {p.rsplit("/", 2)[1] for p in after.keys() - before.keys() if "/rows/" in p} == {"month=1"}
    assert held(spark, job, 2) == old and held(spark, job, 1).values() != old.values()
    # an older version of a claim in another month makes that month touched as well
    land(spark, job.landing, 3, 1, [("c", "20230201", "0")])
    cleaning.run_cleaning(spark, job)
    new = files(job).keys() - after.keys()
    assert {p.rsplit("/", 2)[1] for p in new if "/rows/" in p} == {"month=2"}
    assert versions.latest(spark, job.root).partitions("rows").keys() == {"year=2023/month=1", "year=2023/month=2"}
    assert in_order(cleaning.read_fact(spark, job)) == full(spark, job)


def test_replayed_and_interrupted_batches(spark, job, monkeypatch):
    land(spark, job.landing, 1, 1, [("a", "20230101", "1"), ("b", "20230201", "2")])
    cleaning.run_cleaning(spark, job)
    land(spark, job.landing, 2, 1, [("c", "20230101", "3"), ("a", "20230301", "0")])
    publish = versions.publish

    def fails(*_):
        raise OSError("gone before the manifest")

    monkeypatch.setattr(versions, "publish", fails)
    with pytest.raises(Exception, match="gone before the manifest"):
        cleaning.run_cleaning(spark, job)
    monkeypatch.setattr(versions, "publish", publish)
    # nothing of the lost batch is seen, and its replay gives the whole
    assert sorted(r.prescription_id for r in cleaning.read_fact(spark, job).collect()) == ["a", "b"]
    cleaning.run_cleaning(spark, job)
    assert in_order(cleaning.read_fact(spark, job)) == full(spark, job)
    newest = versions.latest(spark, job.root)
    again = job.fact.rows(read_raw_entity(spark, job.landing, ENTITY).where(F.col(NAMES["prescription_id"]) != "b"))
    cleaning.merge_batch(job, again, newest.number)
    assert in_order(cleaning.read_fact(spark, job)) == full(spark, job)


def test_old_versions_are_retired(spark, job):
    for day in (1, 2, 3):
        land(spark, job.landing, day, 1, [(f"x{day}", "20230101", f"{day}"), (f"y{day}", f"2023{day:02d}01", "5")])
        cleaning.run_cleaning(spark, job)
    before = in_order(cleaning.read_fact(spark, job))
    count = len(files(job))
    versions.retire(spark, job.root, keep=1)
    assert in_order(cleaning.read_fact(spark, job)) == before == full(spark, job)
    assert len(files(job)) < count and len(list(Path(job.root, "manifest").glob("*.json"))) == 1


def test_counts_give_the_exact_quantile(spark):
    values = [Decimal(k * k % 9_999_991 - 5000) / 100 for k in range(3000)] + [Decimal("3000000.01"), None]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(12,2)")
    parts = [unit_counts(df.where(F.pmod(F.xxhash64("v"), F.lit(3)) == k), "v") for k in range(3)]
    counts = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("slot", "unit").agg(F.sum("n").alias("n"))
    for fraction in (0.0, 0.01, 0.5, 0.99, 1.0):
        expected = exact_quantile(df, "v", fraction).first().threshold
        assert quantile_of_counts(counts, fraction, df.schema["v"].dataType).first().threshold == expected
    assert quantile_of_counts(counts.limit(0), 0.5, df.schema["v"].dataType).first().threshold is None


def test_partition_folders():
    assert versions.folder_of([2023, None], ["year", "kind"]) == f"year=2023/kind={versions.NO_VALUE}"
    with pytest.raises(ValueError):
        versions.folder_of(["a/b"], ["kind"])
    base = versions.Version(1, {"rows": {"m=1": 0, "m=2": 1}})
    after = versions.succeeding(base, 2, {"rows": (["m=1", "m=2"], ["m=2"]), "amounts": ([], ["slot=0"])})
    assert json.loads(json.dumps(after.tables)) == {"rows": {"m=2": 2}, "amounts": {"slot=0": 2}} and base.partitions("rows")["m=1"] == 0
