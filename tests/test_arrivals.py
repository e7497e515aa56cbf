"""Landing and arrivals of the checks: derived once, by all cores."""

import os

import pytest
from pyspark.sql import functions as F

from checks import arrivals, standins
from checks.compare import difference, engine
from checks.measure import shuffled

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are absent")


@pytest.mark.parametrize("made", ["bundles", "carrier_claims", "inpatient_claims"])
def test_records_of_one_row_group_are_derived_by_all_cores(spark, made):
    rows = standins.bundles(spark, SF_DIR) if made == "bundles" else standins.raw(spark, SF_DIR, made)
    cores = spark.sparkContext.defaultParallelism
    held = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(held) >= cores and max(r["count"] for r in held) * cores < 1.5 * sum(r["count"] for r in held)


def test_large_tables_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(standins, "SMALL", 10)
    plan = standins.raw(spark, SF_DIR, "carrier_claims")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_claims_that_arrive_in_three_runs_are_derived_once(spark, monkeypatch):
    made, raw = [], standins.raw
    monkeypatch.setattr(arrivals.standins, "raw", lambda spark, sf_dir, entity: (made.append(entity), raw(spark, sf_dir, entity))[1])
    assert difference(spark, engine(SF_DIR), SF_DIR, "carrier_claims_stream") is None
    assert made == ["carrier_claims"]


def test_bundles_arrive_in_three_runs_of_one_derivation(spark, monkeypatch):
    landed, run = [], arrivals.bundles.run_bundles

    def run_bundles(spark, job):
        landed.append(spark.read.option("recursiveFileLookup", True).text(job.landing))
        assert landed[-1].count() > (landed[-2].count() if len(landed) > 1 else 0)
        run(spark, job)

    monkeypatch.setattr(arrivals.bundles, "run_bundles", run_bundles)
    frames = []
    monkeypatch.setattr(arrivals.standins, "bundle_text", lambda df, inner=standins.bundle_text: (frames.append(df), inner(df))[1])
    writes, compact = [], arrivals.compact
    monkeypatch.setattr(arrivals, "compact", lambda writer, records: (writes.append(writer), compact(writer, records))[1])
    assert difference(spark, engine(SF_DIR), SF_DIR, "clinical_stream") is None
    assert len(landed) == arrivals.RUNS and len(frames) == len(writes) == 1
    assert landed[-1].distinct().count() == standins.given(spark, SF_DIR, "events").count()


def test_multi_line_files_are_put_together_without_a_shuffle_of_their_text(spark, monkeypatch):
    from checks import files

    monkeypatch.setattr(files, "BUNDLES", 100)
    moved, paths, inner = [], [], files.readers.read_bundles

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return sum(shuffled(spark).values())

    def read_bundles(spark, path, **options):
        moved.append(written())
        paths.extend(r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect())
        return inner(spark, path, **options)

    monkeypatch.setattr(files.readers, "read_bundles", read_bundles)
    before = written()
    assert files.multi_line_bundles(spark, SF_DIR).count() == standins.given(spark, SF_DIR, "events").count()
    # events take less than 100 KB, and their bundles more than 10 MB
    assert moved[0] - before < 300_000
    assert len(paths) >= 10 and all(".gz" in p for p in paths if "/part-" in p)
