"""Bundles to the nine clinical tables over several runs."""

import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_documents import FIRST, SECOND

from carebasin import schemas
from carebasin.operators.documents import explode_entries
from carebasin.plans import clinical
from carebasin.sources import versions
from carebasin.sources.readers import read_bundles
from carebasin.streaming import bundles

AS_OF = "2024-06-30"


def land(job, number, entries):
    bundle = {"resourceType": "Bundle", "id": f"b{number}", "timestamp": "2024-01-01", "type": "batch",
              "entry": [{"resource": r} for r in entries]}
    place = Path(job.landing) / "fhir"
    place.mkdir(parents=True, exist_ok=True)
    (place / f"bundle{number}.json").write_text(json.dumps(bundle, indent=2))


def practitioner(key, number, family):
    return {"resourceType": "Practitioner", "id": key, "identifier": [{"value": number}], "name": [{"family": family}]}


@pytest.fixture
def job(tmp_path):
    return bundles.BundleStream(
        str(tmp_path / "landing"), str(tmp_path / "clean"), str(tmp_path / "checkpoint"), as_of=F.to_date(F.lit(AS_OF))
    )


def in_order(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def streamed(spark, job):
    version = versions.latest(spark, job.root)
    return {n: in_order(bundles.read_clinical(spark, job, n, version)) for n in schemas.CLINICAL_LAKE}


def built(spark, job):
    tables = clinical.build_all(explode_entries(read_bundles(spark, job.landing)), job.as_of)
    return {n: in_order(df.select(schemas.WAREHOUSE[n].names)) for n, df in tables.items()}


def test_runs_equal_one_build_and_folders_stay_few(spark, job):
    job = replace(job, fan_in=2)
    arrivals = [FIRST, SECOND + [practitioner("p9", "77", "B")], [practitioner("p8", "77", "A"), practitioner("p7", None, "C")], FIRST, []]
    for number, entries in enumerate(arrivals):
        land(job, number, entries)
        bundles.run_bundles(spark, job)
    bundles.run_bundles(spark, job)
    assert streamed(spark, job) == built(spark, job)
    newest = versions.latest(spark, job.root)
    assert newest.number == 3  # the bundle without entries makes no version
    # four batches with a fan of two: one folder of level 2
    assert set(newest.partitions("fact_observations")) == {"merge_level=2/load_batch=3"}
    npis = [r.npi for r in bundles.read_clinical(spark, job, "dim_provider_ehr").collect()]
    assert len(npis) == len(set(npis)) and "77" in npis


def test_a_stop_between_two_tables_leaves_none_ahead(spark, job, monkeypatch):
    land(job, 0, FIRST)
    bundles.run_bundles(spark, job)
    before, write = streamed(spark, job), bundles.write_table
    assert before == built(spark, job)
    land(job, 1, SECOND + [practitioner("p9", "77", "B")])

    def fails(df, path, *args):
        if "/fact_medications/" in path:
            raise OSError("stopped between two tables")
        write(df, path, *args)

    monkeypatch.setattr(bundles, "write_table", fails)
    with pytest.raises(Exception, match="stopped between two tables"):
        bundles.run_bundles(spark, job)
    # some tables have rows of the batch on disk; no reader sees them
    assert Path(job.root, "fact_encounters", "v=1").exists() and streamed(spark, job) == before
    monkeypatch.setattr(bundles, "write_table", write)
    bundles.run_bundles(spark, job)
    assert streamed(spark, job) == built(spark, job)
    # a batch that is replayed after its manifest gives the same tables
    bundles.load_batch(job, read_bundles(spark, f"{job.landing}/fhir/bundle1.json"), 1)
    assert streamed(spark, job) == built(spark, job)


def test_only_reached_provider_folders_are_written(spark, job):
    land(job, 0, [practitioner(f"p{k}", str(k), "A") for k in range(200)])
    bundles.run_bundles(spark, job)
    land(job, 1, [practitioner("q", "3", "0")])
    bundles.run_bundles(spark, job)
    held = versions.latest(spark, job.root).partitions("dim_provider_ehr")
    assert sorted(held.values()).count(1) == 1 and len(held) == bundles.BUCKETS
    versions.retire(spark, job.root, keep=1)
    assert streamed(spark, job) == built(spark, job)
