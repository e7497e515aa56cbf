"""A part of the checked queries on the smallest data; all run in checks.compare."""

import os

import pytest
from pyspark.sql import functions as F

from checks import QUERIES, SQL, files
from checks.compare import difference, engine

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are absent")


@pytest.fixture(scope="module")
def connection():
    return engine(SF_DIR)


@pytest.mark.parametrize(
    "name",
    ["dim_patient_cms", "fact_claims", "fact_prescriptions", "dim_patient_ehr", "fact_conditions",
     "fact_encounters", "fact_medications", "high_cost_patients", "top_observations",
     "kpi_summary", "dedup_business_key", "clean_amounts", "catalog_tables"],
)
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_files_of_bundles_stay_small(spark, connection, monkeypatch):
    monkeypatch.setattr(files, "BUNDLES", 50, raising=False)
    found, inner = [], files.readers.read_bundles

    def read_bundles(spark, path, **options):
        bundles = inner(spark, path, **options)
        found.extend(bundles.groupBy(F.input_file_name()).count().collect())
        return bundles

    monkeypatch.setattr(files.readers, "read_bundles", read_bundles)
    assert difference(spark, connection, SF_DIR, "multi_line_bundles") is None
    assert found and max(r["count"] for r in found) <= 50


def test_a_difference_is_found(spark, connection, monkeypatch):
    wrong = SQL["surrogate_key"].replace("c_custkey AS VARCHAR", "c_custkey + 1 AS VARCHAR")
    monkeypatch.setitem(SQL, "surrogate_key", wrong)
    assert "rows against" in difference(spark, connection, SF_DIR, "surrogate_key")


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
