"""Clean tables are written with few bytes shuffled."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin import schemas
from carebasin.functions import columns as fx
from carebasin.plans import lake
from carebasin.sources import writers
from carebasin.sources.colocated import write_colocated
from checks.measure import shuffled

PARTS = ("visit_year", "visit_month")


def encounters(spark, rows=20_000, tasks=8):
    df = spark.range(0, rows, 1, tasks).select(
        F.concat(F.lit("e"), "id").alias("encounter_id"), (F.col("id") % 5).cast("string").alias("status"),
        F.when(F.col("id") % 3 > 0, "").alias("encounter_class"), F.lit(None).cast("string").alias("patient_ref"),
        F.concat(F.lit("\x00\x01"), F.col("id") % 7).alias("note"),
        (F.col("id") % 2 + 2020).cast("int").alias("visit_year"), (F.col("id") % 12 + 1).cast("int").alias("visit_month"),
    )
    return df.select(fx.sha_key(F.col("encounter_id")).alias("encounter_key"), "*")


def moved(spark, act):
    listener = spark.sparkContext._jsc.sc().listenerBus()
    listener.waitUntilEmpty()
    before = set(shuffled(spark))
    act()
    listener.waitUntilEmpty()
    return sum(n for stage, n in shuffled(spark).items() if stage not in before)


def in_order(df, columns):
    return sorted(map(str, df.select(columns).collect()))


def files(path):
    return [str(p) for p in Path(path).rglob("*.parquet")]


def test_keys_are_computed_after_the_rows_are_gathered(spark, tmp_path):
    df = encounters(spark)
    plain = moved(spark, lambda: writers.write_table(df, str(tmp_path / "plain"), PARTS))
    clean = moved(spark, lambda: lake.write_clean("fact_encounters", df, str(tmp_path / "clean")))
    assert 0 < clean < plain / 3
    found = spark.read.schema(df.schema).parquet(str(tmp_path / "clean"))
    assert in_order(found, df.columns) == in_order(df, df.columns)
    assert len(files(tmp_path / "clean")) == 12 and all(".zstd." in f for f in files(tmp_path / "clean"))


def test_tables_with_enough_for_each_folder_are_not_shuffled(spark, tmp_path, monkeypatch):
    df = encounters(spark)
    source = writers.stage(df, "lake-test")
    monkeypatch.setattr(writers, "SIZEABLE", 10)
    built = source.select(df.columns)
    counted = moved(spark, lambda: built.select(*PARTS).distinct().count())
    assert moved(spark, lambda: lake.write_clean("fact_encounters", built, str(tmp_path / "own"), source)) <= 3 * counted
    assert in_order(spark.read.schema(df.schema).parquet(str(tmp_path / "own")), df.columns) == in_order(df, df.columns)
    # too many folders for what the tasks read: gathered
    monkeypatch.setattr(writers, "SIZEABLE", 20_000)
    lake.write_clean("fact_encounters", built, str(tmp_path / "gathered"), source)
    assert len(files(tmp_path / "gathered")) == 12
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_more_folders_than_open_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "OPEN_FILES", 3)
    df = encounters(spark, 3000)
    writers.write_table(df, str(tmp_path / "t"), PARTS, rebalance=False)
    assert in_order(spark.read.schema(df.schema).parquet(str(tmp_path / "t")), df.columns) == in_order(df, df.columns)


@pytest.mark.parametrize("uneven", [4.0, 0.0])
def test_keys_of_bucketed_tables_are_computed_after_the_rows_are_gathered(spark, tmp_path, uneven):
    df = encounters(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake_test LOCATION '{tmp_path}/db'")
    try:
        late = {"t": {"encounter_key": fx.sha_key(F.col("encounter_id"))}}
        write = lambda **more: write_colocated(spark, {"t": df}, "encounter_id", "lake_test", 5_000, uneven, **more)
        bytes_late = moved(spark, lambda: write(late=late))
        assert bytes_late < moved(spark, write) / 2
        assert write(late=late) == {"t": 4 if uneven else 0}
        assert in_order(spark.table("lake_test.t"), df.columns) == in_order(df, df.columns)
    finally:
        spark.sql("DROP DATABASE lake_test CASCADE")


def test_surrogates_name_columns_of_the_tables():
    assert schemas.SURROGATES.keys() == {**schemas.CLAIMS_LAKE, **schemas.CLINICAL_LAKE}.keys()
    for name, (key, business) in schemas.SURROGATES.items():
        assert {key, business} <= set(schemas.WAREHOUSE[name].names)
        assert schemas.WAREHOUSE[name][business].dataType == T.StringType()


def test_feeds_read_a_lake_that_is_written_once(spark, monkeypatch):
    from checks import files, tables
    from checks.compare import difference, engine

    def second_copy(*_):
        raise AssertionError("a table is written besides its folder of the lake")

    found, inner = {}, files.feeds.run_feeds
    monkeypatch.setattr(tables, "lake_table", second_copy)
    monkeypatch.setattr(files.feeds, "run_feeds", lambda spark, feeds: (found.update({f.table: f for f in feeds}), inner(spark, found.values())))
    sf_dir = "/root/testdata/sf0.001"
    assert difference(spark, engine(sf_dir), sf_dir, "all_feeds") is None
    assert len(found) == 14
    for feed in found.values():
        stored = files_of(feed.source) + files_of(feed.target)
        assert stored and all(".zstd." in f for f in stored)


def files_of(path):
    return files(path.removeprefix("file:"))
