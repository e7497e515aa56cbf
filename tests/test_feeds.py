from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.plans import marts
from carebasin.sources import catalog
from carebasin.sources.writers import matching_folders, rename_folder, write_table
from carebasin.streaming import feeds

PROVIDERS = schemas.WAREHOUSE["dim_provider_cms"]


def providers(spark, *ids):
    rows = [(i, f"key{i}", f"{i % 3 + 1:02d}", "extra") for i in ids]
    frame = spark.createDataFrame(rows, "n int, PROVIDER_KEY string, state_code string, unused string")
    return frame.withColumn("provider_id", F.col("n").cast("string")).drop("n")


@pytest.fixture
def feed(tmp_path):
    return feeds.lake_feeds(
        str(tmp_path / "claims"), str(tmp_path / "clinical"), str(tmp_path / "warehouse"),
        str(tmp_path / "checkpoints"),
    )["dim_provider_cms"]


def test_each_file_is_loaded_once(spark, feed):
    write_table(providers(spark, 1, 2, 3), feed.source, ["state_code"])
    feeds.run_feed(spark, feed)
    feeds.run_feed(spark, feed)
    assert feeds.loaded_rows(spark, feed).count() == 3
    write_table(providers(spark, 4, 5), feed.source, ["state_code"], mode="append")
    feeds.run_feed(spark, feed)
    rows = feeds.loaded_rows(spark, feed)
    assert rows.schema == PROVIDERS
    assert sorted((r.provider_id, r.state_code) for r in rows.collect()) == [
        ("1", "02"), ("2", "03"), ("3", "01"), ("4", "02"), ("5", "03")
    ]


def test_columns_match_in_any_case(spark, feed):
    write_table(providers(spark, 1), feed.source, ["state_code"])
    feeds.run_feed(spark, feed)
    row = feeds.loaded_rows(spark, feed).first()
    assert (row.provider_key, row.npi, row.state_code) == ("key1", None, "02")


def test_ledger_and_status(spark, feed):
    write_table(providers(spark, 1, 2, 3), feed.source, ["state_code"])
    feeds.run_feed(spark, replace(feed, files_per_batch=1))
    history = feeds.load_history(spark, feed.ledger, "dim_provider_cms")
    assert history.agg(F.sum("row_count")).first()[0] == 3
    assert history.select("file_path").distinct().count() == history.count() == 3
    assert history.select("load_batch").distinct().count() == 3
    later = F.current_timestamp() + F.expr("INTERVAL 1 HOUR")
    assert feeds.load_history(spark, feed.ledger, since=later).count() == 0
    assert feeds.load_history(spark, feed.ledger, "fact_claims").count() == 0
    status = feeds.feed_status(spark, feed.ledger).first()
    assert (status.table_name, status.files, status.row_count) == ("dim_provider_cms", 3, 3)
    assert feeds.running_feeds(spark) == []


def test_a_replayed_batch_replaces_itself(spark, feed):
    write_table(providers(spark, 1, 2, 3), feed.source, ["state_code"])
    feeds.run_feed(spark, feed)
    batch = spark.read.schema(feed.schema).parquet(feed.source).select(
        "*", feeds._source_file()
    )
    feeds._load_batch(feed, batch, 0)
    assert feeds.loaded_rows(spark, feed).count() == 3
    assert feeds.load_history(spark, feed.ledger).agg(F.sum("row_count")).first()[0] == 3


def test_a_new_checkpoint_is_a_new_load_run(spark, feed, tmp_path):
    write_table(providers(spark, 1), feed.source, ["state_code"])
    feeds.run_feed(spark, feed)
    write_table(providers(spark, 2), feed.source, ["state_code"])
    again = replace(feed, checkpoint=str(tmp_path / "checkpoints" / "second"))
    feeds.run_feed(spark, again)
    assert {r.provider_id for r in feeds.loaded_rows(spark, feed).collect()} == {"1", "2"}


def test_feeds_side_by_side_and_running(spark, tmp_path):
    all_feeds = feeds.lake_feeds(
        str(tmp_path / "claims"), str(tmp_path / "clinical"), str(tmp_path / "warehouse"),
        str(tmp_path / "checkpoints"),
    )
    assert set(all_feeds) == set(schemas.WAREHOUSE)
    chosen = [all_feeds["dim_provider_cms"], all_feeds["dim_provider_ehr"]]
    write_table(providers(spark, 1), chosen[0].source, ["state_code"])
    write_table(
        spark.sql("SELECT 'k' AS provider_key, '08' AS specialty_code"), chosen[1].source, ["specialty_code"]
    )
    feeds.run_feeds(spark, chosen)
    assert [feeds.loaded_rows(spark, f).count() for f in chosen] == [1, 1]
    query = feeds.start_feed(spark, chosen[0], keep_running="1 second")
    try:
        assert [f["name"] for f in feeds.running_feeds(spark)] == [f"feed_dim_provider_cms_{chosen[0].load_run}"]
    finally:
        query.stop()


@pytest.fixture
def database(spark):
    catalog.create_database(spark, "care_test")
    catalog.create_tables(spark, "care_test")
    yield "care_test"
    spark.catalog.setCurrentDatabase("default")
    spark.sql("DROP DATABASE care_test CASCADE")


def test_typed_tables(spark, database):
    catalog.create_database(spark, database)
    catalog.create_tables(spark, database)
    assert catalog.list_tables(spark, database) == sorted(schemas.WAREHOUSE)
    assert catalog.list_tables(spark, database, "%CMS%") == ["dim_patient_cms", "dim_provider_cms"]
    assert len(catalog.list_tables(spark, database, "fact_%")) == 10
    assert catalog.list_databases(spark, "care%") == ["care_test"]
    for name, schema in schemas.WAREHOUSE.items():
        assert spark.table(f"{database}.{name}").schema == schema


def test_load_query_and_truncate(spark, database):
    catalog.load_table(providers(spark, 1, 2), "dim_provider_cms")
    catalog.load_table(providers(spark, 3), "dim_provider_cms")
    assert spark.table("dim_provider_cms").count() == 3
    counts = {r.table_name: r.row_count for r in marts.run_query(spark, "table_row_counts").collect()}
    assert set(counts) == set(marts.COUNTED) and set(counts.values()) == {0}
    assert marts.run_query(spark, "kpi_summary").first().total_claims == 0
    assert marts.run_query(spark, "sample_fact_claims").count() == 0
    catalog.truncate_tables(spark, database, ["dim_provider_cms"])
    assert spark.table("dim_provider_cms").count() == 0


def test_unfit_values_are_counted_or_refused(spark, feed):
    schema = schemas.T.StructType.fromDDL("provider_key string, provider_id string, state_code string")
    text = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], schema)
    text.write.parquet(feed.source)
    narrow = schemas.T.StructType.fromDDL("provider_key string, provider_id int, state_code int")
    counted = replace(feed, schema=narrow, source_schema=schema)
    feeds.run_feed(spark, counted)
    assert feeds.feed_status(spark, feed.ledger).first().lost_values == 2
    refused = replace(counted, checkpoint=feed.checkpoint + "2", strict=True)
    with pytest.raises(feeds.FeedErrors) as found:
        feeds.run_feeds(spark, [refused])
    assert "2 values do not fit" in str(found.value)
    assert feeds.loaded_rows(spark, counted).count() == 2


def test_all_feeds_are_awaited_when_one_fails(spark, tmp_path):
    names = ("dim_provider_cms", "dim_provider_ehr")
    found = feeds.lake_feeds(*(str(tmp_path / n) for n in ("claims", "clinical", "warehouse", "checkpoints")))
    good, bad = (found[n] for n in names)
    write_table(providers(spark, 1), good.source, ["state_code"])
    with pytest.raises(feeds.FeedErrors) as error:
        feeds.run_feeds(spark, [bad, good])  # the folder of the first is absent
    assert set(error.value.failures) == {"dim_provider_ehr"}
    assert feeds.loaded_rows(spark, good).count() == 1


def test_compaction_keeps_rows_and_the_newest_batch(spark, feed):
    small = replace(feed, files_per_batch=1)
    for k in range(4):
        write_table(providers(spark, k, k + 10), feed.source, mode="append")
        feeds.run_feed(spark, small)
    rows = sorted(map(str, feeds.loaded_rows(spark, feed).collect()))
    batches = lambda: sorted(p.rsplit("=", 1)[1] for p in matching_folders(spark, f"{feed.target}/load_run=*/load_batch=*"))
    before = batches()
    assert len(before) >= 4
    feeds.compact_feed(spark, feed)
    newest = max(map(int, before))
    assert batches() == sorted([f"0-{newest - 1}", str(newest)])
    assert sorted(map(str, feeds.loaded_rows(spark, feed).collect())) == rows
    # what an interrupted compaction left is removed by the next one
    left = spark.read.parquet(f"{feed.target}/load_run={feed.load_run}/load_batch=0-{newest - 1}")
    left.limit(1).write.parquet(f"{feed.target}/load_run={feed.load_run}/load_batch=0")
    feeds.compact_feed(spark, feed)
    assert sorted(map(str, feeds.loaded_rows(spark, feed).collect())) == rows


def test_history_reads_only_the_days_it_needs(spark, feed):
    write_table(providers(spark, 1), feed.source, ["state_code"])
    feeds.run_feed(spark, feed)
    plan = feeds.load_history(spark, feed.ledger)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan
    later = F.current_timestamp() + F.expr("INTERVAL 3 DAYS")
    assert feeds.load_history(spark, feed.ledger, since=later).inputFiles() is not None


def test_a_batch_replayed_on_another_day_is_entered_once(spark, feed):
    write_table(providers(spark, 1, 2), feed.source, ["state_code"])
    feeds.run_feed(spark, feed)
    entry = matching_folders(spark, f"{feed.ledger}/table_name=*/load_date=*")[0]
    rename_folder(spark, entry, entry.rsplit("=", 1)[0] + "=2001-01-01")
    batch = spark.read.schema(feed.schema).parquet(feed.source).select("*", feeds._source_file())
    feeds._load_batch(feed, batch, 0)
    assert feeds.feed_status(spark, feed.ledger).first().row_count == 2


def test_strict_load_of_a_catalog_table(spark, database):
    schema = "patient_id string, risk_score string"
    rows = spark.createDataFrame([("p", "high"), ("q", "3")], schema)
    with pytest.raises(ValueError, match="1 values do not fit"):
        catalog.load_table(rows, "dim_patient_cms", strict=True)
    catalog.load_table(rows, "dim_patient_cms")
    assert marts.run_sql(spark, "SELECT max(risk_score) AS m FROM dim_patient_cms").first().m == 3
