"""Files that cannot be read, and runs that have ended."""

import datetime as dt
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_feeds import feed, providers  # noqa: F401  (a fixture)

from carebasin.sources.writers import write_table
from carebasin.streaming import feeds, status


def arrive(spark, feed, *ids):
    """One file a provider."""
    for i in ids:
        write_table(providers(spark, i), feed.source, ["state_code"], mode="append")


def data_files(feed):
    return {str(p) for p in Path(feed.source).rglob("*.parquet")}


def loaded(spark, feed):
    return sorted(int(r.provider_id) for r in feeds.loaded_rows(spark, feed).collect())


def test_bad_files_are_recorded_and_the_rest_is_loaded(spark, feed, tmp_path):  # noqa: F811
    feed = replace(feed, quarantine=str(tmp_path / "quarantine"), files_per_batch=4)
    arrive(spark, feed, *range(1, 9))
    folder = Path(feed.source) / "state_code=01"
    (folder / "part-cut.parquet").write_bytes(b"PAR1 no footer")
    (folder / "part-empty.parquet").write_bytes(b"")
    feeds.run_feed(spark, feed)
    feeds.run_feed(spark, feed)
    assert loaded(spark, feed) == list(range(1, 9))
    assert {r.state_code for r in feeds.loaded_rows(spark, feed).collect()} == {"01", "02", "03"}
    bad = feeds.quarantined(spark, feed).collect()
    assert sorted(r.file_path.rsplit("/", 1)[1] for r in bad) == ["part-cut.parquet"]  # scans do not list empty files
    assert all(r.error and r.load_time and r.table_name == "dim_provider_cms" for r in bad)
    assert [r.file_size for r in bad] == [14]
    history = feeds.load_history(spark, feed.ledger, "dim_provider_cms")
    assert history.count() == history.agg(F.sum("row_count")).first()[0] == 8


def test_a_file_that_breaks_off_keeps_no_row(spark, feed, tmp_path):  # noqa: F811
    """The footer is whole, the last of the row groups is not."""
    feed = replace(feed, quarantine=str(tmp_path / "quarantine"))
    arrive(spark, feed, 1, 2)
    before = data_files(feed)
    rows = providers(spark, *range(100, 4100)).withColumn("npi", F.sha2("provider_id", 256)).where("state_code = '01'")
    wide = rows.coalesce(1).sortWithinPartitions("provider_id").write.mode("append").option("parquet.block.size", 4096)
    wide.option("parquet.page.size", 1024).option("parquet.page.size.row.check.min", 10).option(
        "parquet.block.size.row.check.min", 10).partitionBy("state_code").parquet(feed.source)
    (path,) = data_files(feed) - before
    content = bytearray(Path(path).read_bytes())
    middle = len(content) // 2
    content[middle: middle + 4000] = b"\xff" * 4000
    Path(path).write_bytes(bytes(content))
    for crc in Path(path).parent.glob("*.crc"):
        crc.unlink()
    feeds.run_feed(spark, feed)
    assert loaded(spark, feed) == [1, 2]
    (bad,) = feeds.quarantined(spark, feed).collect()
    assert bad.file_path.endswith(Path(path).name) and bad.error


def test_quarantine_without_bad_files(spark, feed, tmp_path):  # noqa: F811
    feed = replace(feed, quarantine=str(tmp_path / "quarantine"))
    assert feeds.quarantined(spark, feed).count() == 0
    arrive(spark, feed, 1, 2)
    feeds.run_feed(spark, feed)
    assert loaded(spark, feed) == [1, 2] and feeds.quarantined(spark, feed).count() == 0


def test_ended_and_failed_runs_can_be_queried(spark, feed, tmp_path):  # noqa: F811
    folder = str(tmp_path / "events")
    assert status.past_runs(spark, folder).count() == 0
    log = status.watch_feeds(spark, folder)
    try:
        arrive(spark, feed, 1, 2, 3)
        feeds.run_feed(spark, replace(feed, files_per_batch=1))
        broken = Path(feed.source) / "state_code=01" / "part-cut.parquet"
        broken.write_bytes(b"PAR1 no footer")
        with pytest.raises(Exception):
            feeds.run_feed(spark, feed)
        for _ in range(100):  # events follow their stream a moment later
            runs = status.past_runs(spark, folder).orderBy("first_event").collect()
            if [r.state for r in runs] == ["ended", "failed"] and runs[0].batches >= 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    done, failed = runs
    assert (done.state, done.batches, done.input_rows, done.error) == ("ended", 3, 3, None)
    assert failed.state == "failed" and "part-cut.parquet" in failed.error
    assert done.name == failed.name == f"feed_dim_provider_cms_{feed.load_run}"
    today = dt.datetime.now(dt.timezone.utc).date()
    tomorrow = today + dt.timedelta(days=1)
    assert status.past_runs(spark, folder, since=tomorrow).count() == 0
    status.remove_events(spark, folder, before=tomorrow)
    assert status.feed_events(spark, folder).count() == 0
