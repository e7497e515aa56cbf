"""Tables that are truncated or loaded again in one step."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_feeds import PROVIDERS, feed, providers  # noqa: F401  (a fixture)

from carebasin.sources.writers import write_table
from carebasin.streaming import feeds, reloads

TABLE = "dim_provider_cms"


@pytest.fixture
def house(feed, tmp_path):  # noqa: F811
    other = replace(feed, table="other", source=f"{feed.source}-other")
    return reloads.Warehouse(str(tmp_path / "house"), {TABLE: feed, "other": other})


def arrive(spark, house, table, *ids, mode="append"):
    write_table(providers(spark, *ids), house.feeds[table].source, ["state_code"], mode=mode)


def ids(spark, house, table=TABLE):
    return sorted(int(r.provider_id) for r in reloads.rows(spark, house, table).collect())


def test_a_failed_reload_leaves_all_tables_as_they_were(spark, house):
    for table in house.feeds:
        arrive(spark, house, table, 1, 2)
    reloads.load(spark, house)
    arrive(spark, house, TABLE, 3, 4, mode="overwrite")
    broken = Path(house.feeds["other"].source) / "state_code=01" / "part-x.parquet"
    broken.parent.mkdir(exist_ok=True)
    broken.write_bytes(b"PAR1 no footer")
    with pytest.raises(feeds.FeedErrors) as error:
        reloads.reload(spark, house)
    assert list(error.value.failures) == ["other"]
    assert ids(spark, house) == ids(spark, house, "other") == [1, 2]
    arrive(spark, house, "other", 5, mode="overwrite")
    reloads.reload(spark, house)  # nothing of the failed attempt is left
    assert (ids(spark, house), ids(spark, house, "other")) == ([3, 4], [5])
    history = reloads.history(spark, house)
    assert dict(history.groupBy("table_name").agg(F.sum("row_count")).collect()) == {TABLE: 2, "other": 1}
    arrive(spark, house, TABLE, 6)
    reloads.load(spark, house)  # the new checkpoint knows what the reload has read
    assert ids(spark, house) == [3, 4, 6]


def test_readers_keep_their_generation_until_it_is_retired(spark, house):
    arrive(spark, house, TABLE, 1)
    reloads.load(spark, house, [TABLE])
    before = reloads.rows(spark, house, TABLE)
    arrive(spark, house, TABLE, 2, 3, mode="overwrite")
    reloads.reload(spark, house, [TABLE])
    assert (before.count(), ids(spark, house)) == (1, [2, 3])
    reloads.retire(spark, house)
    reloads.reload(spark, house, [TABLE])
    reloads.retire(spark, house)
    kept = [p.name for p in (Path(house.root) / TABLE).iterdir()]
    assert (kept, ids(spark, house)) == (["g=2"], [2, 3])
    assert [p.name for p in (Path(house.root) / "manifest").glob("*.json")] == ["2.json"]


def test_truncated_tables_load_all_files_again(spark, house):
    assert reloads.rows(spark, house, "other").schema == PROVIDERS and not ids(spark, house, "other")
    arrive(spark, house, TABLE, 1, 2)
    reloads.load(spark, house, [TABLE])
    reloads.truncate(spark, house)
    assert ids(spark, house) == [] and reloads.history(spark, house).count() == 0
    reloads.load(spark, house, [TABLE])
    assert ids(spark, house) == [1, 2]
    with pytest.raises(KeyError):
        reloads.reload(spark, house, ["none"])


def test_a_running_feed_of_a_replaced_generation_is_stopped(spark, house):
    arrive(spark, house, TABLE, 1)
    query = feeds.start_feed(spark, reloads.current(spark, house)[TABLE], keep_running="1 second")
    query.processAllAvailable()
    reloads.reload(spark, house, [TABLE])
    assert not query.isActive and ids(spark, house) == [1]
