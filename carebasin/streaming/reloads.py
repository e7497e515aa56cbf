"""Truncate or reload the tables of feeds in one step.

Each table has generations, ``<root>/<table>/g=<number>/`` with its rows, its ledger, its
quarantine and the checkpoint of its feed. A manifest names the generation of every
table; a new one takes effect in one rename, for all its tables together, and puts
rows, ledger and checkpoint in place at once. Until then readers see the tables as
they were, also if a reload fails half way: what it wrote is removed by the next one.

Run one truncation or reload of a root at a time. Empty and missing tables read as
no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession

from carebasin.sources import versions
from carebasin.sources.writers import matching_folders, remove_folder
from carebasin.streaming import feeds
from carebasin.streaming.feeds import Feed

#: Entry of a table in the manifest.
GENERATION = "generation"


@dataclass(frozen=True)
class Warehouse:
    """Feeds by table. Their target, ledger, quarantine and checkpoint are placed below
    ``root``; all else of them stays."""

    root: str
    feeds: Mapping[str, Feed]

    def base(self, table: str, generation: int) -> str:
        return f"{self.root}/{table}/g={generation}"

    def placed(self, table: str, generation: int) -> Feed:
        base, feed = self.base(table, generation), self.feeds[table]
        return replace(
            feed, target=f"{base}/rows", ledger=f"{base}/ledger", checkpoint=f"{base}/checkpoint",
            quarantine=f"{base}/quarantine" if feed.quarantine else None,
        )


def current(spark: SparkSession, house: Warehouse) -> dict[str, Feed]:
    """The feed of each table's current generation. Ask anew after a reload."""
    version = versions.latest(spark, house.root)
    return {table: house.placed(table, version.partitions(table).get(GENERATION, 0)) for table in house.feeds}


def load(spark: SparkSession, house: Warehouse, tables: Iterable[str] | None = None) -> None:
    """Load the files that wait for the current generations."""
    placed = current(spark, house)
    feeds.run_feeds(spark, [placed[t] for t in _named(house, tables)])


def truncate(spark: SparkSession, house: Warehouse, tables: Iterable[str] | None = None) -> None:
    """Empty the tables together. The next load reads all their files again."""
    _renew(spark, house, _named(house, tables), fill=False)


def reload(spark: SparkSession, house: Warehouse, tables: Iterable[str] | None = None) -> None:
    """Load all files of the tables from scratch and replace what was there, together.
    If a feed fails, ``FeedErrors`` is raised and every table stays as it was."""
    _renew(spark, house, _named(house, tables), fill=True)


def rows(spark: SparkSession, house: Warehouse, table: str) -> DataFrame:
    """The table's current rows. The frame goes on reading this generation."""
    feed = current(spark, house)[table]
    if not matching_folders(spark, f"{feed.target}/load_run=*"):
        return spark.createDataFrame([], feed.schema)
    return feeds.loaded_rows(spark, feed)


def history(spark: SparkSession, house: Warehouse, since: Column | None = None) -> DataFrame:
    """Files of the current generations, as ``feeds.load_history`` gives them."""
    ledgers = [f.ledger for f in current(spark, house).values() if matching_folders(spark, f.ledger)]
    found = [feeds.load_history(spark, ledger, since=since) for ledger in ledgers]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], feeds.LEDGER)


def retire(spark: SparkSession, house: Warehouse, keep: int = 1) -> None:
    """Remove generations that none of the newest ``keep`` manifests names, and older
    manifests. Readers of those must have ended."""
    numbers = versions.numbers(spark, house.root)
    if not numbers:
        return
    kept = [versions.latest(spark, house.root, before=n + 1) for n in numbers[-keep:]]
    for number in numbers[:-keep]:
        remove_folder(spark, f"{house.root}/manifest/{number}.json")
    for table in house.feeds:
        used = {version.partitions(table).get(GENERATION, 0) for version in kept}
        for path in matching_folders(spark, f"{house.root}/{table}/g=*"):
            generation = int(path.rsplit("=", 1)[1])
            # later ones belong to a reload that is under way
            if generation not in used and generation <= numbers[-1]:
                remove_folder(spark, path)


def _named(house: Warehouse, tables: Iterable[str] | None) -> list[str]:
    named = list(house.feeds) if tables is None else list(tables)
    unknown = set(named) - set(house.feeds)
    if unknown:
        raise KeyError(f"no feed of {sorted(unknown)}")
    return named


def _renew(spark: SparkSession, house: Warehouse, tables: list[str], fill: bool) -> None:
    base = versions.latest(spark, house.root)
    number = max(base.number, 0) + 1  # tables without a manifest are at generation 0
    before = current(spark, house)
    for table in tables:
        remove_folder(spark, house.base(table, number))  # of an attempt that failed
    if fill:
        feeds.run_feeds(spark, [house.placed(table, number) for table in tables])
    held = {t: dict(entry) for t, entry in base.tables.items()}
    held.update({table: {GENERATION: number} for table in tables})
    versions.publish(spark, house.root, versions.Version(number, held))
    # feeds that keep running would load into the generations that are replaced
    replaced = {f"feed_{t}_{before[t].load_run}" for t in tables}
    for query in spark.streams.active:
        if query.name in replaced:
            query.stop()
