"""Tables of versions: partitions are replaced by new folders, never changed.

Below ``root`` each table has the folders ``<table>/v=<number>/<column>=<value>/…``, and
``manifest/<number>.json`` tells which folder holds each partition of each table. A
version is there once its manifest is; until then readers see the one before. A
version that is written again, after a failure, replaces its own folders and
starts from the same predecessor, so it gives the same tables.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin.sources.writers import matching_folders, remove_folder, rename_folder, write_table

#: Fixed value: the folder of a partition column that is NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    """Number of a version, and the version of each partition folder by table."""

    number: int = -1
    tables: dict[str, dict[str, int]] = field(default_factory=dict)

    def partitions(self, table: str) -> dict[str, int]:
        return self.tables.get(table, {})


def folder_of(values: Sequence, columns: Sequence[str]) -> str:
    """The folder of a partition. Values that Spark would escape are refused."""
    parts = []
    for name, value in zip(columns, values):
        text = NO_VALUE if value is None or value == "" else str(value)
        if not all(c.isalnum() or c in "_-. " for c in text):
            raise ValueError(f"{name} = {text!r} cannot name a partition")
        parts.append(f"{name}={text}")
    return "/".join(parts)


def latest(spark: SparkSession, root: str, before: int | None = None) -> Version:
    """The newest version (below ``before``), or an empty one."""
    found = {}
    for path in matching_folders(spark, f"{root}/manifest/*.json"):
        number = int(path.rsplit("/", 1)[1].removesuffix(".json"))
        if before is None or number < before:
            found[number] = path
    if not found:
        return Version()
    number = max(found)
    text = "\n".join(r.value for r in spark.read.text(found[number]).collect())
    return Version(number, json.loads(text))


def read_version(
    spark: SparkSession, root: str, table: str, version: Version, schema: T.StructType, only: Iterable[str] | None = None
) -> DataFrame:
    """The table's rows, or those of some partition folders ``only``."""
    held = version.partitions(table)
    wanted = held if only is None else held.keys() & set(only)
    paths = [f"{root}/{table}/v={held[folder]}/{folder}" for folder in sorted(wanted)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths).select(schema.names)


def write_partitions(df: DataFrame, root: str, table: str, number: int, partition_by: Sequence[str]) -> list[str]:
    """Write whole partitions of a version; the folders that have rows."""
    path = f"{root}/{table}/v={number}"
    write_table(df, path, partition_by, compression="zstd")
    written = df.sparkSession.read.schema(df.schema).parquet(path).select(*partition_by).distinct()
    return [folder_of(row, partition_by) for row in written.collect()]


def succeeding(base: Version, number: int, changes: dict[str, tuple[Iterable[str], Iterable[str]]]) -> Version:
    """``base`` with the replaced folders of each table gone and the written ones in."""
    tables = {name: dict(held) for name, held in base.tables.items()}
    for name, (replaced, written) in changes.items():
        held = tables.setdefault(name, {})
        for folder in replaced:
            held.pop(folder, None)
        held.update(dict.fromkeys(written, number))
    return Version(number, tables)


def publish(spark: SparkSession, root: str, version: Version) -> None:
    """Make a version the newest: its manifest takes its name in one step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    final, hidden = f"{root}/manifest/{version.number}.json", f"{root}/manifest/_{version.number}"
    place = hadoop.Path(hidden)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(json.dumps(version.tables, sort_keys=True).encode()))
    out.close()
    remove_folder(spark, final)
    rename_folder(spark, hidden, final)


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all versions, in order."""
    return sorted(int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in matching_folders(spark, f"{root}/manifest/*.json"))


def retire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove manifests but the newest ``keep``, and folders that none of those names.
    Readers of older versions must have ended."""
    found = numbers(spark, root)
    kept = [latest(spark, root, before=n + 1) for n in found[-keep:]]
    used = {f"{t}/v={v}/{folder}" for x in kept for t, held in x.tables.items() for folder, v in held.items()}
    for number in found[:-keep]:
        remove_folder(spark, f"{root}/manifest/{number}.json")
    for table in {t for x in kept for t in x.tables}:
        for path in matching_folders(spark, f"{root}/{table}/v=*"):
            name = f"{table}/{path.rsplit('/', 1)[1]}/"
            here = {folder.removeprefix(name) for folder in used if folder.startswith(name)}
            if not here:
                remove_folder(spark, path)
                continue
            depth = next(iter(here)).count("/") + 1
            for leaf in matching_folders(spark, f"{path}/" + "/".join(["*=*"] * depth)):
                if leaf.removeprefix(f"{path}/") not in here:
                    remove_folder(spark, leaf)
