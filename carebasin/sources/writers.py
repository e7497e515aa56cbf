"""Partitioned Parquet writes and staged intermediates."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carebasin.operators.packing import pack, text_runs, unpack
from carebasin.session import fresh_folder, setting
from carebasin.sources.readers import read_table


#: Files that a task has open at once where rows are not gathered.
OPEN_FILES = 32


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    rebalance: bool = True,
    only_written_partitions: bool = False,
    spread: int = 1,
    compression: str = "zstd",
    late: Mapping[str, Column] | None = None,
) -> None:
    """Write a Parquet table, zstd-compressed unless told otherwise, in partition folders.

    ``rebalance`` gathers each partition's rows into files of the advisory
    size first. Adaptive execution splits a partition that holds much of the
    data over many tasks, so a few partition values do not mean few tasks.
    With ``spread`` the rows of a partition are dealt to as many files at least (or
    to as many as there are shuffle partitions), so that small data is read by
    many tasks as well. Columns ``late`` follow from others of their row: they are computed
    after the rows are gathered, and so not shuffled; the others are shuffled with runs of texts packed. Without ``rebalance`` each task writes its rows to
    the folders that they belong to, with a file open for each of up to ``OPEN_FILES`` folders; they
    are sorted only beyond that. ``only_written_partitions`` replaces just the partitions that occur in
    ``df`` and leaves the others.
    """
    columns, late = df.columns, {k: v for k, v in (late or {}).items() if rebalance and k in df.columns}
    df = df.drop(*late)
    runs = text_runs(df, set(partition_by)) if late else []
    if late:
        df = pack(df, runs)
    if rebalance and spread > 1:
        # rows are dealt by their content, so that a recomputed task deals them alike
        dealt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in partition_by]), F.lit(spread))
        df = df.withColumn("_dealt", dealt).hint("rebalance", *partition_by, "_dealt").drop("_dealt")
    elif rebalance:
        df = df.hint("rebalance", *partition_by)
    if late:
        df = unpack(df, runs).withColumns(late).select(columns)
    writer = df.write.mode(mode).option("compression", compression).option(
        "partitionOverwriteMode", "dynamic" if only_written_partitions else "static"
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rebalance:
        writer.parquet(path)
        return
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES):
        writer.parquet(path)


_kept: ContextVar[list[str] | None] = ContextVar("_kept", default=None)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system, wherever it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, through Spark's file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found or []]


def rename_folder(spark: SparkSession, old: str, new: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(old)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).rename(place, hadoop.Path(new)):
        raise OSError(f"{old} could not be renamed to {new}")


@contextmanager
def stages_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the folders staged inside, after success; a failed job keeps them
    for a retry or a look. Frames that read them must not outlive the block."""
    token = _kept.set([])
    try:
        yield
        for path in _kept.get():
            remove_folder(spark, path)
    finally:
        _kept.reset(token)


#: Bytes of its source that a task reads, at least, for its rows to be written where they are.
SIZEABLE = 1 << 20
#: Sizes from here on are Spark's word for an unknown one.
UNKNOWN = 1 << 62


def well_dealt(source: DataFrame, folders: int = 1) -> bool:
    """Whether the tasks that read ``source`` are enough for the cores and have enough to
    read each for files in so many ``folders``, so that files of each task's own neither are few nor small."""
    tasks = source.rdd.getNumPartitions()
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = source.sparkSession.sparkContext.defaultParallelism
    return 2 * tasks >= cores and SIZEABLE * tasks * folders <= size < UNKNOWN


def stage(
    df: DataFrame, label: str = "stage", partition_by: Sequence[str] = (), spread: int = 1, gather: bool = True,
    compression: str = "zstd",
) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Later steps read only the columns and partitions they need, and a lost
    executor does not bring back the work before this point. Rows of a
    partitioned stage are gathered by partition first: the number of files
    follows the size of the data (and ``spread``), not tasks times partitions.
    Without ``gather`` each task writes its own rows and none is shuffled.
    """
    path = fresh_folder(df.sparkSession, label)
    write_table(
        df, path, partition_by, rebalance=bool(partition_by) and gather, spread=spread, compression=compression
    )
    if _kept.get() is not None:
        _kept.get().append(path)
    return read_table(df.sparkSession, path, df.schema)
