"""Tables that are bucketed alike by a key, so that joins and groups on it need no shuffle.

A bucket is read by one task. So a table is bucketed only if its rows are spread: where
one bucket holds many more rows than the mean (a key with much of the data), the
table is written without buckets, and its queries shuffle as before, with
partial sums and adaptive splits.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carebasin.operators.packing import pack, text_runs, unpack

#: Rows that a bucket of the largest table should hold.
ROWS_PER_BUCKET = 5_000_000
#: Buckets at most: their counts pass through the driver.
MOST_BUCKETS = 1 << 16
#: How many times the mean a bucket may hold.
UNEVEN = 4.0


def bucket_of(key: str, buckets: int):
    """The bucket that Spark gives a row."""
    return F.pmod(F.hash(F.col(key)), F.lit(buckets))


def bucket_rows(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Rows of each bucket that has any, from the key's column alone."""
    counted = df.groupBy(bucket_of(key, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return [r.n for r in counted.collect()]


def write_colocated(
    spark: SparkSession, tables: Mapping[str, DataFrame], key: str, database: str,
    rows_per_bucket: int = ROWS_PER_BUCKET, uneven: float = UNEVEN,
    late: Mapping[str, Mapping[str, Column]] | None = None,
) -> dict[str, int]:
    """Write the tables to a database, bucketed by ``key`` into the same number of
    buckets; that number by table, 0 for those written without buckets.

    The number follows the largest table. Rows are gathered by bucket, and
    adaptive execution deals a large bucket to several tasks and files. Rows
    without a key are in one bucket. A table of up to ``rows_per_bucket`` rows in its
    largest bucket is bucketed however it is spread. Columns of a table that are ``late`` follow from
    others of their row: they are computed after the rows are gathered, which are shuffled with runs of texts packed. Tables that exist are replaced.
    """
    totals = {name: df.count() for name, df in tables.items()}
    largest = max(totals.values(), default=0)
    buckets = min(max(1, -(-largest // rows_per_bucket)), MOST_BUCKETS)
    made = {}
    for name, df in tables.items():
        most = max(bucket_rows(df, key, buckets), default=0)
        fits = most <= max(rows_per_bucket, uneven * totals[name] / buckets)
        after = dict((late or {}).get(name, {}))
        runs = text_runs(df.drop(*after), {key})
        packed = pack(df.drop(*after), runs)
        if fits:
            helper = f"{max(packed.columns, key=len)}_bucket"
            packed = packed.withColumn(helper, bucket_of(key, buckets)).hint("rebalance", helper).drop(helper)
        else:
            packed = packed.hint("rebalance")
        writer = unpack(packed, runs).withColumns(after).select(df.columns).write
        if fits:
            writer = writer.bucketBy(buckets, key)
        writer.format("parquet").option("compression", "zstd").mode("overwrite").saveAsTable(f"`{database}`.`{name}`")
        made[name] = buckets if fits else 0
    return made
