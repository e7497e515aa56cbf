"""Raw claim files to clean facts, as they arrive.

A stream reads the landed files of a fact's entities. Records that were delivered
before are dropped by state (``dropDuplicatesWithinWatermark`` on business key and
content). The watermark follows the time of arrival, not the date of the claim: a
late record of an old claim must change its table, so it may not be dropped as late.
A record that is delivered again after ``HORIZON`` meets its own copy in the merge.

Each micro-batch is merged into a table of versions (``sources.versions``):

* Of all versions of a claim, in whatever batch they come, the first in the order of
  ``one_per_key`` stays. Only partitions that receive a record, or that hold an older
  version of a received claim, are read and written anew; to find the latter, the keys
  (one column) of the table are joined with those of the batch.
* The high-cost threshold is the quantile of all claims, so it moves with each
  batch. A histogram of the amounts is kept as a table beside the rows: the counts of
  the replaced partitions are taken off and those of the new ones added, for the slots
  of amounts that changed. No row is rewritten for a new threshold: ``read_fact``
  computes the flag from the histogram's quantile.
* Rows and histogram of a batch become visible by one manifest, named by the batch. A
  replayed batch starts from the same predecessor and replaces its own folders.

After any number of batches ``read_fact`` equals the build of all files at once.
Defined cases: empty batches make no version; records without a usable date are in
the partition of NULL; records without a key are one claim, as in the build.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carebasin import schemas
from carebasin.operators import claims
from carebasin.operators.dedup import one_per_key
from carebasin.operators.quantile import quantile_of_counts, unit_counts
from carebasin.plans.claims import FACTS, Fact
from carebasin.sources import versions
from carebasin.sources.readers import DAY_FOLDERS
from carebasin.sources.writers import stage, stages_removed

#: How long a delivered record is remembered by the stream.
HORIZON = "30 days"
COUNTS = T.StructType([T.StructField("slot", T.LongType()), T.StructField("unit", T.LongType()), T.StructField("n", T.LongType())])
HIGH = 0.99


@dataclass(frozen=True)
class Cleaning:
    """One fact's stream: ``table`` names it, ``root`` holds its versions."""

    table: str
    landing: str
    root: str
    checkpoint: str
    horizon: str = HORIZON
    files_per_batch: int | None = None

    @property
    def fact(self) -> Fact:
        return FACTS[self.table]

    @property
    def partition_by(self) -> list[str]:
        return schemas.CLAIMS_LAKE[self.table][1]


def start_cleaning(spark: SparkSession, job: Cleaning, keep_running: str | None = None) -> StreamingQuery:
    """Start cleaning. By default all waiting files are taken and the query ends;
    ``keep_running`` is a processing interval such as ``"1 minute"``."""

    def arriving(entity: str) -> DataFrame:
        reader = spark.readStream.schema(schemas.raw_schema(schemas.RAW_ENTITIES[entity]))
        reader = reader.option("header", True).option("enforceSchema", False)
        if job.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", job.files_per_batch)
        return reader.csv(f"{job.landing.rstrip('/')}/{DAY_FOLDERS}/{entity}_*.csv")

    rows = job.fact.rows(*map(arriving, job.fact.entities))
    content = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in rows.columns])
    fresh = (
        rows.withColumns({"_content": content, "_arrived": F.current_timestamp()})
        .withWatermark("_arrived", job.horizon)
        .dropDuplicatesWithinWatermark([job.fact.key, "_content"])
        .drop("_content", "_arrived")
    )
    trigger = {"processingTime": keep_running} if keep_running else {"availableNow": True}
    return (
        fresh.writeStream.foreachBatch(lambda batch, number: merge_batch(job, batch, number))
        .queryName(f"clean_{job.table}")
        .option("checkpointLocation", job.checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_cleaning(spark: SparkSession, job: Cleaning) -> None:
    """Clean all waiting files and return when done."""
    start_cleaning(spark, job).awaitTermination()


def merge_batch(job: Cleaning, batch: DataFrame, number: int) -> None:
    """Merge typed rows into the version before ``number`` and publish the next one."""
    spark, key, parts = batch.sparkSession, job.fact.key, job.partition_by
    with stages_removed(spark):
        # versions inside the batch meet in the merge, so that they are shuffled by key once
        incoming = stage(with_partitions(job, batch), "cleaning-batch", compression="zstd")
        touched = {versions.folder_of(r, parts) for r in incoming.select(*parts).distinct().collect()}
        if not touched:
            return
        base = versions.latest(spark, job.root, before=number)
        stored = versions.read_version(spark, job.root, "rows", base, incoming.schema)
        again = stored.select(key, *parts).alias("s").join(
            incoming.select(F.col(key).alias("k")), F.col(f"s.{key}").eqNullSafe(F.col("k")), "left_semi"
        )
        touched |= {versions.folder_of(r, parts) for r in again.select(*parts).distinct().collect()}

        old = versions.read_version(spark, job.root, "rows", base, incoming.schema, touched)
        # partitions of dates follow from the record again: they are not shuffled
        merged = with_partitions(job, one_per_key(old.unionByName(incoming).select(batch.columns), [key]))
        written = versions.write_partitions(merged, job.root, "rows", number, parts)
        new = versions.read_version(
            spark, job.root, "rows", versions.Version(number, {"rows": dict.fromkeys(written, number)}), incoming.schema
        )
        amount = job.fact.amount
        change = unit_counts(new, amount).unionByName(unit_counts(old, amount).withColumn("n", -F.col("n")))
        change = change.groupBy("slot", "unit").agg(F.sum("n").alias("n")).where("n <> 0")
        change = stage(change.select(*COUNTS.names), "cleaning-counts")
        slots = {versions.folder_of(r, ["slot"]) for r in change.select("slot").distinct().collect()}
        counts = versions.read_version(spark, job.root, "amounts", base, COUNTS, slots).unionByName(change)
        counts = counts.groupBy("slot", "unit").agg(F.sum("n").alias("n")).where("n > 0")
        filled = versions.write_partitions(counts, job.root, "amounts", number, ["slot"])
        versions.publish(
            spark, job.root, versions.succeeding(base, number, {"rows": (touched, written), "amounts": (slots, filled)})
        )


def with_partitions(job: Cleaning, rows: DataFrame) -> DataFrame:
    """Rows with the table's partition columns; those of dates follow from the record."""
    dated = claims.add_date_parts(rows, job.fact.day)
    return dated.select(*rows.columns, *[c for c in job.partition_by if c not in rows.columns])


def read_fact(spark: SparkSession, job: Cleaning, version: versions.Version | None = None) -> DataFrame:
    """The clean fact as of the newest (or a given) version."""
    version = version or versions.latest(spark, job.root)
    raw = [spark.createDataFrame([], schemas.raw_schema(schemas.RAW_ENTITIES[e])) for e in job.fact.entities]
    shape = job.fact.rows(*raw)
    rows = versions.read_version(spark, job.root, "rows", version, with_partitions(job, shape).schema)
    kind = rows.schema[job.fact.amount].dataType
    counts = versions.read_version(spark, job.root, "amounts", version, COUNTS)
    threshold = quantile_of_counts(counts, HIGH, kind).scalar()
    return job.fact.finished(rows.select(shape.columns), threshold=threshold)
