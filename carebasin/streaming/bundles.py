"""Clinical bundles to the nine clean tables, as they arrive.

One stream with one checkpoint reads the bundle files. Each micro-batch is exploded
once; the nine builds read its staged resources and write to new folders of a root of
versions (``sources.versions``). One manifest then publishes all nine tables together,
so that a batch that ends between two of them changes none, and its replay starts from
the same version and replaces its own folders.

* Rows of the patients and the facts are added. Each batch makes a folder of level 0
  in a table; ``fan_in`` folders of a level are written together as one of the next,
  within the batch that completes them, so a row is rewritten a few times (the logarithm
  of the number of batches) and readers meet few folders.
* Providers are one row a number (``npi``) over all batches. They lie in ``BUCKETS``
  folders by hash of the number; a batch rewrites only the folders that it reaches.

After any number of batches ``read_clinical`` equals one build of all bundles that came.
Ages are those of ``as_of``, by default of the day of arrival, since the birth date is
masked. Defined cases: batches without entries make no version; a bundle without entries
or with unreadable text adds nothing; a bundle that is landed again in another file counts
again, as in the build; providers without a number are one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carebasin import schemas
from carebasin.operators.dedup import one_per_key
from carebasin.plans import clinical
from carebasin.sources import versions
from carebasin.sources.writers import stage, stages_removed, write_table

#: Tables that keep one row per key over all batches.
KEYED = {"dim_provider_ehr": "npi"}
BUCKETS = 16


@dataclass(frozen=True)
class BundleStream:
    """The stream of a landing folder; ``root`` holds the versions of the nine tables."""

    landing: str
    root: str
    checkpoint: str
    one_per_line: bool = False
    files_per_batch: int | None = None
    as_of: Column | None = None
    lookup: DataFrame | None = None
    fan_in: int = 8


def start_bundles(spark: SparkSession, job: BundleStream, keep_running: str | None = None) -> StreamingQuery:
    """Start loading. By default all waiting files are taken and the query ends;
    ``keep_running`` is a processing interval such as ``"1 minute"``."""
    reader = spark.readStream.schema(schemas.BUNDLE)
    reader = reader.option("multiLine", not job.one_per_line).option("recursiveFileLookup", True)
    if job.files_per_batch:
        reader = reader.option("maxFilesPerTrigger", job.files_per_batch)
    trigger = {"processingTime": keep_running} if keep_running else {"availableNow": True}
    return (
        reader.json(job.landing)
        .writeStream.foreachBatch(lambda batch, number: load_batch(job, batch, number))
        .queryName("bundles")
        .option("checkpointLocation", job.checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_bundles(spark: SparkSession, job: BundleStream) -> None:
    """Load all waiting bundles and return when done."""
    start_bundles(spark, job).awaitTermination()


def load_batch(job: BundleStream, batch: DataFrame, number: int) -> None:
    """Add the bundles to the version before ``number`` and publish all tables at once."""
    spark = batch.sparkSession
    with stages_removed(spark):
        resources = clinical.stage_resources(batch)
        if resources.isEmpty():
            return
        base = versions.latest(spark, job.root, before=number)
        changes = {}
        for name, rows in clinical.build_all(resources, job.as_of, job.lookup).items():
            write = _merge if name in KEYED else _append
            changes[name] = write(job, base, number, name, rows)
        versions.publish(spark, job.root, versions.succeeding(base, number, changes))


def _append(job: BundleStream, base: versions.Version, number: int, name: str, rows: DataFrame):
    """The replaced and the written folders: a new one, with those that it completes."""
    level, gone = 0, []
    while True:
        same = [f for f in base.partitions(name) if f.startswith(f"merge_level={level}/")]
        if len(same) + 1 < job.fan_in:
            break
        gone, level = gone + same, level + 1
    if gone:
        old = versions.read_version(rows.sparkSession, job.root, name, base, rows.schema, gone)
        rows = rows.unionByName(old)
    folder = f"merge_level={level}/load_batch={number}"
    write_table(rows, f"{job.root}/{name}/v={number}/{folder}", schemas.CLINICAL_LAKE[name][1])
    return gone, [folder]


def _merge(job: BundleStream, base: versions.Version, number: int, name: str, rows: DataFrame):
    key, spark = KEYED[name], rows.sparkSession
    incoming = stage(rows.withColumn("key_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")), "bundle-keys")
    touched = [versions.folder_of(r, ["key_bucket"]) for r in incoming.select("key_bucket").distinct().collect()]
    old = versions.read_version(spark, job.root, name, base, incoming.schema, touched)
    # the bucket follows from the key: it breaks no tie
    merged = one_per_key(old.unionByName(incoming), [key])
    return touched, versions.write_partitions(merged, job.root, name, number, ["key_bucket"])


def read_clinical(
    spark: SparkSession, job: BundleStream, name: str, version: versions.Version | None = None
) -> DataFrame:
    """A clean table as of the newest (or a given) version. Give the same version for
    several tables to see them at one point in time."""
    version = version or versions.latest(spark, job.root)
    return versions.read_version(spark, job.root, name, version, T.StructType(schemas.WAREHOUSE[name].fields))
