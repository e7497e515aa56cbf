"""Facts and clinical tables of files that arrive in three runs, beside the SQL of one full build."""

from __future__ import annotations

from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.plans.claims import FACTS
from carebasin.session import fresh_folder, setting
from carebasin.sources.writers import matching_folders, rename_folder, stage, stages_removed
from carebasin.streaming import bundles, cleaning
from checks import expected, standins
from checks.files import contents, contents_sql
from checks.registry import NULLABLE, add, check
from checks.tables import BUNDLES_PER_FILE, RECORDS_PER_FILE, _as_of, compact

RUNS = 3


def dealt(spark, sf_dir, entity):
    """An entity's raw records with the number of their ``part``, made once for all deliveries."""
    records = standins.raw(spark, sf_dir, entity).select([c.raw for c in schemas.RAW_ENTITIES[entity]])
    part = F.pmod(F.xxhash64(*records.columns), F.lit(RUNS))
    return stage(records.withColumn("part", part), "records", compression="zstd")


def cleaned(spark, sf_dir, table):
    """All raw records of a fact's entities, in three deliveries. Versions of one
    claim are spread over them, days late, and each delivery repeats the last one."""
    landing, base = fresh_folder(spark, "arriving"), fresh_folder(spark, "cleaning")
    job = cleaning.Cleaning(table, landing, f"{base}/{table}", f"{base}/checkpoint")
    with stages_removed(spark):
        records = {entity: dealt(spark, sf_dir, entity) for entity in FACTS[table].entities}
        for run in range(RUNS):
            for entity, rows in records.items():
                for again in {run, max(run - 1, 0)}:
                    place = f"{landing}/year=2024/month=06/day={15 + run}/{entity}_{again:04d}.csv"
                    part = rows.where(F.col("part") == again).drop("part")
                    compact(part.write, RECORDS_PER_FILE).option("header", True).csv(place)
            cleaning.run_cleaning(spark, job)
    return cleaning.read_fact(spark, job)


for _table in FACTS:
    _name = _table.removeprefix("fact_") + "_stream"
    NULLABLE[_name] = NULLABLE.get(_table, "")
    add(_name, lambda spark, sf_dir, table=_table: cleaned(spark, sf_dir, table), expected.table_sql(_table))


@check(" UNION ALL ".join(map(contents_sql, schemas.CLINICAL_LAKE)))
def clinical_stream(spark, sf_dir):
    """All bundles in three deliveries; each batch changes the nine tables together."""
    landing, base = fresh_folder(spark, "bundles"), fresh_folder(spark, "bundle-stream")
    job = bundles.BundleStream(landing, f"{base}/clinical", f"{base}/checkpoint", one_per_line=True, as_of=_as_of(), fan_in=2)
    waiting = f"{landing}/_waiting"  # a name that scans pass over
    text = standins.bundle_text(standins.bundles(spark, sf_dir))
    text = text.withColumn("run", F.pmod(F.xxhash64("value"), F.lit(RUNS)))
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", RUNS):  # else each task sorts its bundles by run
        compact(text.write.partitionBy("run"), BUNDLES_PER_FILE).text(waiting)
    for run in range(RUNS):
        for arrived in matching_folders(spark, f"{waiting}/run={run}"):
            rename_folder(spark, arrived, f"{landing}/run={run}")
        bundles.run_bundles(spark, job)
    return contents({name: bundles.read_clinical(spark, job, name) for name in schemas.CLINICAL_LAKE})
