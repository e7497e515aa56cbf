"""Files, catalog and feeds: everything goes out to the shared folder and back."""

from __future__ import annotations

import atexit
import time
import uuid
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin import schemas
from carebasin.operators import conform
from carebasin.operators.profile import row_counts
from carebasin.plans import claims, clinical
from carebasin.plans.lake import write_clean
from carebasin.session import fresh_folder
from carebasin.sources import catalog, readers
from carebasin.sources.writers import matching_folders, remove_folder, rename_folder, write_table
from carebasin.streaming import feeds, reloads, status
from checks import expected, standins
from checks.registry import check
from checks.standins import given
from checks.tables import Lake, _as_of, build, build_fact, compact, landed, landed_bundles, raw, resources, write_lake

@check(standins.raw_sql("inpatient_claims"))
def landed_csv_scan(spark, sf_dir):
    return raw(spark, sf_dir, "inpatient_claims")


_ORDER_SQL = """
    SELECT o_orderkey, o_totalprice, lpad(CAST(o_custkey % 7 AS VARCHAR), 2, '0') AS code,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderstatus = 'O' AS INTEGER) END AS is_open,
      CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders
"""


def _orders(spark, sf_dir):
    return given(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice",
        F.lpad((F.col("o_custkey") % 7).cast("string"), 2, "0").alias("code"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "O").alias("is_open"),
        F.year("o_orderdate").alias("year"),
    )


@check(_ORDER_SQL)
def partitioned_roundtrip(spark, sf_dir):
    orders, path = _orders(spark, sf_dir), fresh_folder(spark, "orders")
    write_table(orders, path, ["year", "code", "is_open"])
    return readers.read_table(spark, path, orders.schema)


@check(_ORDER_SQL.replace(
    "FROM orders", "FROM orders UNION ALL SELECT o_orderkey, o_totalprice + 1, "
    "lpad(CAST(o_custkey % 7 AS VARCHAR), 2, '0'), CAST(true AS INTEGER), 1 FROM orders WHERE "
    "o_orderstatus = 'F'"))
def partition_overwrite(spark, sf_dir):
    """Replace one partition and leave the others."""
    orders, path = _orders(spark, sf_dir), fresh_folder(spark, "orders")
    write_table(orders, path, ["year"])
    write_table(orders.withColumn("year", F.lit(1)), path, ["year"], only_written_partitions=True)
    replacement = given(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.lpad((F.col("o_custkey") % 7).cast("string"), 2, "0").alias("code"),
        F.lit(True).alias("is_open"), F.lit(1).alias("year"),
    )
    write_table(replacement, path, ["year"], only_written_partitions=True)
    return readers.read_table(spark, path, orders.schema)


@check("SELECT CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders GROUP BY 1")
def stage_listing(spark, sf_dir):
    """The partition folders of a written table, from its file list."""
    path = fresh_folder(spark, "orders")
    write_table(_orders(spark, sf_dir), path, ["year"])
    files = readers.list_files(spark, path).where(F.col("file_size") > 0)
    return files.select(F.regexp_extract("file_path", "year=([^/]*)/", 1).alias("year")).distinct()


ENTITIES = (
    "beneficiary_summary", "providers", "inpatient_claims", "outpatient_claims",
    "carrier_claims", "prescription_drug_events",
)

# -- whole jobs ---------------------------------------------------------------------


def _columns(name: str, kind: type) -> list[str]:
    return [f.name for f in schemas.WAREHOUSE[name] if isinstance(f.dataType, kind)]


def contents_sql(name: str) -> str:
    """Row count, a hash of all text columns and the sum of all amounts in cents."""
    text = ", ".join(f"coalesce({c}, '~')" for c in _columns(name, T.StringType))
    cents = " + ".join(f"coalesce(CAST(round({c} * 100) AS BIGINT), 0)" for c in _columns(name, T.DecimalType)) or "0"
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
        CAST(sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT) AS BIGINT) AS text_hash,
        CAST(sum({cents}) AS BIGINT) AS cents FROM ({expected.TABLE_SQL[name]}) t"""


def contents(tables):
    frames = []
    for name, df in tables.items():
        text = F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in _columns(name, T.StringType)])
        cents = F.lit(0)
        for c in _columns(name, T.DecimalType):
            cents = cents + F.coalesce(F.round(F.col(c) * 100).cast("bigint"), F.lit(0))
        frames.append(df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")).alias("text_hash"),
            F.sum(cents).cast("bigint").alias("cents"),
        ).select(F.lit(name).alias("table_name"), "*"))
    return conform.stack(*frames)


@check(" UNION ALL ".join(map(contents_sql, schemas.CLAIMS_LAKE)))
def claims_job(spark, sf_dir):
    """Landed files to five written tables."""
    for entity in ENTITIES:
        landing = landed(spark, sf_dir, entity)
    lake = fresh_folder(spark, "claims-lake")
    claims.run(spark, landing, lake, _as_of())
    return contents(readers.open_lake(spark, claims=lake))


@check(" UNION ALL ".join(map(contents_sql, schemas.CLINICAL_LAKE)))
def clinical_job(spark, sf_dir):
    """Bundle files to nine written tables."""
    landing, lake = landed_bundles(spark, sf_dir), fresh_folder(spark, "clinical-lake")
    clinical.run(spark, landing, lake, _as_of(), one_per_line=True)
    return contents(readers.open_lake(spark, clinical=lake))


@check(expected.table_sql("fact_claims"))
def all_lake_columns(spark, sf_dir):
    """All columns that the lake holds, not only the warehouse's."""
    lake = fresh_folder(spark, "claims-lake")
    df, source = build_fact(spark, sf_dir, "fact_claims")
    write_clean("fact_claims", df, f"{lake}/{schemas.CLAIMS_LAKE['fact_claims'][0]}", source)
    return readers.open_lake(spark, claims=lake, tables=["fact_claims"], whole=True)["fact_claims"]


#: Bundles in a file of several lines each.
BUNDLES = 1000


@check(expected.FLAT_ENCOUNTER)
def multi_line_bundles(spark, sf_dir):
    """Bundles in files of several lines each, read in the default form."""
    landing = fresh_folder(spark, "bundles")
    text = standins.bundle_text(standins.bundles(spark, sf_dir, per_file=BUNDLES))
    lines = text.select(F.regexp_replace("value", ",\"type\"", ",\n  \"type\"").alias("value"), "file")
    files = lines.groupBy("file").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("\n]")).alias("value"))
    compact(files.select("value").write, 1).text(f"{landing}/fhir")
    return clinical.flatten_encounters(clinical.stage_resources(readers.read_bundles(spark, landing)))


# -- catalog ---------------------------------------------------------------------------


@check(f"""
    SELECT 'dim_provider_cms' AS table_name, count(*) AS row_count
      FROM ({expected.TABLE_SQL['dim_provider_cms']}) a
    UNION ALL SELECT 'fact_encounters', count(*) FROM events
    UNION ALL SELECT 'fact_procedures', 0
""")
def catalog_tables(spark, sf_dir):
    """Typed tables in a database, loaded by column name, one truncated again."""
    database, current = f"check_{uuid.uuid4().hex[:12]}", spark.catalog.currentDatabase()
    catalog.create_database(spark, database, fresh_folder(spark, "database"))
    try:
        catalog.create_tables(spark, database)
        lake = Lake(spark, sf_dir)
        for name in ("dim_provider_cms", "fact_encounters"):
            catalog.load_table(lake[name], f"{database}.{name}")
        catalog.load_table(build(spark, sf_dir, "fact_procedures"), f"{database}.fact_procedures")
        catalog.truncate_tables(spark, database, ["fact_procedures"])
        wanted = set(catalog.list_tables(spark, database, "%PROVIDER_CMS")) | set(
            catalog.list_tables(spark, database, "fact_%")
        )
        shown = sorted(wanted & {"dim_provider_cms", "fact_encounters", "fact_procedures"})
        return row_counts({n: spark.table(f"{database}.{n}") for n in shown})
    finally:
        spark.catalog.setCurrentDatabase(current)
        atexit.register(_drop, spark, database)  # the frame that is returned still reads it


def _drop(spark, database: str) -> None:
    if spark.getActiveSession() is not None:
        catalog.drop_database(spark, database)


# -- feeds --------------------------------------------------------------------------------

def _feed(spark, sf_dir, files_per_batch=None) -> feeds.Feed:
    """A feed of encounters that has loaded two arrivals, the second one later."""
    source, base = fresh_folder(spark, "arrivals"), fresh_folder(spark, "feed")
    feed = feeds.Feed(
        "fact_encounters", source, f"{base}/fact_encounters", f"{base}/ledger",
        f"{base}/checkpoint", schemas.WAREHOUSE["fact_encounters"], files_per_batch=files_per_batch,
    )
    encounters = clinical.build_encounters(resources(spark, sf_dir))
    late = F.col("encounter_class") == "EMER"
    partition_by = schemas.CLINICAL_LAKE["fact_encounters"][1]
    write_table(encounters.where(~F.coalesce(late, F.lit(False))), source, partition_by)
    feeds.run_feed(spark, feed)
    write_table(encounters.where(late), source, partition_by, mode="append")
    feeds.run_feed(spark, feed)
    feeds.run_feed(spark, feed)
    return feed


@check(f"SELECT * FROM ({expected.table_sql('fact_encounters')}) t")
def stream_file_load(spark, sf_dir):
    """Each arrived file is loaded once, over three runs of one checkpoint; the
    batches are compacted in the end."""
    feed = _feed(spark, sf_dir, files_per_batch=2)
    feeds.compact_feed(spark, feed)
    return feeds.loaded_rows(spark, feed)


@check(f"""
    SELECT encounter_class, count(*) AS row_count, 1::BIGINT AS unreadable_files
    FROM ({expected.TABLE_SQL['fact_encounters']}) t GROUP BY 1
""")
def feed_quarantine(spark, sf_dir):
    """All files of a table beside one that is no Parquet file: the others are loaded whole."""
    source, base = fresh_folder(spark, "arrivals"), fresh_folder(spark, "feed")
    feed = feeds.Feed(
        "fact_encounters", source, f"{base}/fact_encounters", f"{base}/ledger", f"{base}/checkpoint",
        schemas.WAREHOUSE["fact_encounters"], quarantine=f"{base}/quarantine",
    )
    write_table(Lake(spark, sf_dir)["fact_encounters"], source, schemas.CLINICAL_LAKE["fact_encounters"][1])
    # text of the table in a file with the name of a Parquet file
    broken = fresh_folder(spark, "broken")
    given(spark, sf_dir, "events").select(F.col("event_id").cast("string")).coalesce(1).write.text(broken)
    folder = next(iter(matching_folders(spark, f"{source}/visit_year=*/visit_month=*")))
    rename_folder(spark, matching_folders(spark, f"{broken}/part-*")[0], f"{folder}/part-broken.parquet")
    feeds.run_feed(spark, feed)
    counts = feeds.loaded_rows(spark, feed).groupBy("encounter_class").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("unreadable_files", F.lit(feeds.quarantined(spark, feed).count()).cast("bigint"))


_RELOADED = f"SELECT encounter_class, count(*) AS row_count FROM ({expected.TABLE_SQL['fact_encounters']}) t"


@check(f"""
    SELECT 'loaded' AS state, * FROM ({_RELOADED} WHERE encounter_class IS DISTINCT FROM 'EMER' GROUP BY 1) a
    UNION ALL SELECT 'failed', * FROM ({_RELOADED} WHERE encounter_class IS DISTINCT FROM 'EMER' GROUP BY 1) b
    UNION ALL SELECT 'reloaded', * FROM ({_RELOADED} GROUP BY 1) c
""")
def feed_reload(spark, sf_dir):
    """A table before a reload, after one that fails at a broken file, and after one that succeeds."""
    source, root = fresh_folder(spark, "arrivals"), fresh_folder(spark, "reloads")
    feed = feeds.Feed("fact_encounters", source, "", "", "", schemas.WAREHOUSE["fact_encounters"])
    house = reloads.Warehouse(root, {"fact_encounters": feed})
    encounters, partition_by = Lake(spark, sf_dir)["fact_encounters"], schemas.CLINICAL_LAKE["fact_encounters"][1]

    def state(name):
        counts = reloads.rows(spark, house, "fact_encounters").groupBy("encounter_class")
        return counts.agg(F.count(F.lit(1)).alias("row_count")).withColumn("state", F.lit(name))

    write_table(encounters.where(~F.col("encounter_class").eqNullSafe("EMER")), source, partition_by)
    reloads.load(spark, house)
    states = [state("loaded")]
    write_table(encounters, source, partition_by)  # the prefix is built again, as a whole
    broken = f"{source}/visit_year=2000/visit_month=1"
    given(spark, sf_dir, "events").select(F.col("event_id").cast("string")).coalesce(1).write.text(broken)
    rename_folder(spark, matching_folders(spark, f"{broken}/part-*")[0], f"{broken}/part-broken.parquet")
    try:
        reloads.reload(spark, house)
        raise AssertionError("the broken file was loaded")
    except feeds.FeedErrors:
        states.append(state("failed"))
    remove_folder(spark, broken)
    reloads.reload(spark, house)
    states.append(state("reloaded"))
    return states[0].unionByName(states[1]).unionByName(states[2])


@check("SELECT 'fact_encounters' AS table_name, count(*)::BIGINT AS row_count FROM events")
def load_history(spark, sf_dir):
    history = feeds.load_history(spark, _feed(spark, sf_dir).ledger, "fact_encounters")
    return history.groupBy("table_name").agg(F.sum("row_count").alias("row_count"))


@check("SELECT 'fact_encounters' AS table_name, count(*)::BIGINT AS row_count, 0::BIGINT AS lost_values FROM events")
def feed_status(spark, sf_dir):
    status = feeds.feed_status(spark, _feed(spark, sf_dir).ledger)
    return status.where("files > 0 AND last_load_time IS NOT NULL AND last_batch >= 1").select(
        "table_name", "row_count", "lost_values"
    )


@check("SELECT 'ended' AS state, count(*)::BIGINT AS input_rows FROM events UNION ALL SELECT 'failed', 0")
def past_feed_runs(spark, sf_dir):
    """A feed that ended and one that failed, from what their runs wrote down."""
    folder = fresh_folder(spark, "feed-events")
    log = status.watch_feeds(spark, folder)
    try:
        feed = _feed(spark, sf_dir)
        broken = replace(feed, target=f"{feed.target}-strict", checkpoint=f"{feed.checkpoint}-strict", strict=True)
        dates = [T.StructField(f.name, T.DateType() if f.name == "encounter_class" else f.dataType) for f in feed.schema]
        broken = replace(broken, schema=T.StructType(dates), source_schema=feed.schema)
        try:
            feeds.run_feed(spark, broken)
        except Exception:  # the failure is what is recorded
            pass
        for _ in range(300):  # events follow their stream a moment later
            runs = status.past_runs(spark, folder)
            if sorted(r.state for r in runs.collect()) == ["ended"] * 3 + ["failed"]:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    return runs.groupBy("state").agg(F.sum("input_rows").alias("input_rows"))


@check(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM ({expected.TABLE_SQL[t]}) t" for t in expected.TABLE_SQL
))
def all_feeds(spark, sf_dir):
    """All fourteen tables, from the lake through their feeds."""
    lake, base = fresh_folder(spark, "lake"), fresh_folder(spark, "feeds")
    found = feeds.lake_feeds(f"{lake}/claims", f"{lake}/clinical", f"{base}/warehouse", f"{base}/checkpoints")
    for name, feed in found.items():
        write_lake(spark, sf_dir, name, feed.source)
    feeds.run_feeds(spark, found.values())
    return row_counts({name: feeds.loaded_rows(spark, feed) for name, feed in found.items()})
