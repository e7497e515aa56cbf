"""Databases and typed tables in the session catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin import schemas
from carebasin.operators.conform import align_by_name, unfit_values


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if it is absent, and make it the current one."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    spark.catalog.setCurrentDatabase(name)


def create_tables(
    spark: SparkSession, database: str, tables: dict[str, T.StructType] | None = None
) -> None:
    """Create the warehouse tables that are absent, with their fixed types."""
    for name, schema in (tables or schemas.WAREHOUSE).items():
        full = f"`{database}`.`{name}`"
        if not spark.catalog.tableExists(full):
            spark.catalog.createTable(full, source="parquet", schema=schema)


def load_table(df: DataFrame, table: str, strict: bool = False) -> None:
    """Append a frame to a table, matching columns by name in any case.

    Values that do not fit become NULL; ``strict`` counts them first and refuses
    the load if there are any. ``conform.unfit_values`` counts them per row.
    """
    schema = df.sparkSession.table(table).schema
    if strict:
        lost = df.agg(F.sum(unfit_values(df, schema))).first()[0] or 0
        if lost:
            raise ValueError(f"{lost} values do not fit the columns of {table}")
    align_by_name(df, schema).write.insertInto(table)


def list_tables(spark: SparkSession, database: str, like: str = "%") -> list[str]:
    """Table names that match a LIKE pattern, in any case."""
    return sorted(t.name for t in spark.catalog.listTables(database, _pattern(like)))


def list_databases(spark: SparkSession, like: str = "%") -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases(_pattern(like)))


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop a database with its tables; the default database becomes current."""
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def truncate_tables(spark: SparkSession, database: str, names: Iterable[str] | None = None) -> None:
    """Empty the tables before a full reload. Feeds need a new checkpoint then;
    ``streaming.reloads`` changes rows and checkpoints in one step."""
    for name in names or list_tables(spark, database):
        spark.sql(f"TRUNCATE TABLE `{database}`.`{name}`")


def _pattern(like: str) -> str:
    return like.replace("_", ".").replace("%", "*")
