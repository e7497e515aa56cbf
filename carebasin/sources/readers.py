"""Scans of raw files, clean tables and small fixed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin import schemas

DAY_FOLDERS = "year=*/month=*/day=*"


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType
) -> DataFrame:
    """Delimited text with a header row and a fixed schema: no inference pass."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(paths)


def read_raw_entity(spark: SparkSession, landing: str, entity: str) -> DataFrame:
    """All landed files of one raw entity: ``year=/month=/day=/<entity>_*.csv``.

    Every column is text. The folder dates are not added as columns.
    """
    schema = schemas.raw_schema(schemas.RAW_ENTITIES[entity])
    return read_delimited(spark, f"{landing.rstrip('/')}/{DAY_FOLDERS}/{entity}_*.csv", schema)


def read_bundles(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Document bundles below a folder, one row per bundle.

    By default each file holds one JSON object over several lines. Where many
    small bundles are compacted, ``one_per_line`` reads line-delimited files,
    which Spark can split.
    """
    return (
        spark.read.schema(schemas.BUNDLE)
        .option("multiLine", not one_per_line)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet table. Give the schema to keep the types of partition columns,
    which folder names alone would not tell (``01`` or ``true`` as text)."""
    if schema is None:
        return spark.read.parquet(path)
    # Spark puts partition columns last; the schema's order is restored.
    return spark.read.schema(schema).parquet(path).select(schema.names)


def open_lake(
    spark: SparkSession,
    claims: str | None = None,
    clinical: str | None = None,
    tables: Iterable[str] | None = None, whole: bool = False,
) -> dict[str, DataFrame]:
    """The clean tables below the claims and clinical folders, by table name.

    They have the warehouse's columns, or with ``whole`` all that the lake
    holds: the warehouse's first, then the others.
    """
    found = {}
    for root, layout in ((claims, schemas.CLAIMS_LAKE), (clinical, schemas.CLINICAL_LAKE)):
        for name, (prefix, _) in layout.items():
            if root is not None and (tables is None or name in tables):
                path = f"{root.rstrip('/')}/{prefix}"
                schema = schemas.WAREHOUSE[name]
                if whole:
                    held = spark.read.parquet(path).schema
                    schema = T.StructType([*schema, *(f for f in held if f.name not in schema.names)])
                found[name] = read_table(spark, path, schema)
    return found


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Path, size and time of the files below a folder, without reading them."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(
            F.col("path").alias("file_path"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("file_time"),
        )
    )


def inline_table(
    spark: SparkSession, rows: Sequence[tuple], columns: Mapping[str, str]
) -> DataFrame:
    """A small fixed table. Built from Arrow, so Spark knows its size."""
    fields = [T.StructField(name, schemas.TYPES[kind]) for name, kind in columns.items()]
    by_column = zip(*rows) if rows else ([] for _ in fields)
    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    arrays = [pa.array(list(v), kinds[k]) for v, k in zip(by_column, columns.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)), T.StructType(fields))
