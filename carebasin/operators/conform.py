"""Raw names and text to clean names and types; alignment by column name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin.functions import columns as fx
from carebasin.schemas import RawColumn

PARSERS: dict[str, Callable[[Column], Column]] = {
    "date": fx.text_to_day,
    "int": fx.text_to_int,
    "flag": fx.text_to_flag,
    "amount": fx.to_money,
    "price": lambda text: fx.to_money(text, 10),
}


def rename_columns(df: DataFrame, layout: tuple[RawColumn, ...]) -> DataFrame:
    """Raw to clean names, as one projection; absent columns are passed over."""
    return df.withColumnsRenamed({c.raw: c.clean for c in layout})


def cast_columns(df: DataFrame, *layouts: tuple[RawColumn, ...]) -> DataFrame:
    """Clean types for the typed columns that are present, as one projection."""
    kinds = {c.clean: c.kind for layout in layouts for c in layout if c.kind in PARSERS}
    return change_present(df, {name: PARSERS[kind] for name, kind in kinds.items()})


def change_present(df: DataFrame, changes: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Apply each change to its column if the frame has it."""
    present = {name: change(F.col(name)) for name, change in changes.items() if name in df.columns}
    return df.withColumns(present) if present else df


def tag(df: DataFrame, **values: str) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def stack(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name; a column absent on one side is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def align_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """Shape a frame like the target table.

    Names match in any case, types are cast (unusable values become NULL),
    target columns the frame lacks are NULL, extra columns are dropped.
    """
    held = {name.lower(): name for name in df.columns}

    def aligned(field: T.StructField) -> Column:
        source = held.get(field.name.lower())
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        if source is None or df.schema[source].dataType != field.dataType:
            value = value.try_cast(field.dataType)
        return value.alias(field.name)

    return df.select([aligned(field) for field in target])


def unfit_values(df: DataFrame, target: T.StructType) -> Column:
    """Number of the row's values that ``align_by_name`` makes NULL, as they do not
    fit their target type."""
    held = {name.lower(): name for name in df.columns}
    lost = F.lit(0)
    for field in target:
        source = held.get(field.name.lower())
        if source is not None and df.schema[source].dataType != field.dataType:
            value = F.col(f"`{source}`")
            unfit = value.isNotNull() & value.try_cast(field.dataType).isNull()
            lost = lost + unfit.cast("int")
    return lost
