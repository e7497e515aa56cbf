"""Quantile thresholds as lazy one-row frames."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS_PER_STEP = 6
INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def approximate_quantile(
    df: DataFrame, column: str, fraction: float, accuracy: int = 10_000
) -> DataFrame:
    """One row, one column: a value whose rank error is at most 1/accuracy."""
    return df.agg(F.percentile_approx(column, fraction, accuracy).alias("threshold"))


def exact_quantile(df: DataFrame, column: str, fraction: float) -> DataFrame:
    """One row, one column: the smallest value at or above the fraction's rank.

    The built-in exact percentile keeps every distinct value in one task. Here
    the rank is narrowed down by digits instead: count rows per slot of a
    million units, find the slot of the wanted rank, then count single units
    inside it. Each step is a map-side combined count whose result has at most
    about two million rows, however many rows the input has.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        digits, scale = kind.precision, kind.scale
        units = (F.col(column) * F.lit(10**scale)).cast("bigint")
    elif type(kind) in INTEGRAL_DIGITS:
        digits, scale = INTEGRAL_DIGITS[type(kind)], 0
        units = F.col(column).cast("bigint")
    else:
        raise ValueError(f"{column}: exact quantiles need an integer or decimal(<=18) column")

    values = df.where(F.col(column).isNotNull()).select(units.alias("units"))
    widths = [10**power for power in range(0, digits, DIGITS_PER_STEP)][::-1]
    everything = F.sum("n").over(Window.partitionBy())
    rank = F.ceil(F.lit(Decimal(str(fraction))) * everything).cast("bigint")
    place = _place_of_rank(
        values.groupBy(_slot(widths[0])).agg(F.count(F.lit(1)).alias("n"))
        .select("slot", "n", F.lit(0).alias("before"), F.greatest(rank, F.lit(1)).alias("rank"))
    )
    for outer, width in zip(widths, widths[1:]):
        # A global aggregate has one row, so this side is always safe to broadcast.
        inside = values.withColumn("outer", _slot(outer)).join(
            F.broadcast(place.withColumnRenamed("slot", "outer")), "outer"
        )
        place = _place_of_rank(
            inside.groupBy(_slot(width), "before", "rank").agg(F.count(F.lit(1)).alias("n"))
        )
    value = F.col("slot").cast("decimal(20,0)") / F.lit(Decimal(10**scale))
    return place.select(value.cast(kind).alias("threshold"))


SLOT = 10**DIGITS_PER_STEP


def unit_counts(df: DataFrame, column: str) -> DataFrame:
    """``slot, unit, n``: how many rows have each value of a decimal column, in units of
    its last digit; a slot is a million units. Such counts can be added up."""
    scale = df.schema[column].dataType.scale
    units = (F.col(column) * F.lit(10**scale)).cast("bigint")
    found = df.where(F.col(column).isNotNull()).select(units.alias("units"))
    return found.groupBy(_slot(SLOT), F.col("units").alias("unit")).agg(F.count(F.lit(1)).alias("n"))


def quantile_of_counts(counts: DataFrame, fraction: float, kind: T.DecimalType) -> DataFrame:
    """The same one row as ``exact_quantile`` of the counted rows."""
    everything = F.sum("n").over(Window.partitionBy())
    rank = F.greatest(F.ceil(F.lit(Decimal(str(fraction))) * everything).cast("bigint"), F.lit(1))
    slots = counts.groupBy("slot").agg(F.sum("n").alias("n"))
    place = _place_of_rank(slots.select("slot", "n", F.lit(0).alias("before"), rank.alias("rank")))
    inside = counts.join(F.broadcast(place), "slot").select(F.col("unit").alias("slot"), "n", "before", "rank")
    value = F.col("slot").cast("decimal(20,0)") / F.lit(Decimal(10**kind.scale))
    return _place_of_rank(inside).select(value.cast(kind).alias("threshold"))


def _slot(width: int) -> Column:
    """Number of the slot: units divided by the width, rounded down. No step of it
    can leave the range of bigint."""
    if width == 1:
        return F.col("units").alias("slot")
    down = F.when(F.col("units") % F.lit(width) < 0, F.lit(1)).otherwise(F.lit(0))
    return (F.call_function("div", F.col("units"), F.lit(width)) - down).alias("slot")


def _place_of_rank(counts: DataFrame) -> DataFrame:
    """One row: the slot that holds the wanted rank, and the rows before it.

    The running sum has no partition key, but the digits bound its input.
    """
    reached = F.col("before") + F.sum("n").over(Window.orderBy("slot"))
    ranked = counts.withColumn("reached", reached).where(F.col("reached") >= F.col("rank"))
    first = F.struct("slot", (F.col("reached") - F.col("n")).alias("before"), "rank")
    return ranked.agg(F.min(first).alias("place")).select("place.*")
