"""Amount cleaning and high-cost flags."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebasin.functions import columns as fx
from carebasin.operators.conform import change_present
from carebasin.operators.quantile import approximate_quantile, exact_quantile

# Fixed value: the threshold of a frame without amounts.
NO_THRESHOLD = Decimal("999999.00")


def fill_missing_amounts(df: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """Flag missing payments, then replace NULL amounts by 0.00."""
    if "payment_amount" in df.columns:
        df = df.withColumn("is_payment_missing", F.col("payment_amount").isNull())
    nothing = F.lit(0).cast("decimal(12,2)")
    return change_present(df, {name: lambda c: F.coalesce(c, nothing) for name in amounts})


def clean_amounts(
    df: DataFrame,
    amounts: Sequence[str],
    fraction: float = 0.99,
    method: str = "exact",
    threshold: float | Column | None = None,
) -> DataFrame:
    """Flag and clip negative amounts, round the rest, flag high costs.

    The threshold is the fraction's quantile of the first column before
    clipping, as a scalar subquery inside the same lazy plan. Pass a number or
    column to use a known threshold (for instance in a stream). Without the
    first column the frame is returned as it is.
    """
    primary = amounts[0]
    if primary not in df.columns:
        return df
    if threshold is None:
        quantile = {"exact": exact_quantile, "approx": approximate_quantile}[method]
        threshold = quantile(df, primary, fraction).scalar()
    elif not isinstance(threshold, Column):
        threshold = F.lit(threshold)

    present = [name for name in amounts if name in df.columns]
    nothing = F.lit(0).cast("decimal(12,2)")
    negative = {f"is_negative_{name}": F.col(name) < 0 for name in present}
    clipped = {
        name: F.when(F.col(name) < 0, nothing).otherwise(fx.to_money(F.col(name)))
        for name in present
    }
    limit = F.coalesce(threshold, F.lit(NO_THRESHOLD))
    return (
        df.withColumns({**negative, **clipped})
        .withColumn("is_high_cost", F.col(primary) > limit)
    )
