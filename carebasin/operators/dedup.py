"""One row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin.operators.packing import pack, text_runs, unpack


def one_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()
) -> DataFrame:
    """Keep the first row of each key.

    ``order_by`` names the wanted survivor; all other columns break ties, so a
    recomputed task picks the same row again. The filter on the row number lets
    Spark cut each key to one row per map task before the shuffle, so that a
    key with very many copies does not grow one task. Runs of text columns that
    only break ties are shuffled and sorted as one text, which keeps their order.
    """
    # a wanted order may name any column, so it is left as it is
    runs = [[name] for name in df.columns] if order_by else text_runs(df, set(keys))
    packed = pack(df, runs)
    ties = [
        F.col(f"`{f.name}`")
        for f in packed.schema
        if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    ranking = Window.partitionBy(*keys).orderBy(*order_by, *ties, F.lit(0))
    kept = (
        packed.withColumn("_row_of_key", F.row_number().over(ranking))
        .where(F.col("_row_of_key") == 1)
        .drop("_row_of_key")
    )
    return unpack(kept, runs)
