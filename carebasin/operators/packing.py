"""Runs of text columns as one text, for shuffles of wide rows.

A row with dozens of short or absent texts spends most of its bytes on their places
and lengths. Packed, they take less than two thirds of it in a shuffle. Packed
texts compare as their columns do one after another, NULLs first, and every text
comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text columns in a row that are packed: fewer gain little.
SHORTEST = 4
#: Fields are joined by ``END``; an absent text is nothing and an empty one ``EMPTY``. In other
#: texts these two characters become pairs, in an order that keeps the texts'.
END, EMPTY = "\x00", "\x01"
ESCAPED = ((EMPTY, "\x01\x02"), (END, "\x01\x01"))


def text_runs(df: DataFrame, besides: set[str]) -> list[list[str]]:
    """The columns in order: texts that follow each other together, all others alone."""
    runs: list[list[str]] = []
    open_run = False
    for field in df.schema:
        # texts with a collation compare by other rules than their bytes
        text = field.dataType == T.StringType() and field.name not in besides
        if text and open_run:
            runs[-1].append(field.name)
        else:
            runs.append([field.name])
        open_run = text
    return [part for run in runs for part in ([run] if len(run) >= SHORTEST else [[c] for c in run])]


def _field(text: Column) -> Column:
    escaped = text
    for plain, pair in ESCAPED:
        escaped = F.replace(escaped, F.lit(plain), F.lit(pair))
    return F.when(text == "", F.lit(EMPTY)).when(text.contains(END) | text.contains(EMPTY), escaped).otherwise(text)


def _text(field: Column) -> Column:
    text = field
    for plain, pair in reversed(ESCAPED):
        text = F.replace(text, F.lit(pair), F.lit(plain))
    return (
        F.when(field == "", F.lit(None).cast("string"))
        .when(~field.contains(EMPTY), field)
        .when(field == EMPTY, F.lit(""))
        .otherwise(text)
    )


def pack(df: DataFrame, runs: list[list[str]]) -> DataFrame:
    """Each run of several columns as one column; they have new names."""
    return df.select([
        F.array_join(F.transform(F.array(*[F.col(f"`{c}`") for c in run]), _field), END, "").alias(f"_run_{i}")
        if len(run) > 1 else F.col(f"`{run[0]}`")
        for i, run in enumerate(runs)
    ])


def unpack(df: DataFrame, runs: list[list[str]]) -> DataFrame:
    """The columns as they were before ``pack``."""
    # cut once, in a step of its own, for all columns of the run
    cut = {
        f"_run_{i}": F.transform(F.split(F.col(f"_run_{i}"), END, -1), _text)
        for i, run in enumerate(runs) if len(run) > 1
    }
    cells = []
    for i, run in enumerate(runs):
        if len(run) == 1:
            cells.append(F.col(f"`{run[0]}`"))
        else:
            cells += [F.get(F.col(f"_run_{i}"), F.lit(k)).alias(name) for k, name in enumerate(run)]
    return (df.withColumns(cut) if cut else df).select(cells)
