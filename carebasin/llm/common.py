"""Shared helpers: tables, keys, and whole texts as byte arrays inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The ASCII capitals and what they become; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words end at these characters only.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task turns into arrays at once; longer texts go alone.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(docs: DataFrame, *more: Column | str) -> DataFrame:
    """All columns of the caller in one struct ``row``, where no name can clash with
    those added; ``select("row.*")`` gives them back."""
    return docs.select(F.struct("*").alias("row"), *more)


def orderable(kind: T.DataType) -> bool:
    """Whether values of the type can be compared, at any depth."""
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def orderable_part(docs: DataFrame, row: str = "row") -> Column:
    """The columns of a packed row that can be compared, as a struct."""
    plain = [f.name for f in docs.schema if orderable(f.dataType)]
    return F.struct(*[F.col(row).getField(name) for name in plain], F.lit(0).alias("_"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is the empty text."""
    as_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % folds


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A 64-bit key of id and text. Rows that repeat both share it; null ids
    and null texts have keys of their own."""
    return F.xxhash64(
        F.col(doc_id).isNull(), F.col(doc_id).cast("string"), F.col(text).isNull(), F.col(text)
    )


#: Bins of counts for each doubling, in ``most_frequent``.
COUNT_BINS = 64


def most_frequent(counted: DataFrame, limit: int, count: str = "n") -> DataFrame:
    """Rows of the greatest counts, at most ``limit`` of them. Rows are told apart by
    bins of their count (one for each small count), and a bin comes whole or not at
    all: the bound is found from a few thousand bin sizes, so no task merges or
    sorts the rows. ``counted`` is read twice and should be written."""
    place = F.floor(F.log2(count) * COUNT_BINS)
    sizes = counted.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("rows")).where("place IS NOT NULL")
    taken, bound = 0, None
    for row in sorted(sizes.collect(), reverse=True):
        taken += row.rows
        if taken > limit:
            break
        bound = row.place
    return counted.where(F.lit(False) if bound is None else place >= bound)


class Texts:
    """Some rows of a batch: their texts as one byte array with offsets."""

    def __init__(self, batch: pa.RecordBatch, column: str):
        values = batch.column(column).cast(pa.large_string()).fill_null("")
        self.batch = batch
        buffers = values.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[values.offset: values.offset + len(values) + 1]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
        self.data = data[offsets[0]: offsets[-1]] if len(offsets) else data[:0]
        self.offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[Texts]:
    """Cut batches so that the texts of each piece hold about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(column).cast(pa.large_string()).fill_null("")
        ends = np.cumsum(np.asarray(pa.compute.binary_length(lengths), np.int64))
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield Texts(batch.slice(begin, end - begin), column)
            begin = end


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


#: A random 64-bit value for each byte, and an odd multiplier for its place.
BYTE_CODE = np.random.default_rng(20260101).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(count: int) -> np.ndarray:
    """1, s, s*s, ... of the step, modulo 2**64."""
    global _powers
    if len(_powers) < count:
        grown = np.full(max(count, 2 * len(_powers)), _STEP, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:count]


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def words(texts: Texts, lower: bool = True):
    """Words of every text: their starts and ends as byte places, their 64-bit
    hashes, and for each text the place of its first word (one more at the end)."""
    data, offsets = texts.data, texts.offsets
    inside = ~SPACE[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= inside[edges]
    closes[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    hashes = span_hashes(LOWERED[data] if lower else data, inside, starts, ends)
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def span_hashes(data, inside, starts, ends) -> np.ndarray:
    """64-bit hashes of the spans; ``inside`` marks exactly their bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    coded = BYTE_CODE[data[inside]] * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(coded, first) + lengths.astype(np.uint64) * _STEP)
