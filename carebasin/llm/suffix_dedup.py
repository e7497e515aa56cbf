"""Remove byte strings that occur earlier, by a sparse suffix array.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in
a text of a smaller id, or earlier in the same text. Suffixes are taken at the
tokens of a content-defined cut, not at every byte: a token begins where the
hash of the next ``GRAM`` bytes is the least of a window, chosen so that every
string of ``LENGTH`` bytes holds a token start, at the same place wherever the
string occurs. That is one suffix in about 35 bytes.

1. Tokens whose leading bytes occur once are dropped (one shuffle of hashes).
2. The others' suffixes, with the bytes before them, are range-partitioned by
   their leading bytes at splitters sampled from the texts. Equal contexts of one
   task meet there first: only the earliest goes on, the rest are covered.
3. Buckets sort their suffixes by multikey quicksort, eight bytes at a time.
   Neighbours with a common prefix of 100 - l bytes and equal l bytes before them
   hold the same string; all but its earliest start are repeated. Boundaries
   never cut equal leading bytes, and a bucket is read in pieces that carry the
   strings seen so far across the cut, so pieces compare as one bucket.
   Suffixes whose leading bytes are those of more than ``HOT`` tokens (a fixed
   number, whatever the size of the input) do not go to a bucket: each string of ``LENGTH`` bytes through such a token is hashed, equal
   ones of a task are merged, and the rest meet by hash, so that no task holds or
   sorts all contexts of a common phrase.
4. Covered spans are merged per text.

The unit is the distinct text: its first document (smallest id) keeps what is
not covered, and later copies of at least ``LENGTH`` bytes are removed whole
without further work. Texts are told apart by a 64-bit hash, strings by their
bytes to the right and a 64-bit hash to the left of a token; those of hot leading
bytes by the hash of these, their place and a 64-bit hash of all their bytes.

Defined cases: null is empty; texts shorter than ``LENGTH`` are kept; null ids
stand last; rows that repeat id and text are one document (all of them keep what
it keeps); an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import BYTE_CODE, Texts, chunks, mix, powers
from carebasin.sources.writers import stage

LENGTH = 100
GRAM = 32
#: Gram places in a string; one of them begins a token.
PLACES = LENGTH - GRAM + 1
#: Bytes before a token that a string through it can reach.
BEFORE = PLACES - 1
#: Bytes hashed at once (places are packed into 24 bits); longer texts in pieces.
PIECE = 1 << 20
#: Texts, and suffixes of each, that the splitters are sampled from.
SAMPLE, SAMPLE_EACH = 500, 100
#: Suffixes in a bucket, and sorted at once.
BUCKET, SORTED = 100_000, 30_000
#: Distinct contexts that a task holds to combine equal ones.
COMBINED = 100_000
#: Tokens with equal leading bytes from which their strings are hashed one by one.
HOT = 30_000
#: Contexts of hot grams whose strings are hashed at once.
HASHED = 5_000

_STEP = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_STEP, -1, 1 << 64))
_inverse = np.ones(1, np.uint64)


def _inverse_powers(count: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < count:
        grown = np.full(max(count, 2 * len(_inverse)), _BACK, np.uint64)
        grown[0] = 1
        _inverse = np.multiply.accumulate(grown)
    return _inverse[:count]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the token starts of texts laid one after
    another; windows never cross texts."""
    places, hashes = [], []
    for begin in range(0, len(data), PIECE):
        x = data[begin: begin + PIECE + LENGTH - 1]
        if len(x) < LENGTH:
            break
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_CODE[x] * powers(len(x)), dtype=np.uint64)])
        gram = mix((run[GRAM:] - run[:-GRAM]) * _inverse_powers(len(x) - GRAM + 1))
        packed = (gram >> np.uint64(24) << np.uint64(24)) | np.arange(len(gram), dtype=np.uint64)
        least = packed
        reach = 1
        while 2 * reach <= PLACES:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        least = np.minimum(least[: len(least) - (PLACES - reach)], least[PLACES - reach:])
        # a window counts if its string lies within one text
        starts = np.arange(begin, begin + len(least))
        inside = offsets[np.searchsorted(offsets, starts, "right")] >= starts + LENGTH if len(starts) else starts > 0
        chosen = np.unique(least[inside]) & np.uint64((1 << 24) - 1)
        chosen = np.sort(chosen.astype(np.int64))
        places.append(chosen + begin)
        hashes.append(gram[chosen])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, g = np.concatenate(places), np.concatenate(hashes)
    at, first = np.unique(at, return_index=True)
    return at, g[first]


def texts_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text, F.lit(1)).alias("unit"))


class Seen:
    """Units that a task has met; forgotten when they become many."""

    def __init__(self):
        self.units = set()

    def fresh(self, units: list[int]) -> list[int]:
        if len(self.units) > 1_000_000:
            self.units.clear()
        return [k for k, u in enumerate(units) if u not in self.units and not self.units.add(u)]


def repeated_grams(texts: DataFrame) -> DataFrame:
    """``unit, gram, n`` of the tokens whose leading bytes occur twice or more: how
    many of them the unit has."""

    def emit(batches):
        seen = Seen()
        for piece in chunks(batches, limit=PIECE):
            units = piece.batch.column("unit").to_pylist()
            at, gram = tokens(piece.data, piece.offsets)
            row = np.searchsorted(piece.offsets, at, "right") - 1
            keep = np.zeros(len(units), bool)
            keep[seen.fresh(units)] = True
            use = keep[row]
            if not use.any():
                continue
            order = np.lexsort((gram[use], row[use]))
            r, g = row[use][order], gram[use][order]
            same = np.zeros(len(g), bool)
            same[1:] = (r[1:] == r[:-1]) & (g[1:] == g[:-1])
            n = np.diff(np.append(np.flatnonzero(~same), len(g)))
            yield pa.record_batch([
                pa.array(g[~same].view(np.int64)), pa.array(np.asarray(units, np.int64)[r[~same]]), pa.array(n.astype(np.int64)),
            ], ["gram", "unit", "n"])

    def pick(batches):
        carried = None  # the last row of a batch, with whether its gram is known to repeat
        for batch in batches:
            if not batch.num_rows:
                continue
            g, u, n = (np.asarray(batch.column(c)) for c in ("gram", "unit", "n"))
            twice = n > 1
            if carried is not None:
                g, u, n, twice = (np.append(x, y) for x, y in zip(carried, (g, u, n, twice)))
            first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(g))))
            other = np.append(False, (g[1:] == g[:-1]) & (u[1:] != u[:-1]))
            again = np.maximum.reduceat(twice | other, first)
            out = again[owner]
            # the last gram may go on in the next batch: its last row is carried along
            last = first[-1]
            carried = g[-1:], u[-1:], n[-1:], again[-1:]
            if not again[-1]:
                out[last:] = False
            else:
                out[-1] = False
            yield pa.record_batch([pa.array(u[out]), pa.array(g[out]), pa.array(n[out])], ["unit", "gram", "n"])
        if carried is not None and carried[3][0]:
            yield pa.record_batch([pa.array(carried[1]), pa.array(carried[0]), pa.array(carried[2])], ["unit", "gram", "n"])

    found = texts.select("unit", "text").mapInArrow(emit, "gram long, unit long, n long")
    found = found.repartition("gram").sortWithinPartitions("gram", "unit")
    return found.mapInArrow(pick, "unit long, gram long, n long")


def grams_of_units(grams: DataFrame) -> DataFrame:
    """``unit, grams, hot``: the repeated grams of each unit, and those of them that
    more than ``HOT`` tokens have. The latter are written, so that Spark knows
    their size and joins them by shuffle where they are too many to broadcast."""
    counted = grams.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > HOT)
    hot = stage(counted.select("gram", F.lit(True).alias("is_hot")), "suffix-hot")
    marked = grams.select("unit", "gram").join(hot, "gram", "left")
    return marked.groupBy("unit").agg(
        F.collect_set("gram").alias("grams"), F.collect_set(F.when(F.col("is_hot"), F.col("gram"))).alias("hot")
    )


def packed_units(texts: DataFrame) -> DataFrame:
    """``unit, packed``: each distinct text of at least ``LENGTH`` bytes once, compressed."""

    def pack(batches):
        seen, packer = Seen(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            units = batch.column("unit").to_pylist()
            keep = seen.fresh(units)
            text = batch.column("text")
            yield pa.record_batch([
                pa.array([units[k] for k in keep], pa.int64()),
                pa.array([packer.compress(text[k].as_buffer()) for k in keep], pa.binary()),
            ], ["unit", "packed"])

    long_ones = texts.where(F.octet_length("text") >= LENGTH).select("unit", "text")
    return long_ones.mapInArrow(pack, "unit long, packed binary").groupBy("unit").agg(F.first("packed").alias("packed"))


def head(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them."""
    block = data[at[:, None] + np.arange(8)]
    return block.astype(">u1").view(">u8").ravel().astype(np.uint64)


def sampled_splitters(texts: DataFrame, firsts: DataFrame, buckets: int) -> np.ndarray:
    """Leading bytes that cut a sample of the suffixes into even buckets."""
    chosen = firsts.orderBy("unit").limit(SAMPLE).select("unit")

    def heads(batches):
        seen = Seen()
        for piece in chunks(batches, limit=PIECE):
            at, _ = tokens(piece.data, piece.offsets)
            row = np.searchsorted(piece.offsets, at, "right") - 1
            for k in seen.fresh(piece.batch.column("unit").to_pylist()):
                own = at[row == k]
                own = own[np.linspace(0, len(own) - 1, min(len(own), SAMPLE_EACH)).astype(int)] if len(own) else own
                yield pa.record_batch([pa.array((head(piece.data, own) >> np.uint64(1)).astype(np.int64))], ["head"])

    found = texts.join(F.broadcast(chosen), "unit", "left_semi").select("unit", "text").mapInArrow(heads, "head long").toArrow()
    values = np.sort(np.asarray(found.column("head").combine_chunks(), np.int64))
    if not len(values) or buckets < 2:
        return np.zeros(0, np.int64)
    return np.unique(values[np.linspace(0, len(values) - 1, buckets + 1).astype(int)[1:-1]])


def hot_strings(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts in order of occurrence: the owner, hash and place of each
    different string through the token where it starts first, and the spans
    (owner, begin, stop) of the others."""
    data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
    size = np.array([len(r[6]) for r in rows], np.int64)
    left, low = np.array([r[5] for r in rows], np.int64), np.array([r[4] - r[5] for r in rows], np.int64)
    count = np.maximum(np.minimum(left, size - LENGTH) + 1, 0)
    owner = np.repeat(np.arange(len(rows)), count)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    place = (np.cumsum(size) - size)[owner] + start
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_CODE[data] * powers(len(data)), dtype=np.uint64)])
    bytes_ = mix((run[place + LENGTH] - run[place]) * _inverse_powers(len(data) + 1)[place])
    # strings meet at the same place only: one that holds two equal tokens does not meet itself
    string = mix(bytes_ + (left[owner] - start).astype(np.uint64) * np.uint64(_STEP)).view(np.int64)
    gram = np.array([r[0] for r in rows], np.int64)[owner]
    order = np.lexsort((string, gram))
    again = np.zeros(len(order), bool)
    again[order[1:]] = (string[order[1:]] == string[order[:-1]]) & (gram[order[1:]] == gram[order[:-1]])
    # all strings of an owner hold its token, so that they make one span
    hit, first = np.unique(owner[again], return_index=True)
    starts = start[again]
    last = np.append(first[1:], len(starts)) - 1
    spans = np.stack([hit, low[hit] + starts[first], low[hit] + starts[last] + LENGTH]) if len(hit) else np.zeros((3, 0), np.int64)
    return owner[~again], string[~again], low[owner[~again]] + start[~again], spans


ROW = "bucket int, gram long, string long, no_id boolean, id {kind}, unit long, at long, left_bytes int, context binary, begin long, stop long"
NAMES = ["bucket", "gram", "string", "no_id", "id", "unit", "at", "left_bytes", "context", "begin", "stop"]


def contexts(units: DataFrame, splitters: np.ndarray, kind: str) -> DataFrame:
    """One row per suffix to sort: its bytes and those before it, and whose it
    is. Suffixes with the context of an earlier one of the task are given as
    covered spans (``begin``, ``stop``) instead, and those of hot grams as a row
    per ``string`` that starts at ``at``."""

    def cut(batches):
        held: dict[bytes, tuple] = {}
        spans: list[tuple[int, int, int]] = []
        unpacker = zstandard.ZstdDecompressor()
        id_type = pa.int64()
        rank = lambda r: (r[1], 0 if r[2] is None else r[2], r[3], r[4])

        def flush():
            rows, common = [], []
            for r in held.values():
                (common if r[7] else rows).append(r)
            common.sort(key=rank)
            for k in range(0, len(common), HASHED):
                part = common[k: k + HASHED]
                owner, string, at, (hit, begin, stop) = hot_strings(part)
                spans.extend(zip((part[x][3] for x in hit.tolist()), begin.tolist(), stop.tolist()))
                columns, taken = list(zip(*part)), pa.array(owner)
                null = lambda t: pa.nulls(len(owner), t)
                gram, no_id, id_, unit = (pa.array(c, t).take(taken) for c, t in zip(columns, (pa.int64(), pa.bool_(), id_type, pa.int64())))
                yield pa.RecordBatch.from_arrays([
                    pa.array((string & 0x7FFFFFFF).astype(np.int32)), gram, pa.array(string), no_id, id_, unit, pa.array(at),
                    null(pa.int32()), null(pa.binary()), null(pa.int64()), null(pa.int64()),
                ], NAMES)
            if rows:
                first8 = np.array([int.from_bytes(r[6][r[5]: r[5] + 8], "big") >> 1 for r in rows], np.int64)
                bucket = np.searchsorted(splitters, first8, "right").astype(np.int32)
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket), pa.array(columns[0], pa.int64()), pa.nulls(len(rows), pa.int64()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], id_type),
                    pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.int32()),
                    pa.array(columns[6], pa.binary()), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
                ], NAMES)
            if spans:
                u, b, e = zip(*spans)
                null = lambda t: pa.nulls(len(u), t)
                yield pa.RecordBatch.from_arrays([
                    pa.array(((np.asarray(u) ^ np.asarray(b)) % 997).astype(np.int32)), null(pa.int64()), null(pa.int64()), null(pa.bool_()), null(id_type), pa.array(u, pa.int64()),
                    null(pa.int64()), null(pa.int32()), null(pa.binary()), pa.array(b, pa.int64()), pa.array(e, pa.int64()),
                ], NAMES)
            held.clear()
            spans.clear()

        for batch in batches:
            id_type = batch.column("id").type
            for unit, no_id, id_, packed, grams, hot in zip(
                batch.column("unit").to_pylist(), batch.column("no_id").to_pylist(), batch.column("id").to_pylist(),
                batch.column("packed"), batch.column("grams"), batch.column("hot").to_pylist(),
            ):
                raw = unpacker.decompress(packed.as_buffer())
                at, gram = tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                hot = frozenset(hot)
                wanted = np.isin(gram, np.asarray(grams.values).view(np.uint64))
                for q, g in zip(at[wanted].tolist(), gram[wanted].view(np.int64).tolist()):
                    low = max(0, q - BEFORE)
                    context = raw[low: q + LENGTH]
                    key = context + bytes([q - low])
                    mine = (g, no_id, id_, unit, q, q - low, context, g in hot)
                    other = held.get(key)
                    if other is not None:
                        if rank(mine) < rank(other):
                            mine, other = other, mine
                        held[key] = other
                        if len(context) >= LENGTH:
                            spans.append((mine[3], mine[4] - mine[5], mine[4] - mine[5] + len(context)))
                    else:
                        held[key] = mine
                if len(held) + len(spans) >= COMBINED:
                    yield from flush()
        yield from flush()

    return units.mapInArrow(cut, ROW.format(kind=kind))


def multikey_order(suffixes: np.ndarray) -> np.ndarray:
    """Order of the rows of bytes: eight bytes a step, and only groups that are
    still equal are sorted on."""
    width = -(-suffixes.shape[1] // 8) * 8
    padded = np.zeros((len(suffixes), width), np.uint8)
    padded[:, : suffixes.shape[1]] = suffixes
    keys = padded.view(">u8").astype(np.uint64)
    order = np.argsort(keys[:, 0], kind="stable")
    group = np.cumsum(np.append(False, keys[order[1:], 0] != keys[order[:-1], 0]))
    for depth in range(1, keys.shape[1]):
        equal = np.append(False, group[1:] == group[:-1])
        open_ = np.flatnonzero(equal | np.append(equal[1:], False))
        if not len(open_):
            break
        rows = order[open_]
        inner = np.lexsort((keys[rows, depth], group[open_]))
        order[open_] = rows[inner]
        change = np.append(False, (group[1:] != group[:-1]) | (keys[order[1:], depth] != keys[order[:-1], depth]))
        group = np.cumsum(change)
    return order


def repeated_starts(gram, left_size, context) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of suffixes in order of occurrence within each gram: the least and greatest
    number of bytes before the token at which a repeated string starts (-1: none),
    and whether some string starts first here."""
    m = len(gram)
    right, left = np.zeros((m, LENGTH), np.uint8), np.zeros((m, BEFORE), np.uint8)
    right_size = np.array([len(c) for c in context], np.int64) - left_size
    for k, c in enumerate(context):
        low = left_size[k]
        right[k, : right_size[k]] = np.frombuffer(c, np.uint8, right_size[k], low)
        left[k, :low] = np.frombuffer(c, np.uint8, low)[::-1]  # nearest byte first
    order = multikey_order(right)
    differs = right[order[1:]] != right[order[:-1]]
    common = np.where(differs.any(1), differs.argmax(1), LENGTH)
    common = np.minimum(common, np.minimum(right_size[order[1:]], right_size[order[:-1]]))
    least, most, fresh = np.full(m, -1), np.full(m, -1), np.zeros(m, bool)
    before, step = np.zeros(m, np.uint64), powers(BEFORE + 2)
    for l in range(PLACES):
        if l:
            before = before + BYTE_CODE[left[:, l - 1]] * step[l]
        run = np.empty(m, np.uint64)
        run[order] = np.cumsum(np.append(True, common < LENGTH - l)).astype(np.uint64)
        rows = np.flatnonzero((left_size >= l) & (right_size >= LENGTH - l))
        if not len(rows):
            continue
        string = mix(mix(before[rows]) + run[rows] * np.uint64(_STEP))
        _, first, which = np.unique(string, return_index=True, return_inverse=True)
        again = first[which.ravel()] != np.arange(len(rows))
        fresh[rows[~again]] = True
        hit = rows[again]
        least[hit] = np.where(least[hit] < 0, l, least[hit])
        most[hit] = l
    return least, most, fresh


def covered(cuts: DataFrame) -> DataFrame:
    """``unit, begin, stop``: spans covered by repeated strings."""

    def sort(batches):
        rows: list[tuple] = []
        old = 0
        met = None  # the last string of a hot gram

        def work(final):
            nonlocal rows, old
            gram = np.array([r[0] for r in rows], np.int64)
            at, left_size = np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64)
            least, most, fresh = repeated_starts(gram, left_size, [r[4] for r in rows])
            hit = np.flatnonzero(most >= 0)
            hit = hit[hit >= old]
            units = np.array([r[1] for r in rows], np.int64)
            out = pa.record_batch([pa.array(units[hit]), pa.array(at[hit] - most[hit]), pa.array(at[hit] - least[hit] + LENGTH)], ["unit", "begin", "stop"])
            # strings of the last gram that were seen first go along to the next piece
            rows = [] if final else [rows[k] for k in np.flatnonzero((gram == gram[-1]) & fresh)]
            old = len(rows)
            return out

        for batch in batches:
            done = np.asarray(batch.column("begin").is_valid())
            if done.any():
                yield batch.filter(pa.array(done)).select(["unit", "begin", "stop"])
            hashed = np.asarray(batch.column("string").is_valid())
            if hashed.any():
                # rows are in order of string, then of occurrence: all but the first are repeated
                part = batch.filter(pa.array(hashed))
                gram, string, unit, at = (np.asarray(part.column(c)) for c in ("gram", "string", "unit", "at"))
                again = np.append((gram[0], string[0]) == met, (gram[1:] == gram[:-1]) & (string[1:] == string[:-1]))
                met = gram[-1], string[-1]
                yield pa.record_batch([pa.array(unit[again]), pa.array(at[again]), pa.array(at[again] + LENGTH)], ["unit", "begin", "stop"])
            todo = batch.filter(pa.array(~done & ~hashed))
            rows.extend(zip(*(todo.column(c).to_pylist() for c in ("gram", "unit", "at", "left_bytes", "context"))))
            if len(rows) - old >= SORTED:
                yield work(False)
        if len(rows) > old:
            yield work(True)

    ordered = cuts.repartition("bucket").sortWithinPartitions("bucket", "gram", "string", "no_id", "id", "unit", "at")
    return ordered.mapInArrow(sort, "unit long, begin long, stop long")


def reduced(units: DataFrame) -> DataFrame:
    """``unit, n_removed, n_spans, kept, kept_sha256`` of texts with covered spans."""

    def cut(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for unit, packed, spans in zip(batch.column("unit").to_pylist(), batch.column("packed"), batch.column("spans")):
                raw = unpacker.decompress(packed.as_buffer())
                begin, stop = (np.asarray(spans.values.field(c)) for c in ("begin", "stop"))
                edge = np.bincount(begin, minlength=len(raw) + 1) - np.bincount(stop, minlength=len(raw) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((unit, int(gone.sum()), runs, kept, hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], ["unit", "n_removed", "n_spans", "kept", "kept_sha256"])

    return units.mapInArrow(cut, "unit long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def deduplicated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first document of each distinct text (``unit, no_id, id``), and what is
    left of the distinct texts that lost bytes (``unit, n_removed, n_spans, kept,
    kept_sha256``)."""
    texts = texts_of(docs)
    kind = dict(docs.dtypes)["doc_id"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")))
    firsts = stage(texts.groupBy("unit").agg(first.alias("x")).select("unit", "x.no_id", "x.id"), "suffix-firsts")
    grams = stage(repeated_grams(texts), "suffix-grams")
    total = grams.count()
    splitters = sampled_splitters(texts, firsts, total // BUCKET + 1)
    units = packed_units(texts).join(grams_of_units(grams).hint("merge"), "unit").join(firsts, "unit")
    units = units.select("unit", "no_id", "id", "packed", "grams", "hot")
    spans = stage(covered(contexts(units, splitters, kind)), "suffix-spans")
    by_unit = spans.groupBy("unit").agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))
    left = packed_units(texts).join(by_unit.hint("merge"), "unit")
    return firsts, reduced(left.select("unit", "packed", "spans"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document with a digest of what is left of it."""
    firsts, left = deduplicated(docs)
    # the digests alone go on; the texts that are left are not moved again
    left = stage(left.drop("kept"), "suffix-left")
    every = texts_of(docs).select(
        "doc_id", "unit", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole")
    )
    joined = every.join(firsts, "unit").join(left, "unit", "left")
    copy = ~F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("n_bytes") >= LENGTH)
    return joined.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
