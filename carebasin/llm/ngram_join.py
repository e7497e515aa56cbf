"""Self-join of documents on the Jaccard similarity of word n-grams.

A document's set holds the 63-bit hashes of its n-grams. Equal sets are one set
with a weight, so copies are never paired. Sets are compared through an inverted
index of prefixes: in one total order of all grams, two sets that reach the
similarity share a gram among the first quarter of both. The order puts grams
that tasks see repeatedly last, by count (a summary of at most ``HEAVY`` grams
over all documents); any order gives the same links, this one keeps lists short.

Set relations skip work:

* Index lists are skipped by position: a pair is looked at only where the gram's
  position in both sets leaves room for the needed overlap, and inside a cell
  each list is entered at the first set of a fitting size.
* Answers are derived: in a list longer than ``SHORT``, one set (the pivot) is
  compared with all others. Sets at a distance of up to 1/2 form the pivot's
  cell, in which all pairs are answered (a list inside it is done); a set's overlaps are those of a highly
  similar set, less the lists of the grams it lacks, plus those of the grams it
  has instead. Sets farther than 1/4 go on to the next round with another
  pivot. By the triangle inequality no linked pair is lost: if one of two linked
  sets is within 1/4 of the pivot, the other is within 1/2. A list that is still
  long after the rounds is a cell itself, put together with lists of nearly the
  same sets.

Cells give link counts and one spanning edge per set, never pairs, and large
cells are cut into blocks of ``BLOCK`` grams. Components come from the edges by
star contraction. The index names a list by 48 bits of its gram's key, and places
end at 2**16 - 1: lists that share a name and places that are too small only add pairs, all of
which are compared on whole sets. Those are shuffled as steps between their sorted
grams, byte by byte. Nothing but the bounded summary, and two bit maps of 2 MB
that tell which sets and rows are of interest, goes through the driver.

Defined cases: documents without words have no set, link with nothing and are
their own component; fewer words than n are one gram; repeated rows are copies;
a null id takes part but is no component's smallest id unless it is alone. An
empty table gives an empty result. Equality of sets and grams rests on 64-bit
hashes. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import WORD, Texts, chunks, mix, orderable_part, packed, row_key, words
from carebasin.llm.components import connected
from carebasin.sources.writers import stage

WORDS = 5
#: Similarity as a fraction: 75 / 100.
SHARE, WHOLE = 75, 100
#: Grams whose counts order the index; 8 bytes each, from the driver to all tasks.
HEAVY = 1 << 20
#: Grams counted together in a task before repeats among them are reported.
COUNTED = 3 << 21
#: Repeats in such a count from which a gram is reported.
REPEATED = 2
#: Lists up to this length are compared pair by pair; what rounds of pivots leave
#: of a list, up to twice as many after each round, but no more than ``PAIRED``.
SHORT, PAIRED = 16, 512
#: Rounds of pivots; lists that are still long after them are cells.
ROUNDS = 8
#: Pairs and rows that a task collects before it gives them on.
GIVEN = 100_000
#: Grams in a block of a cell.
BLOCK = 1 << 20
#: Bits of the map of interesting sets.
MAP_BITS = 24
#: Bits of a gram's place in a set that the index holds; later places count as the last one.
AT_BITS = 16

_ODD = np.random.default_rng(7).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_TOP = np.uint64(1 << 63)


def grams(texts: Texts, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes below 2**63 of all texts in order, and where each text's begin."""
    _, _, hashes, first = words(texts)
    n = len(hashes)
    counts = np.diff(first)
    end = np.repeat(first[1:], counts)
    place = np.arange(n)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    total = np.repeat(np.minimum(counts, k), counts).astype(np.uint64)
    for j in range(k):
        total = total + np.where(place + j < end, padded[j: j + n], np.uint64(0)) * _ODD[j]
    whole = (place + k <= end) | (place == np.repeat(first[:-1], counts))
    return mix(total[whole]) >> np.uint64(1), np.concatenate([[0], np.cumsum(whole)])[first]


class Order:
    """Maps grams to keys whose order is the index order."""

    def __init__(self, heavy: np.ndarray):
        rank = np.arange(len(heavy), dtype=np.uint64)
        self.sorted = np.argsort(heavy)
        self.grams, self.ranks = heavy[self.sorted], rank[self.sorted]

    def keys(self, values: np.ndarray) -> np.ndarray:
        if not len(self.grams) or not len(values):
            return values
        at = np.minimum(np.searchsorted(self.grams, values), len(self.grams) - 1)
        return np.where(self.grams[at] == values, _TOP + self.ranks[at], values)


def sets(batches, order: Order, k: int):
    """(row of batch, fingerprint, keys in index order) of each non-empty set."""
    for texts in chunks(batches):
        values, first = grams(texts, k)
        keys = order.keys(values)
        out = []
        for row in range(len(texts)):
            if first[row] < first[row + 1]:
                unique = np.unique(keys[first[row]: first[row + 1]])
                out.append((row, int(mix(unique).sum(dtype=np.uint64).view(np.int64)), unique))
        yield texts.batch, out


def heavy_grams(docs: DataFrame, k: int) -> np.ndarray:
    """The most repeated grams, rarest first. Tasks count the grams of different
    sets, a few millions together, and report those that they see again."""
    plain = Order(np.zeros(0, np.uint64))

    def repeats(batches):
        held, seen, size = [], set(), 0

        def report():
            unique, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= REPEATED
            return pa.record_batch(
                [pa.array(unique[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], ["gram", "n"]
            )

        for _, found in sets(batches, plain, k):
            for _, id_, unique in found:
                if id_ not in seen:
                    seen.add(id_)
                    held.append(unique)
                    size += len(unique)
            if size >= COUNTED:
                yield report()
                held, seen, size = [], set(), 0
        if held:
            yield report()

    counted = docs.select("text").mapInArrow(repeats, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "gram").limit(HEAVY).toArrow()
    return np.asarray(rows.column("gram").combine_chunks(), np.int64)[::-1].copy().view(np.uint64)


def names(keys: np.ndarray) -> np.ndarray:
    """A name of 48 bits for the list of each key; the frequent grams' names are their own."""
    return np.where(keys >= _TOP, (_TOP >> np.uint64(AT_BITS)) + (keys - _TOP), keys >> np.uint64(AT_BITS))


def coded(keys: np.ndarray) -> bytes:
    """A sorted set as the steps between its keys, their first bytes first: most steps
    have leading zeros, which lie together and take next to nothing when compressed."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def decoded(blob: bytes) -> np.ndarray:
    """The sorted set that ``coded`` was given."""
    steps = np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def need(a, b):
    """Least overlap of linked sets of sizes a and b."""
    return -(-SHARE * (a + b) // (SHARE + WHOLE))


def postings(docs: DataFrame, order: Order, k: int) -> DataFrame:
    """``key, id, n, at``: the index. Equal sets of one task give it once."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])

    def emit(batches):
        seen = set()
        for _, found in sets(batches, order, k):
            fresh = [x for x in found if x[1] not in seen and not seen.add(x[1])]
            if len(seen) > 1_000_000:
                seen.clear()
            if not fresh:
                continue
            sizes = np.array([len(x[2]) for x in fresh])
            heads = sizes - -(-SHARE * sizes // WHOLE) + 1
            ids = np.array([x[1] for x in fresh], np.int64)
            at = np.arange(heads.sum()) - np.repeat(np.cumsum(heads) - heads, heads)
            keys = names(np.concatenate([x[2][:h] for x, h in zip(fresh, heads)]))
            yield pa.record_batch([
                pa.array(keys.view(np.int64)), pa.array(np.repeat(ids, heads)),
                pa.array(np.repeat(sizes, heads).astype(np.int32)), pa.array(at.astype(np.int32)),
            ], schema=schema)

    return docs.select("text").mapInArrow(emit, "key long, id long, n int, at int")


ROW = "long_list boolean, key long, a long, b long, n int, m int, at int"
_ROW = pa.schema([
    ("long_list", pa.bool_()), ("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
    ("n", pa.int32()), ("m", pa.int32()), ("at", pa.int32()),
])


def walked(batches, short: int):
    """Rows of the lists, in order of key, n and id: pairs of lists of up to
    ``short`` sets, and the rows of longer ones."""
    pairs, rows, held = [], [], []
    key, length = None, 0

    def close():
        if length < 2 or length > short:
            return
        ids, n, at = (np.array([x[i] for x in held]) for i in range(3))
        for i in range(1, len(held)):
            room = need(n[i], n[:i])
            ok = (ids[:i] != ids[i]) & (at[i] <= n[i] - room) & (at[:i] <= n[:i] - room)
            pairs.extend((*sorted((ids[i], other)),) for other in ids[:i][ok])
            if len(pairs) > GIVEN:
                yield from flush()

    def flush():
        unique = set(pairs)
        a, b = zip(*unique) if unique else ((), ())
        none = [None] * len(a)
        keys, ids, n, at = zip(*rows) if rows else ((), (), (), ())
        blank = [None] * len(keys)
        yield pa.record_batch([
            pa.array([False] * len(a) + [True] * len(keys), pa.bool_()), pa.array(none + list(keys), pa.int64()),
            pa.array(list(a) + list(ids), pa.int64()), pa.array(list(b) + blank, pa.int64()),
            pa.array(none + list(n), pa.int32()), pa.array(none + blank, pa.int32()),
            pa.array(none + list(at), pa.int32()),
        ], schema=_ROW)
        pairs.clear()
        rows.clear()

    for batch in batches:
        columns = [np.asarray(batch.column(c)) for c in ("key", "id", "n", "at")]
        # most lists hold one set: they are passed over without a Python step
        same = np.zeros(batch.num_rows + 1, bool)
        same[1:-1] = columns[0][1:] == columns[0][:-1]
        wanted = same[1:] | same[:-1]
        if len(wanted):
            wanted[[0, -1]] = True
        for k, i, n, at in zip(*(c[wanted].tolist() for c in columns)):
            if k != key:
                yield from close()
                key, length, held = k, 0, []
            elif held and held[-1][0] == i:
                continue
            length += 1
            if length <= short:
                held.append((i, n, at))
            else:
                if length == short + 1:
                    rows.extend((key, *x) for x in held)
                rows.append((key, i, n, at))
        if len(pairs) + len(rows) > GIVEN:
            yield from flush()
    yield from close()
    yield from flush()


def list_rows(index: DataFrame, short: int) -> DataFrame:
    """Walk the lists: pairs of short lists that positions and sizes allow, and
    the rows of long ones. A list is streamed; only its head of ``short`` rows is
    held."""
    last = (1 << AT_BITS) - 1
    word = F.shiftleft("key", AT_BITS).bitwiseOR(F.least("at", F.lit(last)).cast("long"))
    key = F.shiftrightunsigned("word", AT_BITS)
    # name and place travel as one number: rows of a set then differ in it alone
    dealt = index.select(word.alias("word"), "id", "n").repartition(key).select(
        key.alias("key"), "id", "n", F.col("word").bitwiseAND(F.lit(last)).cast("int").alias("at")
    )
    ordered = dealt.sortWithinPartitions("key", "n", "id")
    return ordered.mapInArrow(lambda batches: walked(batches, short), ROW)


def interesting(ids: DataFrame) -> np.ndarray:
    """A bit map of the ids' hashes; its size is fixed."""
    place = F.pmod("id", F.lit(1 << MAP_BITS))
    cells = ids.groupBy(F.shiftright(place, 6).alias("cell")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(id, {1 << MAP_BITS}) & 63 as int))")).alias("bits")
    ).toArrow()
    bits = np.zeros(1 << (MAP_BITS - 6), np.int64)
    bits[np.asarray(cells.column("cell").combine_chunks(), np.int64)] = np.asarray(cells.column("bits").combine_chunks(), np.int64)
    return bits


def named(bits: np.ndarray, values) -> np.ndarray:
    """Which of some 64-bit values the bit map names; it may name a few more than it was made of."""
    place = np.asarray(values, np.int64) % (1 << MAP_BITS)
    return (bits[place >> 6] >> (place & 63) & 1).astype(bool)


def whole_sets(docs: DataFrame, order: Order, k: int, ids: DataFrame, sources: DataFrame, form=np.ndarray.tobytes) -> DataFrame:
    """``id, n, grams`` (bytes, as ``form`` gives them) of the sets ``id``, and of a few more
    that share their bits, once each. ``sources`` has for every set its ``id`` and the
    ``key`` of one row that holds it: other texts are passed over before a word is cut."""
    bits = interesting(ids)

    def of_sets(batches):
        for batch in batches:
            yield pa.record_batch([batch.column("key").filter(pa.array(named(bits, batch.column("id"))))], ["id"])

    rows = interesting(sources.select("id", "key").mapInArrow(of_sets, "id long"))

    def emit(batches):
        seen = set()
        picked = (batch.filter(pa.array(named(rows, batch.column("key")))) for batch in batches)
        for _, found in sets(picked, order, k):
            keep = []
            for (row, id_, keys), wanted in zip(found, named(bits, [x[1] for x in found])):
                if wanted and id_ not in seen:
                    seen.add(id_)
                    keep.append((id_, len(keys), form(keys)))
            if len(seen) > 1_000_000:
                seen.clear()
            if keep:
                ids, n, blobs = zip(*keep)
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(n, pa.int32()), pa.array(blobs, pa.binary())], ["id", "n", "grams"])

    found = docs.select("text", row_key().alias("key")).mapInArrow(emit, "id long, n int, grams binary")
    return found.groupBy("id").agg(F.first("n").alias("n"), F.first("grams").alias("grams"))


def overlaps(pairs: DataFrame, every: DataFrame) -> DataFrame:
    """``a, b, n, m, both``: sizes and overlap of each pair ``a, b``."""
    side = lambda name, n, grams_: every.select(F.col("id").alias(name), F.col("n").alias(n), F.col("grams").alias(grams_))
    # merge joins at every size: the sets' bytes are shuffled, never broadcast
    joined = pairs.select("a", "b").join(side("b", "m", "right").hint("merge"), "b")
    joined = joined.join(side("a", "n", "left").hint("merge"), "a")

    def count(batches):
        for batch in batches:
            both = [
                len(np.intersect1d(decoded(x), decoded(y), True))
                for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())
            ]
            yield pa.record_batch([batch.column(c) for c in ("a", "b", "n", "m")] + [pa.array(both, pa.int32())], ["a", "b", "n", "m", "both"])

    return joined.mapInArrow(count, "a long, b long, n int, m int, both int")


LINKED = f"{WHOLE} * both >= {SHARE} * (n + m - both)"


def pivot_rounds(lists: DataFrame, every: DataFrame) -> tuple[DataFrame | None, list[DataFrame]]:
    """Cells ``cell, id`` of all rounds, and pairs that are left to compare."""
    cells, pairs = [], []
    for turn in range(ROUNDS):
        if lists.isEmpty():
            break
        # the same sets win in all lists of a family, so that few pairs are compared
        first = F.min(F.struct(F.xxhash64("id").alias("rank"), "id", "n"))
        pivots = stage(lists.groupBy("key").agg(first.alias("p")).select("key", F.col("p.id").alias("pivot"), F.col("p.n").alias("pn")), "join-pivots")
        against = stage(lists.join(pivots, "key").where("id <> pivot"), "join-against")
        pairs_ = against.where("2 * least(n, pn) >= greatest(n, pn)").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
        seen = stage(overlaps(pairs_, every), "join-compared")
        inside = "2 * both >= n + m - both"
        near = seen.where(inside)
        cells.append(near.select(F.col("a").alias("cell"), F.col("b").alias("id")).unionByName(near.select(F.col("a").alias("cell"), F.col("a").alias("id"))))
        found = seen.select(F.col("a").alias("pivot"), F.col("b").alias("id"), F.expr(LINKED).alias("settled"), F.expr(inside).alias("inside"))
        marked = against.join(found, ["pivot", "id"], "left")
        marked = stage(marked.where(~F.coalesce("settled", F.lit(False))), "join-marked")
        # all pairs of a cell are answered there: a list that lies inside it is done
        going = stage(marked.where(~F.coalesce("inside", F.lit(False))).select("key").distinct(), "join-going")
        left = marked.join(going, "key", "left_semi").select("key", "id", "n", "at")
        rows = stage(list_rows(left, min(SHORT << (turn + 1), PAIRED)), "join-left")
        pairs.append(rows.where("NOT long_list").select("a", "b"))
        lists = rows.where("long_list").select("key", F.col("a").alias("id"), "n", "at")
    else:
        # lists of one passage hold nearly the same sets: they are one cell
        least = [F.min(F.xxhash64("id", F.lit(seed))) for seed in range(3)]
        named = lists.groupBy("key").agg(F.xxhash64(*least).alias("cell"))
        cells.append(lists.join(named, "key").select("cell", "id"))
    merged = None
    for cell in cells:
        merged = cell if merged is None else merged.unionByName(cell)
    return merged if merged is None else stage(merged.distinct(), "join-cells"), pairs


def answer(cell: int, table: pa.Table, square: bool):
    """Links among the sets of a block (``square``), or between its two sides."""
    ids, n, weight = (np.asarray(table.column(c).combine_chunks()) for c in ("id", "n", "weight"))
    side = np.asarray(table.column("side").combine_chunks())
    blobs, own = table.column("grams").to_pylist(), table.column("cells").to_pylist()
    tokens = [decoded(x) for x in blobs]
    _, local = np.unique(np.concatenate(tokens), return_inverse=True)
    local = np.split(local.ravel(), np.cumsum(n)[:-1])
    left = np.arange(len(ids)) if square else np.flatnonzero(side == 0)
    right = np.arange(len(ids)) if square else np.flatnonzero(side == 1)
    right = right[np.argsort(n[right], kind="stable")]
    if not len(left) or not len(right):
        return [], []
    # the index of the right side: places sorted by gram, then by size of set
    ranks = len(right)
    entry = np.concatenate([local[r].astype(np.int64) * ranks + k for k, r in enumerate(right)])
    entry.sort()
    sizes = n[right].astype(np.int64)
    count, label = np.zeros(len(ids), np.int64), np.arange(len(ids))

    def add(grams_, low, high):
        begin = np.searchsorted(entry, grams_ * ranks + low)
        length = np.searchsorted(entry, grams_ * ranks + high) - begin
        place = np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)
        return np.bincount(entry[place] % ranks - low, minlength=high - low)

    ref = ref_counts = None
    for x in left:
        mine = np.sort(local[x].astype(np.int64))
        size = int(n[x])
        low = int(np.searchsorted(sizes, -(-SHARE * size // WHOLE)))
        high = int(np.searchsorted(sizes, WHOLE * size // SHARE, "right"))
        if low >= high:
            continue
        if ref is not None:
            extra, gone = np.setdiff1d(mine, ref, True), np.setdiff1d(ref, mine, True)
        if ref is not None and len(extra) + len(gone) <= size // 2:
            both = ref_counts[low:high] + add(extra, low, high) - add(gone, low, high)
        else:
            ref, ref_counts = mine, add(mine, 0, ranks)
            both = ref_counts[low:high]
        linked = right[low:high][WHOLE * both >= SHARE * (size + sizes[low:high] - both)]
        linked = linked[linked > x] if square else linked
        if not len(linked):
            continue
        roots = np.unique(label[np.append(linked, x)])
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
        # a pair that meets in several cells is counted in the first of them
        if len(own[x]) > 1:
            linked = np.array([y for y in linked if min(set(own[x]) & set(own[y])) == cell], np.int64)
        count[x] += weight[linked].sum()
        count[linked] += weight[x]
    edges = [(int(ids[i]), int(ids[label[i]])) for i in np.flatnonzero(label != np.arange(len(ids)))]
    return edges, [(int(i), int(c)) for i, c in zip(ids, count) if c]


def answer_cells(cells: DataFrame, every: DataFrame, weights: DataFrame) -> DataFrame:
    """Edges (``a, b``) and link counts (``a, links``) of all cells."""
    sized = cells.join(every.select("id", "n"), "id")
    blocks = sized.groupBy("cell").agg(F.ceil(F.sum("n") / F.lit(BLOCK)).cast("int").alias("blocks"))
    own = cells.groupBy("id").agg(F.collect_set("cell").alias("cells"))
    members = cells.join(stage(blocks, "join-blocks"), "cell").join(own, "id").join(weights, "id")
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cell", "id", "weight", "cells", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    )
    filled = dealt.join(every.hint("merge"), "id")

    def work(key, table):
        cell, x, y = (k.as_py() for k in key)
        edges, counts = answer(cell, table, x == y)
        a = [e[0] for e in edges] + [c[0] for c in counts]
        return pa.table({
            "a": pa.array(a, pa.int64()), "b": pa.array([e[1] for e in edges] + [None] * len(counts), pa.int64()),
            "links": pa.array([0] * len(edges) + [c[1] for c in counts], pa.int64()),
        })

    return filled.groupBy("cell", "x", "y").applyInArrow(work, "a long, b long, links long")


def labelled(docs: DataFrame, k: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """Documents ``doc_id, key, id, n`` with the id of their set and a key of id
    and text, and sets ``id, label, component_id, n_links``."""
    order = Order(heavy_grams(docs, k))
    text = docs.select("doc_id", row_key().alias("key"), "text")

    def measure(batches):
        for batch, found in sets(batches, order, k):
            n, ids = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            for row, id_, keys in found:
                n[row], ids[row] = len(keys), id_
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("key"), pa.array(ids, pa.int64()), pa.array(n)], ["doc_id", "key", "id", "n"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    slim = stage(text.mapInArrow(measure, f"doc_id {kind}, key long, id long, n long"), "join-docs")
    rows = stage(list_rows(postings(docs, order, k), SHORT), "join-rows")
    pairs = rows.where("NOT long_list").select("a", "b").distinct()
    lists = rows.where("long_list").select("key", F.col("a").alias("id"), "n", "at")
    copies = stage(
        slim.where("id IS NOT NULL").groupBy("id").agg(
            F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.min("key").alias("key")
        ),
        "join-copies",
    )
    # the sets of long lists are few and used often, those of pairs many and used
    # once: the former are written, the latter read again and shuffled by id once
    listed = stage(whole_sets(docs, order, k, lists.select("id"), copies, coded), "join-listed")

    cells, more = pivot_rounds(lists, listed)
    for extra in more:
        pairs = pairs.unionByName(extra)
    pairs = pairs.distinct()
    if cells is not None:
        own = cells.groupBy("id").agg(F.collect_set("cell").alias("cells"))
        left = own.select(F.col("id").alias("a"), F.col("cells").alias("ca"))
        right = own.select(F.col("id").alias("b"), F.col("cells").alias("cb"))
        pairs = pairs.join(left, "a", "left").join(right, "b", "left")
        pairs = pairs.where(F.coalesce(~F.arrays_overlap("ca", "cb"), F.lit(True)))
    pairs = stage(pairs.select("a", "b"), "join-pairs")
    paired = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    every = whole_sets(docs, order, k, paired, copies, coded)
    linked = stage(overlaps(pairs, every).where(LINKED).select("a", "b"), "join-linked")
    weights = copies.select("id", "weight")
    half = linked.select(F.col("a").alias("id"), F.col("b").alias("other"))
    half = half.unionByName(linked.select(F.col("b").alias("id"), F.col("a").alias("other")))
    counts = half.join(weights.withColumnRenamed("id", "other"), "other").select("id", F.col("weight").alias("links"))
    edges = linked
    if cells is not None:
        answers = stage(answer_cells(cells, listed, weights), "join-answers")
        edges = edges.unionByName(answers.where("b IS NOT NULL").select("a", "b"))
        counts = counts.unionByName(answers.where("b IS NULL").select(F.col("a").alias("id"), "links"))
    labels = connected(edges)
    least = copies.drop("key").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    component = stage(least.groupBy("label").agg(F.min("least").alias("component_id")), "join-components")
    total = counts.groupBy("id").agg(F.sum("links").alias("links"))
    by_set = stage(
        least.join(component, "label").join(total, "id", "left")
        .select("id", "label", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")),
        "join-by-set",
    )
    return slim, by_set


def join_documents(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links``, one row a document."""
    slim, by_set = labelled(docs, k)
    return slim.join(by_set, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_per_group(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """The rows of ``docs`` but for all of a group except the one of the smallest
    id. Documents without words are in no group and stay."""
    slim, by_set = labelled(docs, k)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    first = slim.where("id IS NOT NULL").join(by_set.select("id", "label"), "id").groupBy("label").agg(F.min(place).alias("x"))
    keep = stage(first.select(F.col("x.key").alias("key")), "join-kept")
    keyed = packed(docs, row_key().alias("key"), F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("worded"))
    # rows that repeat id and text share a key: one of each is picked, in tasks first
    single = keyed.where("worded").groupBy("key").agg(F.min_by("row", orderable_part(docs)).alias("row"))
    single = single.join(keep.hint("merge"), "key", "left_semi")
    return single.select("row.*").unionByName(keyed.where("NOT worded").select("row.*"))
