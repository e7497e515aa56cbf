"""Near-duplicate groups by b-bit MinHash signatures.

A document's set holds the 63-bit hashes of its shingles. Equal sets are one set. A
set's ``HASHES`` minima are cut into ``BANDS`` bands, and of each minimum the lowest
``BITS`` bits are kept and packed: bit k of all minima stands together in a few
64-bit words, so that two signatures are compared by exclusive-or and bit counts.
Low bits also agree by chance (once in 2**BITS), for which the estimated similarity
is corrected: (share of equal minima - 2**-BITS) / (1 - 2**-BITS).

Sets with equal bands are candidates. They are never paired with each other:

* **Families.** In each bucket (sets with one band) one set, the pivot, is estimated
  against the others. Those that may be within a distance of 1/2 join its family;
  those surely within 3/10 leave the bucket, as whatever they are linked with (at a
  distance of 1/5 at most) is within 1/2 of the pivot too. The others go on with another
  pivot; what ``ROUNDS`` rounds leave of a bucket is one family. Families
  that share a set are one. Margins of five standard deviations make up for estimates.
* **Links** are confirmed on full sets, inside a family. One set after the other is
  estimated against those that are not yet in its group; if any may be linked, an
  inverted index of the family gives its exact overlaps with all. Sets that are
  found in one group are not compared again, so a family of near copies takes one
  step and a few more for its odd members. A family of more than ``BLOCK`` grams is
  cut into blocks: all its sets are compared with one pivot first, then only those that
  the pivot does not link meet the blocks of the family.

A link at the limit (similarity 0.8) shares no band with a probability of 3 in a
million, and less above it. Groups come from spanning links by star contraction.
Nothing but two bit maps of 2 MB go through the driver.

Defined cases: a document without words has no set, links with nothing and is kept;
fewer words than a shingle are one shingle; repeated rows are copies of each other; a
null id takes part but is no group's smallest id unless it is alone (it counts as
kept then); an empty table gives no rows; extra columns, whatever their names, are
ignored. Equality of sets and shingles rests on 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import mix, row_key
from carebasin.llm.components import connected
from carebasin.llm.ngram_join import Order, sets, whole_sets
from carebasin.sources.writers import stage

WORDS = 4
#: Similarity of linked sets: 80 / 100.
SHARE, WHOLE = 80, 100
#: Minima in a band, bands, bits kept of a minimum, minima in a signature.
BAND, BANDS, BITS = 6, 42, 4
HASHES = 256
#: 64-bit words of a signature for each kept bit.
LANES = HASHES // 64
CHANCE = 2.0**-BITS
#: Rounds of pivots in the buckets.
ROUNDS = 4
#: Grams in a block of a family.
BLOCK = 1 << 20

_FACTORS = np.random.default_rng(12).integers(0, 1 << 31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_NO_ORDER = Order(np.zeros(0, np.uint64))


def spread(similarity: float) -> float:
    """Standard deviation of the corrected estimate at a similarity."""
    equal = CHANCE + (1 - CHANCE) * similarity
    return (equal * (1 - equal) / HASHES) ** 0.5 / (1 - CHANCE)


#: Estimates from which a pair may be linked, may be within 1/2, surely is within 3/10.
MAYBE_LINKED = SHARE / WHOLE - 5 * spread(SHARE / WHOLE)
MAYBE_NEAR = 0.5 - 5 * spread(0.5)
SURELY_CLOSE = 0.7 + 5 * spread(0.7)


# -- signatures --------------------------------------------------------------------------


def minima(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minima of all sets (a row each) under ``HASHES`` permutations of 32-bit values."""
    low = (mix(keys) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first) - 1, HASHES), np.uint32)
    for k, factor in enumerate(_FACTORS):
        out[:, k] = np.minimum.reduceat(low * factor, first[:-1])
    return out


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of scrambled minima: ``BITS * LANES`` words a set, bit by bit."""
    low = mix(least.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(32)))
    planes = [
        np.packbits(((low >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
        for b in range(BITS)
    ]
    return np.concatenate(planes, axis=1)


def bands(least: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band's minima and number."""
    out = np.empty((len(least), BANDS), np.uint64)
    for band in range(BANDS):
        value = np.full(len(least), band + 1, np.uint64)
        for k in range(band * BAND, (band + 1) * BAND):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + least[:, k])
        out[:, band] = value
    return out


def signed(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """``doc_id, key, n_shingles, id, signature, bands``. In a task, only the first of
    equal sets has a signature."""

    def work(batches):
        seen: set[int] = set()
        for batch, found in sets(batches, _NO_ORDER, k):
            n, ids = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            signatures, buckets = [None] * batch.num_rows, [None] * batch.num_rows
            fresh = []
            for row, id_, keys in found:
                n[row], ids[row] = len(keys), id_
                if id_ not in seen:
                    seen.add(id_)
                    fresh.append((row, keys))
            if len(seen) > 1_000_000:
                seen.clear()
            if fresh:
                first = np.cumsum([0, *(len(keys) for _, keys in fresh)])
                least = minima(np.concatenate([keys for _, keys in fresh]), first)
                for (row, _), s, b in zip(fresh, packed(least).view(np.int64).tolist(), bands(least).view(np.int64).tolist()):
                    signatures[row], buckets[row] = s, b
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("key"), pa.array(n), pa.array(ids, pa.int64()),
                 pa.array(signatures, pa.list_(pa.int64())), pa.array(buckets, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_shingles", "id", "signature", "bands"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", row_key().alias("key"), "text").mapInArrow(
        work, f"doc_id {kind}, key long, n_shingles long, id long, signature array<long>, bands array<long>"
    )


def estimate(a: str, b: str) -> Column:
    """Collision-corrected similarity of two packed signatures, by bit counts."""
    differ = lambda place: F.get(a, F.lit(place)).bitwiseXOR(F.get(b, F.lit(place)))
    lanes = [
        F.bit_count(reduce(Column.bitwiseOR, (differ(bit * LANES + lane) for bit in range(BITS))))
        for lane in range(LANES)
    ]
    equal = F.lit(1.0) - reduce(Column.__add__, lanes) / F.lit(float(HASHES))
    return (equal - F.lit(CHANCE)) / F.lit(1 - CHANCE)


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The same in a task: one packed signature against rows of others."""
    differ = (one ^ others).reshape(-1, BITS, LANES)
    unequal = np.bitwise_count(np.bitwise_or.reduce(differ, axis=1)).sum(axis=1, dtype=np.int64)
    return (1 - unequal / HASHES - CHANCE) / (1 - CHANCE)


# -- families ------------------------------------------------------------------------------


def families(signatures: DataFrame) -> DataFrame:
    """``family, id`` of the sets that may be linked with another one."""
    dealt = stage(signatures.select(F.explode("bands").alias("bucket"), "id"), "near-buckets")
    shared = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    members = dealt.join(shared.hint("merge"), "bucket", "left_semi")
    # merge joins at every size: signatures are shuffled, never broadcast
    side = lambda name: signatures.select(F.col("id").alias(name), F.col("signature").alias(f"s_{name}")).hint("merge")
    edges = []
    for turn in range(ROUNDS):
        # the same sets win in most of their buckets, so that few pairs differ
        first = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("rank"), "id"))
        pivots = members.groupBy("bucket").agg(first.alias("p")).select("bucket", F.col("p.id").alias("pivot"))
        against = stage(members.join(pivots.hint("merge"), "bucket").where("id <> pivot"), "near-against")
        pairs = against.select("pivot", "id").distinct().join(side("id"), "id").join(side("pivot"), "pivot")
        about = stage(pairs.select("pivot", "id", estimate("s_id", "s_pivot").alias("about")), "near-about")
        edges.append(about.where(F.col("about") >= MAYBE_NEAR).select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        apart = about.where(F.col("about") < SURELY_CLOSE).select("pivot", "id")
        members = stage(against.join(apart.hint("merge"), ["pivot", "id"], "left_semi").select("bucket", "id"), "near-left")
        if members.isEmpty():
            break
    else:
        least = members.groupBy("bucket").agg(F.min("id").alias("a"))
        edges.append(members.join(least.hint("merge"), "bucket").select("a", F.col("id").alias("b")))
    found = connected(reduce(DataFrame.unionByName, edges))
    return stage(found.select(F.col("label").alias("family"), F.col("node").alias("id")), "near-families")


def confirmed(table: pa.Table, square: bool) -> list[tuple[int, int]]:
    """Spanning links of a block: of all its sets (``square``), or of the sets of its
    left side with those of the right."""
    ids, n = (np.asarray(table.column(c).combine_chunks()) for c in ("id", "n"))
    side = np.asarray(table.column("side").combine_chunks())
    signatures = np.array(table.column("signature").combine_chunks().flatten(), np.int64).view(np.uint64).reshape(len(ids), -1)
    left = np.arange(len(ids)) if square else np.flatnonzero(side == 0)
    right = np.arange(len(ids)) if square else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    _, local = np.unique(np.frombuffer(b"".join(table.column("grams").to_pylist()), np.uint64), return_inverse=True)
    grams = np.split(local.ravel().astype(np.int64), np.cumsum(n)[:-1])
    # the index of the right side: places in it, ordered by gram
    owner = np.repeat(np.arange(len(right)), n[right])
    listed = np.concatenate([grams[r] for r in right])
    order = np.argsort(listed, kind="stable")
    owner, listed = owner[order], listed[order]
    signatures_right, sizes, ids_right = signatures[right], n[right].astype(np.int64), ids[right]
    # groups found so far; a set that stands on both sides has one label
    _, at = np.unique(ids, return_inverse=True)
    at = at.ravel()
    label = np.arange(at.max() + 1)
    done = np.zeros(len(label), bool)
    links = []
    for x in left:
        here, size = at[x], int(n[x])
        open_ = (label[at[right]] != label[here]) & ~done[at[right]]
        open_ &= (WHOLE * sizes >= SHARE * size) & (SHARE * sizes <= WHOLE * size)
        maybe = np.flatnonzero(open_)
        done[here] = square
        if not len(maybe):
            continue
        maybe = maybe[estimates(signatures[x], signatures_right[maybe]) >= MAYBE_LINKED]
        if not len(maybe):
            continue
        low, high = np.searchsorted(listed, grams[x]), np.searchsorted(listed, grams[x], "right")
        count = high - low
        place = np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)
        both = np.bincount(owner[place], minlength=len(right))[maybe]
        linked = maybe[WHOLE * both >= SHARE * (size + sizes[maybe] - both)]
        for y in linked:
            old, new = label[at[right[y]]], label[here]
            if old != new:
                links.append((int(ids[x]), int(ids_right[y])))
                label[label == old] = new
    return links


def family_links(members: DataFrame, signatures: DataFrame, every: DataFrame) -> DataFrame:
    """Spanning links ``a, b`` of all families."""
    held = stage(members.join(every.hint("merge"), "id").join(signatures.select("id", "signature").hint("merge"), "id"), "near-members")
    slim = held.select("family", "id", "n")
    sized = stage(slim.groupBy("family").agg(
        F.ceil(F.sum("n") / F.lit(BLOCK)).cast("int").alias("blocks"), F.min(F.struct(F.xxhash64("id").alias("rank"), "id")).alias("p"),
    ).select("family", "blocks", F.col("p.id").alias("pivot")), "near-sized")
    large = sized.where("blocks > 1")
    pivots = large.join(held.select("family", F.col("id").alias("pivot"), F.col("n").alias("pn"), F.col("grams").alias("pg")), ["family", "pivot"])
    against = held.join(pivots.drop("blocks").hint("merge"), "family").where("id <> pivot")

    def compare(batches):
        for batch in batches:
            both = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True))
                for x, y in zip(batch.column("grams").to_pylist(), batch.column("pg").to_pylist())
            ]
            n, m, both = np.asarray(batch.column("n"), np.int64), np.asarray(batch.column("pn"), np.int64), np.array(both, np.int64)
            linked = pa.array(WHOLE * both >= SHARE * (n + m - both))
            yield pa.record_batch([batch.column(c).filter(linked) for c in ("family", "pivot", "id")], ["family", "a", "b"])

    star = stage(against.select("family", "pivot", "id", "n", "pn", "grams", "pg").mapInArrow(compare, "family long, a long, b long"), "near-star")
    # what the pivot links, and the pivot, are one group: they need not meet again
    settled = star.select("family", F.col("b").alias("id"))
    odd = slim.join(large.drop("blocks"), "family").where("id <> pivot").join(settled.hint("merge"), ["family", "id"], "left_anti")
    rows = stage(odd.groupBy("family").agg(F.ceil(F.sum("n") / F.lit(BLOCK)).cast("int").alias("odd_blocks")), "near-odd")
    odd = odd.select("family", "id", F.lit(True).alias("odd"))
    place = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    spread_ = held.join(large.select("family", "blocks"), "family").join(rows, "family").join(odd.hint("merge"), ["family", "id"], "left")
    names = ["family", "x", "y", "side", "id", "n", "grams", "signature"]
    lefts = spread_.where("odd").select("*", place("odd_blocks").alias("x"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("y"), F.lit(0).alias("side"))
    rights = spread_.select("*", F.explode(F.sequence(F.lit(0), F.col("odd_blocks") - 1)).alias("x"), place("blocks").alias("y"), F.lit(1).alias("side"))
    single = held.join(sized.where("blocks = 1").select("family"), "family", "left_semi")
    single = single.select("*", F.lit(-1).alias("x"), F.lit(-1).alias("y"), F.lit(0).alias("side"))
    dealt = single.select(names).unionByName(lefts.select(names)).unionByName(rights.select(names))

    def work(key, table):
        links = confirmed(table, key[1].as_py() < 0)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    inside = dealt.groupBy("family", "x", "y").applyInArrow(work, "a long, b long")
    return stage(inside.unionByName(star.select("a", "b")), "near-links")


def grouped(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row a document."""
    rows = stage(signed(docs, k), "near-signed")
    signatures = stage(
        rows.where("signature IS NOT NULL").groupBy("id").agg(F.first("signature").alias("signature"), F.first("bands").alias("bands"), F.min("key").alias("key")),
        "near-signatures",
    )
    members = families(signatures)
    every = whole_sets(docs, _NO_ORDER, k, members.select("id"), signatures)
    labels = connected(family_links(members, signatures, every))
    least = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("least"))
    least = stage(least.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id")), "near-least")
    component = least.groupBy("label").agg(F.min("least").alias("component_id"))
    by_set = stage(least.join(component, "label").select("id", "component_id"), "near-by-set")
    return rows.select("doc_id", "n_shingles", "id").join(by_set, "id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def report(docs: DataFrame) -> DataFrame:
    return grouped(docs).select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
