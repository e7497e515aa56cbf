"""Periodic runs of words, by maximal pairs in a bottom-up LCP-interval tree.

A run is a stretch of words with smallest period q, at least ``repeats`` * q
words (and ``least`` words) long, that no neighbouring word extends with period
q. Its words but the last q occur again q words later, with other words on both
sides: the two places are a maximal pair. The other way round, each maximal pair
of places d apart whose common prefix is (repeats - 1) * d words or more is a run
of period d or of one of its divisors; of those with equal bounds the smallest d
is the period. So pairs are enumerated and nothing is extended.

In a task, several texts are handled together (long ones alone):

* Only places whose first words occur twice in their text are sorted: lexically by
  those words, then by doubling the compared length until no two are equal.
* A group of places that lie too far apart for the prefixes they share is passed
  over. In the others, common prefixes of neighbours follow from one walk in text
  order, and a stack joins the intervals of the LCP tree from the deepest up.
* A node keeps its places sorted, and one list of places for each left word. The
  smaller child's places look for partners within the distance that the node's
  depth allows; blocks of partners with the same left word are jumped over by
  that word's list. The work is O(n log n) steps and the runs found.

Texts never leave their row: nothing is shuffled, and memory follows the longest
text. Defined cases: a null text has no words; empty and wordless texts have no
runs and an empty ``collapsed``; rows that repeat are handled each for itself; a
null id stays null and counts as the empty text where ids are hashed; an empty
table gives no rows; extra columns, whatever their names, are ignored. Words are
compared by 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import WORD, chunks, words

#: A run has at least so many words, and so many times its period.
LEAST, REPEATS = 6, 4


class Places:
    """Places of a prefix in sorted order, and the same by their left word."""

    __slots__ = ("all", "lists")

    def __init__(self, place: int, left: int):
        self.all, self.lists = [place], {left: [place]}

    def others(self, place: int, left: int, reach: int):
        """Places within reach that have another left word."""
        every, same = self.all, self.lists.get(left)
        at, end = bisect_left(every, place - reach), bisect_right(every, place + reach)
        if same is None:
            yield from every[at:end]
            return
        mine = bisect_left(same, every[at]) if at < end else 0
        while at < end:
            if mine < len(same) and same[mine] == every[at]:
                # the block of places with this left word: both lists run in step
                step = 1
                while mine + step < len(same) and at + step < end and same[mine + step] == every[at + step]:
                    step *= 2
                low, high = step // 2, min(step, len(same) - mine, end - at)
                while low + 1 < high:
                    middle = (low + high) // 2
                    if same[mine + middle] == every[at + middle]:
                        low = middle
                    else:
                        high = middle
                at, mine = at + low + 1, mine + low + 1
            else:
                yield every[at]
                at += 1

    def take(self, other: Places) -> None:
        for left, places in other.lists.items():
            mine = self.lists.get(left)
            if mine is None:
                self.lists[left] = places
            elif len(places) < 8:
                for place in places:
                    insort(mine, place)
            else:
                mine.extend(places)
                mine.sort()
        if len(other.all) < 8:
            for place in other.all:
                insort(self.all, place)
        else:
            self.all.extend(other.all)
            self.all.sort()


def join(a: Places, b: Places, depth: int, least: int, repeats: int, found: list) -> Places:
    """One node of two; the maximal pairs between them that are runs go to ``found``."""
    if len(a.all) < len(b.all):
        a, b = b, a
    reach = depth // (repeats - 1)
    for left, places in b.lists.items():
        for place in places:
            for other in a.others(place, left, reach):
                period = abs(place - other)
                if depth + period >= least:
                    found.append((min(place, other), depth + period, period))
    a.take(b)
    return a


def enumerate_pairs(places, prefixes, lefts, least: int, repeats: int, shortest: int, found: list) -> None:
    """Runs of sorted places; ``prefixes[k]`` is the common prefix of places k - 1 and k."""
    stack = []
    last = Places(places[0], lefts[0])
    for place, prefix, left in zip([*places[1:], None], [*prefixes[1:], 0], [*lefts[1:], None]):
        while stack and stack[-1][0] > prefix:
            depth, node = stack.pop()
            last = join(node, last, depth, least, repeats, found)
        if prefix < shortest:
            stack.clear()
        elif stack and stack[-1][0] == prefix:
            stack[-1][1] = join(stack[-1][1], last, prefix, least, repeats, found)
        else:
            stack.append([prefix, last])
        if place is not None:
            last = Places(place, left)


def candidates(symbols: np.ndarray, first: np.ndarray, shortest: int, repeats: int):
    """Groups of places that share ``shortest`` words within a text, sorted as
    suffixes: (places, group bounds). Groups without a close enough pair are left out."""
    n = len(symbols)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(first[1:], counts)
    place = np.arange(n)
    padded = np.concatenate([symbols, np.full(shortest, -1, np.int64)])
    gram = text.astype(np.uint64)
    for j in range(shortest):
        word = np.where(place + j < end, padded[j: j + n], -1)
        gram = (gram ^ word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
    inside = np.flatnonzero(place + shortest <= end)
    order = inside[np.argsort(gram[inside], kind="stable")]
    same = gram[order[1:]] == gram[order[:-1]]
    repeated = np.zeros(n + 1, bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    kept = np.flatnonzero(repeated)
    if not len(kept):
        return kept, np.zeros(1, np.int64)
    used = repeated.copy()
    used[kept + shortest] = True
    used[n] = False
    used = np.flatnonzero(used)
    columns = [np.where(used + j < end[used], padded[used + j], -1) for j in range(shortest)]
    columns = [text[used], *columns]
    order = np.lexsort(columns[::-1])
    used, columns = used[order], [c[order] for c in columns]
    fresh = np.ones(len(used), bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.flatnonzero(fresh)
    rank = np.full(n + 1, -1, np.int64)
    rank[used] = np.repeat(starts, np.diff([*starts, len(used)]))
    group = rank[used].copy()
    # groups are sorted by what follows, twice as far each time
    span = np.full(len(used), shortest, np.int64)
    length = shortest
    while True:
        sizes = np.bincount(rank[used], minlength=len(used))
        tied = np.flatnonzero(sizes[rank[used]] > 1)
        if not len(tied):
            break
        at = used[tied]
        follow = np.where(at + length < end[at], rank[np.minimum(at + length, n)], -1)
        order = np.lexsort((follow, rank[at]))
        at, follow = at[order], follow[order]
        used[tied] = at
        own = rank[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])
        starts = np.flatnonzero(fresh)
        rank[at] = np.repeat(tied[starts], np.diff([*starts, len(at)]))
        span[tied] = length
        length *= 2
    # a group of one is no group; in the others, the closest pair and the longest
    # shared prefix (below twice the last compared length) must fit
    bounds = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    by_place = used[np.lexsort((used, group))]
    gaps = np.full(len(used), n + 1)
    gaps[1:] = np.where(group[1:] == group[:-1], np.diff(by_place), n + 1)
    closest = np.minimum.reduceat(gaps, bounds[:-1])
    longest = 2 * np.maximum.reduceat(span, bounds[:-1])
    fit = np.flatnonzero((np.diff(bounds) > 1) & (longest >= (repeats - 1) * closest))
    lengths = np.diff(bounds)[fit]
    inner = np.concatenate([[0], np.cumsum(lengths)])
    rows = np.arange(inner[-1]) - np.repeat(inner[:-1] - bounds[fit], lengths)
    return used[rows], inner


def find_runs(hashes: np.ndarray, first: np.ndarray, least: int = LEAST, repeats: int = REPEATS):
    """Runs of all texts: arrays of start (as place among all words), length, period."""
    # the shortest common prefix that a pair of any distance needs
    shortest = min(max(least - d, (repeats - 1) * d) for d in range(1, least + 1))
    _, symbols = np.unique(hashes, return_inverse=True)
    symbols = symbols.ravel().astype(np.int64)
    places, bounds = candidates(symbols, first, shortest, repeats)
    found: list = []
    if len(places):
        before = np.full(len(places), -1, np.int64)
        before[1:] = places[:-1]
        before[bounds[:-1]] = -1
        in_order = np.argsort(places)
        ends = first[np.searchsorted(first, places[in_order], "right")]
        text = symbols.tolist()
        prefix = np.zeros(len(places), np.int64)
        previous, shared = -2, 0
        for k, i, j, stop in zip(in_order.tolist(), places[in_order].tolist(), before[in_order].tolist(), ends.tolist()):
            shared = max(shared - 1, shortest) if i == previous + 1 else shortest
            previous = i
            if j < 0:
                shared = 0
                continue
            i, j = i + shared, j + shared
            if j > i:
                i, j = j, i
            begin = i
            while i < stop and text[i] == text[j]:
                i, j = i + 1, j + 1
            shared += i - begin
            prefix[k] = shared
        starts = np.zeros(len(symbols), bool)
        starts[first[:-1][np.diff(first) > 0]] = True
        lefts = np.where(starts[places], -1, symbols[np.maximum(places - 1, 0)])
        places, prefix, lefts = places.tolist(), prefix.tolist(), lefts.tolist()
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            enumerate_pairs(places[low:high], prefix[low:high], lefts[low:high], least, repeats, shortest, found)
    runs = np.array(sorted(found), np.int64).reshape(-1, 3)
    once = np.ones(len(runs), bool)
    once[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[once]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


RUN = "struct<start: long, length: long, period: long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: its runs by start and
    period, and its words joined by one space, without those that a run holds
    after its first period."""
    if least < 2 or repeats < 2:
        raise ValueError("runs have at least two periods and two words")

    def work(batches):
        for texts in chunks(batches):
            begins, closes, hashes, first = words(texts, lower=False)
            runs = find_runs(hashes, first, least, repeats)
            edges = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
            np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(edges)[:-1] == 0)
            data = texts.data.tobytes()
            parts = [data[a:b] for a, b in zip(begins[kept].tolist(), closes[kept].tolist())]
            cut = np.searchsorted(kept, first).tolist()
            collapsed = [b" ".join(parts[a:b]).decode() for a, b in zip(cut, cut[1:])]
            owner = np.searchsorted(first, runs[:, 0], "right") - 1
            owner_first = first[owner]
            offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - owner_first), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(_RUN)
            )
            yield pa.record_batch(
                [texts.batch.column("doc_id"), pa.array(np.diff(first).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), items), pa.array(collapsed, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string"
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in a tenth of the documents (by a hash of the id) the words
    from some place on repeat with one period, as the contract of the query says."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    every = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))

    def repeated(found: Column) -> Column:
        n = F.size(found)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (3 + g % 8))).cast("int")
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        taken = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(found, at(i).cast("int")))
        return F.when(n > 0, F.array_join(taken, " ")).otherwise(F.lit(""))

    # a lambda over a one-element array: the words are cut once, not once a use
    changed = F.element_at(F.transform(F.array(every), repeated), 1)
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    found = periodic_runs(with_planted_periods(docs))
    none = F.expr(f"CAST(NULL AS {RUN})")
    # exact comparison of length / period; runs come by start and period
    best = F.reduce(
        "runs", none,
        lambda a, r: F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
