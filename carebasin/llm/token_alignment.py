"""Alignment of two tokenizers' tokens through sparse incidence matrices.

A text is encoded by both; each token covers a range of its bytes. The ranges are
rows of an incidence matrix tokens x bytes in compressed rows (CSR), built by hand.

* **Overlap links.** Gustavson's row products give A * B': row by row, the bytes of
  an A token fetch the B tokens that cover them; the value is the number of bytes
  that both cover.
* **Groups.** In row order the links form a staircase. Where both its coordinates
  change, an A and a B token ended at the same byte: there the next group begins.
* **Shared-group links.** A second pair of matrices has a row for each token id of a
  document and a column for each group, with the times the id occurs in the group. Their
  product gives, for each pair of ids, how many pairs of occurrences share a group.

Products are formed in blocks of rows with a bounded number of terms; texts of a
batch are handled together, long ones alone, so memory follows the longest text.

``score_links`` weighs a corpus' links: in how many documents each id pair is linked,
counted in tasks before the shuffle. The counts of the most frequent pairs (at most
``HOT``, chosen by a histogram of counts) are sent to all tasks; links of the other
pairs are joined by shuffle, so that no table that grows with the data is broadcast.

Defined cases: null and empty texts, and texts whose tokens do not spell a space and
the text, have no tokens, no groups and no links; repeated rows are documents of
their own; a null id stays null; an empty table gives no rows; extra columns,
whatever their names, are ignored. Texts of ``LONG`` characters and more are encoded
by the other library with the same vocabulary, as the fast one's pattern matcher may
run out of stack there.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import chunks
from carebasin.sources.writers import stage

VOCABULARIES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
#: Id pairs whose counts are sent to all tasks: 24 bytes each.
HOT = 1 << 19
#: Characters from which a text is encoded by the slower library.
LONG = 100_000
#: Terms of a product that are formed together.
TERMS = 1 << 20
#: Distinct id pairs that a task counts before it gives them on.
COUNTED = 1 << 21


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return tuple(public_tokenizers.path(name) for name in VOCABULARIES)


# -- tokenizers ----------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, the others
    counted on from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class ByteLevel:
    """Byte-level merges; the bytes of each id in ``spelled``."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in entry): id_ for entry, id_ in vocabulary.items() if all(c in letters for c in entry)}
        self.fast = tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spelled = [b""] * (max(ranks.values()) + 1)
        for entry, id_ in ranks.items():
            self.spelled[id_] = entry

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [
            self.fast.encode_ordinary(" " + text) if len(text) < LONG
            else self.slow.encode(" " + text, add_special_tokens=False).ids
            for text in texts
        ]


class Pieces:
    """Merged pieces with byte fallback, which put a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.spelled = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in enumerate(self.model.id_to_piece(k) for k in range(size))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


@lru_cache(maxsize=2)
def tokenizers(paths: tuple[str, str]) -> tuple[ByteLevel, Pieces]:
    """Loaded once a worker."""
    return ByteLevel(paths[0]), Pieces(paths[1])


# -- sparse matrices -----------------------------------------------------------------


class Rows:
    """A sparse matrix in compressed rows."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.starts, self.columns, self.values, self.width = starts, columns, values, width

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int, width: int) -> Rows:
        """From entries in any order; those of one place are added."""
        key = rows * np.int64(width) + columns
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        key, values = key[first], np.add.reduceat(values, first) if len(first) else values
        starts = np.searchsorted(key, np.arange(height + 1) * np.int64(width))
        return cls(starts, key % width if width else key, values, width)

    @classmethod
    def ranges(cls, lengths: np.ndarray) -> Rows:
        """Row k holds the columns of the k-th of consecutive ranges."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        total = int(starts[-1])
        return cls(starts, np.arange(total), np.ones(total, np.int64), total)

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Rows(starts, self.row_of_entry()[order], self.values[order], self.height)

    def part(self, low: int, high: int) -> Rows:
        a, b = self.starts[low], self.starts[high]
        return Rows(self.starts[low: high + 1] - a, self.columns[a:b], self.values[a:b], self.width)


def product(left: Rows, right: Rows) -> Rows:
    """left * right by row products: each entry (i, k) of the left adds its multiple of
    the right's row k to row i. Rows are taken in blocks of about ``TERMS`` terms."""
    fan = np.diff(right.starts)
    terms = np.concatenate([[0], np.cumsum(fan[left.columns])])[left.starts]
    parts, low = [], 0
    while low < left.height:
        high = max(low + 1, int(np.searchsorted(terms, terms[low] + TERMS, "right")) - 1)
        block = left.part(low, high)
        count = fan[block.columns]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) - np.repeat(ends - count - right.starts[block.columns], count)
        rows = np.repeat(block.row_of_entry(), count)
        values = np.repeat(block.values, count) * right.values[place]
        parts.append(Rows.of(rows, right.columns[place], values, high - low, right.width))
        low = high
    if len(parts) == 1:
        return parts[0]
    shift = np.cumsum([0, *(len(p.columns) for p in parts)])
    starts = np.concatenate([[0], *(p.starts[1:] + s for p, s in zip(parts, shift))])
    empty = np.zeros(0, np.int64)
    return Rows(
        starts.astype(np.int64), np.concatenate([empty, *(p.columns for p in parts)]),
        np.concatenate([empty, *(p.values for p in parts)]), right.width,
    )


class Alignment:
    """Links of some texts, given one after the other.

    ``a`` and ``b`` are the token ids, ``a_bytes`` and ``b_bytes`` their numbers of bytes (equal in
    total for each text), ``a_first`` and ``b_first`` the place of each text's first
    token (one more at the end).
    """

    def __init__(self, a, b, a_bytes, b_bytes, a_first, b_first, widths):
        self.overlaps = product(Rows.ranges(a_bytes), Rows.ranges(b_bytes).transposed())
        row, column = self.overlaps.row_of_entry(), self.overlaps.columns
        begins = np.ones(len(row), bool)
        begins[1:] = (row[1:] != row[:-1]) & (column[1:] != column[:-1])
        group = np.cumsum(begins) - 1
        self.n_groups = int(begins.sum())
        self.a_group = np.zeros(len(a), np.int64)
        self.b_group = np.zeros(len(b), np.int64)
        self.a_group[row], self.b_group[column] = group, group
        n = len(a_first) - 1
        # the groups of a text are those of its A tokens
        last = np.concatenate([self.a_group, [self.n_groups]])
        self.group_first = last[np.minimum(a_first, len(a))]
        text = np.repeat(np.arange(n), np.diff(a_first))
        ids, place = np.unique(text * np.int64(widths[0]) + a, return_inverse=True)
        ones = np.ones(max(len(a), len(b)), np.int64)
        by_id = Rows.of(place.ravel(), self.a_group, ones[: len(a)], len(ids), self.n_groups)
        by_group = Rows.of(self.b_group, b, ones[: len(b)], self.n_groups, widths[1])
        links = product(by_id, by_group)
        rows = links.row_of_entry()
        #: Linked id pairs of each text, as A id * widths[1] + B id, with the links of each.
        self.pairs = (ids % widths[0])[rows] * np.int64(widths[1]) + links.columns
        self.links = links.values
        self.pair_first = np.searchsorted((ids // widths[0])[rows], np.arange(n + 1))

    def spelled_groups(self, a, b, names) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each text: ids by group."""
        both = np.concatenate([a, b])
        side = np.concatenate([self.a_group * 2, self.b_group * 2 + 1])
        order = np.argsort(side, kind="stable")
        side, both = side[order], both[order]
        following = np.concatenate([side[1:], [-1]])
        # what comes after a token: the same side, the other side, another group
        kind = np.where(side == following, 0, np.where(side % 2 == 0, 1, 2))
        parts = names[kind, both].tolist()
        cut = np.searchsorted(side, self.group_first * 2).tolist()
        return ["".join(parts[x:y])[:-1] for x, y in zip(cut, cut[1:])]


@lru_cache(maxsize=1)
def _names(size: int) -> np.ndarray:
    return np.array([[f"{k}{end}" for k in range(size)] for end in ",|;"], object)


def align(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_overlaps, n_groups, n_links, groups, pairs, links``: the
    groups as text, the linked id pairs (A id * size of B + B id), and how many links each has."""
    paths = tuple(paths or default_paths())

    def work(batches):
        fast, pieces = tokenizers(paths)
        spelled = fast.spelled, pieces.spelled
        widths = tuple(len(s) for s in spelled)
        lengths = [np.array([len(x) for x in s], np.int64) for s in spelled]
        names = _names(max(widths))
        for texts in chunks(batches, limit=1 << 20):
            given = texts.batch.column("text").to_pylist()
            rows = [k for k, text in enumerate(given) if text]
            found = zip(rows, fast.encode([given[k] for k in rows]), pieces.encode([given[k] for k in rows]))
            tokens: list[tuple[list[int], list[int]]] = [([], [])] * len(given)
            for k, a, b in found:
                whole = (" " + given[k]).encode()
                if all(b"".join(map(s.__getitem__, ids)) == whole for s, ids in zip(spelled, (a, b))):
                    tokens[k] = a, b
            first = [np.cumsum([0, *(len(t[side]) for t in tokens)]) for side in (0, 1)]
            ids = [np.fromiter((x for t in tokens for x in t[side]), np.int64, first[side][-1]) for side in (0, 1)]
            aligned = Alignment(*ids, lengths[0][ids[0]], lengths[1][ids[1]], *first, widths)
            total = np.concatenate([[0], np.cumsum(aligned.links)])
            overlaps = aligned.overlaps.starts[first[0]]
            cut = pa.array(aligned.pair_first.astype(np.int32))
            yield pa.record_batch(
                [texts.batch.column("doc_id"), *(pa.array(np.diff(x)) for x in (*first, overlaps, aligned.group_first)),
                 pa.array(np.diff(total[aligned.pair_first])),
                 pa.array(aligned.spelled_groups(*ids, names), pa.string()),
                 pa.ListArray.from_arrays(cut, pa.array(aligned.pairs)), pa.ListArray.from_arrays(cut, pa.array(aligned.links))],
                ["doc_id", "n_a", "n_b", "n_overlaps", "n_groups", "n_links", "groups", "pairs", "links"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, n_a long, n_b long, n_overlaps long, n_groups long, n_links long, "
        "groups string, pairs array<long>, links array<long>",
    )


# -- weights of links over a corpus -----------------------------------------------------


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: documents that hold the pair linked, and whether no pair of
    its A id is held by more."""

    def count(batches):
        held, size = [], 0

        def report():
            pairs, n = (np.concatenate(x) for x in zip(*held))
            unique, place = np.unique(pairs, return_inverse=True)
            return unique, np.bincount(place.ravel(), n, len(unique)).astype(np.int64)

        def given(part):
            return pa.record_batch([pa.array(part[0]), pa.array(part[1])], ["pair", "n"])

        for batch in batches:
            pairs = np.asarray(batch.column("pairs").flatten(), np.int64)
            held.append((pairs, np.ones(len(pairs), np.int64)))
            size += len(pairs)
            if size >= COUNTED:
                merged = report()
                if len(merged[0]) >= COUNTED // 2:
                    yield given(merged)
                    held, size = [], 0
                else:
                    held, size = [merged], len(merged[0])
        if held:
            yield given(report())

    counted = aligned.select("pairs").mapInArrow(count, "pair long, n long")
    counts = stage(counted.groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    # a row for each id of the first vocabulary: its size bounds what is sent along
    highest = counts.groupBy(F.floor(F.col("pair") / width).alias("a")).agg(F.max("n").alias("top"))
    marked = counts.withColumn("a", F.floor(F.col("pair") / width)).join(F.broadcast(highest), "a")
    return stage(marked.select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "align-pairs")


def frequent(counts: DataFrame, limit: int = HOT) -> DataFrame:
    """The pairs above the smallest count that at most ``limit`` pairs exceed. Counts
    are read off a histogram with steps of less than a hundredth."""
    step = F.when(F.col("n") < 128, F.col("n")).otherwise(F.floor(F.log2(F.col("n").cast("double")) * 100)).cast("long")
    rows = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    total, least = 0, None
    for row in sorted(rows, key=lambda r: -r.step):
        total += row.pairs
        if total > limit:
            break
        least = row.step
    return counts.where(step >= F.lit(least)) if least is not None else counts.limit(0)


def score_links(aligned: DataFrame, width: int, limit: int = HOT) -> DataFrame:
    """The staged rows with a unique ``row``, plus ``n_best`` and ``count_sum``."""
    counts = pair_counts(aligned, width)
    top = frequent(counts, limit).toArrow()
    hot, hot_n, hot_best = (np.asarray(top.column(c).combine_chunks()) for c in ("pair", "n", "best"))
    order = np.argsort(hot)
    hot, hot_n, hot_best = hot[order].astype(np.int64), hot_n[order].astype(np.int64), hot_best[order].astype(np.int64)

    def rate(batches):
        for batch in batches:
            size = batch.num_rows
            lists = batch.column("pairs")
            pairs, links = np.asarray(lists.flatten(), np.int64), np.asarray(batch.column("links").flatten(), np.int64)
            lengths = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            row = np.repeat(np.arange(size), lengths)
            at = np.minimum(np.searchsorted(hot, pairs), max(len(hot) - 1, 0))
            known = hot[at] == pairs if len(hot) else np.zeros(len(pairs), bool)
            best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
            if len(hot):
                np.add.at(best, row[known], (hot_best[at] * links)[known])
                np.add.at(total, row[known], (hot_n[at] * links)[known])
            rest = np.flatnonzero(~known)
            cut = pa.array(np.searchsorted(row[rest], np.arange(size + 1)).astype(np.int32))
            yield pa.record_batch(
                [batch.column("row"), pa.array(best), pa.array(total),
                 pa.ListArray.from_arrays(cut, pa.array(pairs[rest])), pa.ListArray.from_arrays(cut, pa.array(links[rest]))],
                ["row", "n_best", "count_sum", "pairs", "links"],
            )

    rated = stage(
        aligned.select("row", "pairs", "links").mapInArrow(
            rate, "row long, n_best long, count_sum long, pairs array<long>, links array<long>"
        ),
        "align-rated",
    )
    rest = rated.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", "x.pairs", "x.links")
    joined = rest.withColumnRenamed("pairs", "pair").join(counts.hint("merge"), "pair")
    more = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(F.lit(0))).alias("more_best"),
        F.sum(F.col("n") * F.col("links")).alias("more_sum"),
    )
    scores = rated.select("row", "n_best", "count_sum").join(more, "row", "left").select(
        "row", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )
    return aligned.drop("pairs", "links").join(scores, "row")


def report(docs: DataFrame, paths: tuple[str, str] | None = None, limit: int = HOT) -> DataFrame:
    paths = tuple(paths or default_paths())
    width = len(tokenizers(paths)[1].spelled)
    found = align(docs, paths).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit("")).alias("groups_sha256"),
        "pairs", "links",
    )
    return score_links(stage(found, "align-tokens"), width, limit).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
