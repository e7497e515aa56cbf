"""Language-model scores of texts from a subword lattice.

An existing vocabulary gives the pieces and their scores. A word, led by the
word mark, can be cut into pieces in many ways; the probability of a word is the
sum over all ways, found by a forward recursion in log space over the byte
places of the word. A text is its words and one end, so its log probability is
the sum of theirs.

The vocabulary's scores are merge ranks (0 best); a piece of rank r starts with
a weight of 1 / (r + ``SHIFT``), and a byte piece with the least weight. The
corpus then reweights the pieces: expected piece counts over all ways of all
distinct training words (one forward-backward pass, weighted by the words'
counts) are added to ``PRIOR`` times the starting weights.

Word counts of the corpus are tables and grow with it. The most frequent
words, ``TOP`` at most, travel to the tasks as a table of fixed size; all other words of the
texts are counted per text and joined with the counts, and their parts of the
base score are summed up again, so the result does not depend on ``TOP``.

Defined cases: a null or empty text is its end alone; every byte string has a
probability, as bytes are pieces; without training rows all counts are 0 and the
starting weights stand. Rows that repeat id and text are scored alike. Words are
told apart by 64-bit hashes. Extra columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import LOWERED, Texts, chunks, fold, most_frequent, row_key, words
from carebasin.sources.writers import stage

#: The vocabulary, a sentencepiece model among the installed public tokenizers.
VOCABULARY = "piece_bpe_32k.model"
SHIFT = 10.0
PRIOR = 1e4
#: Most frequent words that travel to the tasks: 16 bytes each.
TOP = 1 << 17
#: Words longer than this are scored one by one.
LONG = 48
#: Scores of words kept in a task.
CACHE = 500_000
#: The vocabulary's word mark, and the byte that stands for it here: no UTF-8
#: text holds that byte.
PIECE_MARK, MARK = "▁", b"\xff"
#: Slots of the piece table, a power of two.
SLOT_BITS = 19
END = 0  # the hash of the end token

_STEP, _SPREAD, _ALL = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, (1 << 64) - 1


@cache
def vocabulary(path: str) -> tuple[tuple[bytes, ...], tuple[float, ...]]:
    """Pieces as bytes and their starting log weights (natural), normalised.
    Every byte is a piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    least = 1.0 / (model.get_piece_size() + SHIFT)
    weights: dict[bytes, float] = {}
    for k in range(256):  # with the mark's byte
        weights[bytes([k])] = least
    for k in range(model.get_piece_size()):
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)):
            parts = map(str.encode, model.id_to_piece(k).split(PIECE_MARK))
            weights[MARK.join(parts)] = 1.0 / (max(0.0, -model.get_score(k)) + SHIFT)
    total = sum(weights.values())
    pieces = tuple(weights)
    return pieces, tuple(float(np.log(weights[p] / total)) for p in pieces)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Lattice:
    """Sums over the ways to cut words into pieces."""

    def __init__(self, pieces, logs):
        self.pieces = pieces
        self.logs = np.asarray(logs)
        self.place = {p: k for k, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        # an open table from 64-bit hashes of pieces to their numbers
        size = 1 << SLOT_BITS
        self.keys, self.numbers = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        for number, piece in enumerate(pieces):
            h = 0
            for byte in piece:
                h = (h + byte + 1) * _STEP & _ALL
            slot = (h * _SPREAD & _ALL) >> 64 - SLOT_BITS
            while self.numbers[slot] >= 0:
                slot = (slot + 1) % size
            self.keys[slot], self.numbers[slot] = h, number

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes; -1 for none."""
        place = ((hashes * np.uint64(_SPREAD)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        held = self.keys[place]
        out = np.where(held == hashes, self.numbers[place], np.int32(-1))
        # few meet a slot that holds another piece and go on to the next one
        rows = np.flatnonzero((held != hashes) & (held != 0))
        while len(rows):
            place[rows] = (place[rows] + 1) & ((1 << SLOT_BITS) - 1)
            held = self.keys[place[rows]]
            hit = held == hashes[rows]
            out[rows[hit]] = self.numbers[place[rows[hit]]]
            rows = rows[~hit & (held != 0)]
        return out

    def edges(self, word: bytes):
        """(begin, end, piece) of all pieces inside a word, by end."""
        get, longest = self.place.get, self.longest
        return [
            (i, j, k)
            for j in range(1, len(word) + 1)
            for i in range(max(0, j - longest), j)
            if (k := get(word[i:j])) is not None
        ]

    def forward(self, word: bytes, edges) -> list[float]:
        """Log sums of all ways to reach each place of the word."""
        logs, reach = self.logs, [0.0] + [-np.inf] * len(word)
        at = 0
        for j in range(1, len(word) + 1):
            terms = []
            while at < len(edges) and edges[at][1] == j:
                terms.append(reach[edges[at][0]] + logs[edges[at][2]])
                at += 1
            top = max(terms)
            reach[j] = top + np.log(np.exp(np.array(terms) - top).sum()) if len(terms) > 1 else top
        return reach

    def _batch(self, group: list[bytes]):
        """By begin and end, the words of one length that have a piece there, and
        the pieces' numbers."""
        size = len(group[0])
        data = np.frombuffer(b"".join(group), np.uint8).reshape(len(group), size).T.astype(np.uint64) + np.uint64(1)
        spans = {}
        for i in range(size):
            h = np.zeros(len(group), np.uint64)
            for j in range(i + 1, min(size, i + self.longest) + 1):
                h = (h + data[j - 1]) * np.uint64(_STEP)
                found = self.lookup(h)
                rows = np.flatnonzero(found >= 0)
                if len(rows):
                    spans[i, j] = rows, found[rows]
        return spans

    def _pass(self, group, spans):
        """Log sums of all ways to reach each place of the words."""
        reach = np.full((len(group[0]) + 1, len(group)), -np.inf)
        reach[0] = 0.0
        for (i, j), (rows, found) in sorted(spans.items(), key=lambda x: x[0][1]):
            reach[j, rows] = np.logaddexp(reach[j, rows], reach[i, rows] + self.logs[found])
        return reach

    def score(self, given: list[bytes]) -> np.ndarray:
        """Log probabilities (natural) of words, the mark in front."""
        out = np.empty(len(given))
        marked = [MARK + w for w in given]
        for length, rows in by_length(marked).items():
            if length > LONG:
                for r in rows:
                    out[r] = self.forward(marked[r], self.edges(marked[r]))[-1]
            else:
                group = [marked[r] for r in rows]
                out[rows] = self._pass(group, self._batch(group))[-1]
        return out

    def expected(self, given: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected counts of all pieces over words with counts."""
        total = np.zeros(len(self.pieces))
        marked = [MARK + w for w in given]
        for length, rows in by_length(marked).items():
            if length > LONG:
                for r in rows:
                    self._expect_long(marked[r], float(counts[r]), total)
                continue
            group = [marked[r] for r in rows]
            spans = self._batch(group)
            reach = self._pass(group, spans)
            back = np.full((length + 1, len(group)), -np.inf)
            back[length] = 0.0
            for (i, j), (which, found) in sorted(spans.items(), key=lambda x: -x[0][0]):
                back[i, which] = np.logaddexp(back[i, which], self.logs[found] + back[j, which])
            weight = counts[rows].astype(float)
            for (i, j), (which, found) in spans.items():
                way = reach[i, which] + self.logs[found] + back[j, which] - reach[length, which]
                total += np.bincount(found, np.exp(way) * weight[which], len(total))
        return total

    def _expect_long(self, word: bytes, count: float, total: np.ndarray) -> None:
        edges = self.edges(word)
        reach, back = self.forward(word, edges), [-np.inf] * len(word) + [0.0]
        for i, j, k in sorted(edges, reverse=True):
            back[i] = float(np.logaddexp(back[i], self.logs[k] + back[j]))
        for i, j, k in edges:
            total[k] += count * np.exp(reach[i] + self.logs[k] + back[j] - reach[-1])


def by_length(given: list[bytes]) -> dict[int, np.ndarray]:
    lengths = np.fromiter(map(len, given), np.int64, len(given))
    order = np.argsort(lengths, kind="stable")
    values, first = np.unique(lengths[order], return_index=True)
    return dict(zip(values.tolist(), np.split(order, first[1:])))


def tallies(texts: Texts):
    """Distinct words of a piece of texts: hashes, bytes; and per text and word
    (row, place of word, count); and the number of words of each text."""
    starts, ends, hashes, first = words(texts)
    unique, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    lowered = LOWERED[texts.data].tobytes()
    given = [lowered[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
    n = np.diff(first)
    row = np.repeat(np.arange(len(texts)), n)
    pair, count = np.unique(row * max(1, len(unique)) + inverse.ravel(), return_counts=True)
    return unique, given, pair // max(1, len(unique)), pair % max(1, len(unique)), count, n


def count_words(docs: DataFrame) -> DataFrame:
    """``hash, word, n`` of all words, and the end token once for each row."""

    def count(batches):
        held: dict[int, list] = {}
        rows = 0

        def report():
            hashes = np.fromiter(held, np.uint64, len(held)).view(np.int64)
            return pa.record_batch(
                [pa.array(hashes), pa.array([x[0] for x in held.values()], pa.binary()), pa.array([x[1] for x in held.values()], pa.int64())],
                ["hash", "word", "n"],
            )

        for texts in chunks(batches):
            rows += len(texts)
            unique, given, _, place, counts, _ = tallies(texts)
            total = np.bincount(place, counts, len(unique)).astype(np.int64)
            for h, w, n in zip(unique.tolist(), given, total.tolist()):
                if h in held:
                    held[h][1] += n
                else:
                    held[h] = [w, n]
            if len(held) > 200_000:
                yield report()
                held.clear()
        if held:
            yield report()
        if rows:
            yield pa.record_batch([pa.array([END], pa.int64()), pa.array([b""], pa.binary()), pa.array([rows], pa.int64())], ["hash", "word", "n"])

    parts = docs.select("text").mapInArrow(count, "hash long, word binary, n long")
    return parts.groupBy("hash").agg(F.first("word").alias("word"), F.sum("n").alias("n"))


def reweighted(counts: DataFrame, pieces, logs) -> Lattice:
    """The lattice with pieces reweighted by their expected counts in the corpus."""
    start = Lattice(pieces, logs)

    def expect(batches):
        total = np.zeros(len(pieces))
        for batch in batches:
            if batch.num_rows:
                total += start.expected(batch.column("word").to_pylist(), np.asarray(batch.column("n")))
        full = np.flatnonzero(total)
        if len(full):
            yield pa.record_batch([pa.array(full), pa.array(total[full])], ["piece", "n"])

    found = counts.where(F.col("hash") != END).select("word", "n").mapInArrow(expect, "piece long, n double")
    # sums of whole parts, so that a rerun agrees to the last digit
    fixed = F.sum(F.round(F.col("n") * 4096).cast("decimal(38,0)"))
    rows = found.groupBy("piece").agg(fixed.cast("double").alias("n")).toArrow()
    expected = np.exp(np.asarray(logs)) * PRIOR
    if rows.num_rows:
        expected[np.asarray(rows.column("piece").combine_chunks())] += np.asarray(rows.column("n").combine_chunks()) / 4096
    return Lattice(pieces, np.log(expected / expected.sum()))


def score_texts(docs: DataFrame, training: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of all rows."""
    pieces, logs = vocabulary(path or default_path())
    counts = stage(count_words(training), "lm-counts")
    totals = counts.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(F.col("hash") == END, F.col("n")))).first()
    n_all, distinct, n_ends = (int(x or 0) for x in totals)
    below = np.log10(n_all + 0.5 * (distinct + 1))
    lattice = reweighted(counts, pieces, logs)
    final = lattice.logs
    # a text goes on or ends after each word, as often as the training texts did
    going = np.log((n_all - n_ends + 1) / (n_all + 2))
    ending = np.log((n_ends + 1) / (n_all + 2))
    top = most_frequent(counts.where(F.col("hash") != END).select("hash", "n"), TOP).toArrow()
    top_hash = np.asarray(top.column("hash").combine_chunks(), np.int64).view(np.uint64)
    order = np.argsort(top_hash)
    top_hash, top_n = top_hash[order], np.asarray(top.column("n").combine_chunks(), np.int64)[order]
    log_end = float(np.log10(n_ends + 0.5) - below)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, key long, n_tokens long, known long, base double, score double, hash long, times long"
    names = ["doc_id", "key", "n_tokens", "known", "base", "score", "hash", "times"]

    def rate(batches):
        model = Lattice(pieces, final)
        scored: dict[int, float] = {}
        for texts in chunks(batches):
            unique, given, row, place, count, n = tallies(texts)
            hashes = unique.tolist()
            if len(scored) > CACHE:
                scored.clear()
            fresh = [k for k, h in enumerate(hashes) if h not in scored]
            scored.update(zip((hashes[k] for k in fresh), model.score([given[k] for k in fresh]).tolist()))
            logp = np.fromiter((scored[h] for h in hashes), np.float64, len(hashes))
            rows = len(texts)
            score = np.bincount(row, (logp[place] + going) * count, rows) + ending
            at = np.minimum(np.searchsorted(top_hash, unique), max(0, len(top_hash) - 1))
            common = top_hash[at] == unique if len(top_hash) else np.zeros(len(unique), bool)
            part = np.where(common, np.log10((top_n[at] if len(top_hash) else np.zeros(len(unique))) + 0.5) - below, 0.0)
            base = np.bincount(row, part[place] * count, rows) + log_end
            known = np.bincount(row, common[place] * count, rows).astype(np.int64) + (n_ends > 0)
            key = texts.batch.column("key")
            blank = pa.nulls(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                texts.batch.column("doc_id"), key, pa.array(n + 1), pa.array(known), pa.array(base),
                pa.array(score / np.log(10)), blank, blank,
            ], names)
            rare = np.flatnonzero(~common[place])
            if len(rare):
                none = lambda t: pa.nulls(len(rare), t)
                yield pa.RecordBatch.from_arrays([
                    none(texts.batch.column("doc_id").type), key.take(pa.array(row[rare])), none(pa.int64()), none(pa.int64()),
                    none(pa.float64()), none(pa.float64()), pa.array(unique[place[rare]].view(np.int64)), pa.array(count[rare]),
                ], names)

    rated = stage(docs.select("doc_id", row_key().alias("key"), "text").mapInArrow(rate, schema), "lm-rated")
    rare = rated.where("hash IS NOT NULL").select("key", "hash", "times")
    joined = rare.join(counts.select("hash", "n").hint("merge"), "hash", "left")
    # rows that repeat id and text share a key: count its rows once
    parts = joined.groupBy("key").agg(
        F.sum(F.col("times") * F.round((F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5)) - F.lit(float(below))) * F.lit(1e12)).cast("decimal(38,0)")).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(F.lit(0))).alias("more_known"),
    )
    texts = rated.where("n_tokens IS NOT NULL")
    twins = texts.groupBy("key").agg(F.count(F.lit(1)).alias("twins"))
    parts = parts.join(twins, "key")
    return texts.join(parts, "key", "left").select(
        "doc_id", "n_tokens",
        (F.col("known") + F.coalesce(F.col("more_known") / F.col("twins"), F.lit(0)).cast("long")).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("more").cast("double") / F.col("twins") / F.lit(1e12), F.lit(0.0))).alias("base_score"),
        "score",
    )


def report(docs: DataFrame) -> DataFrame:
    held_out = fold("doc_id", 5) == 1
    scored = score_texts(docs, docs.where(~held_out))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
