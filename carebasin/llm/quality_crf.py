"""Document quality from a linear-chain conditional random field over lines.

Each line has features of its own and of its neighbours; the field labels every
line good or bad. It learns by maximum likelihood, with every line of a training
document carrying the document's label. A document's raw quality is the mean of
its lines' forward-backward marginals of "good", weighted by line length; a
logistic curve fitted on the same sample turns it into a probability.

Learning uses whole texts of at most ``SAMPLE`` labelled documents, those with the
smallest hash of their id: as many of them, in that order, as have ``SAMPLE_LINES``
lines together. These two parameters bound the sample on the driver, whatever the
texts' lengths; a text that is longer than the whole bound is passed over. Only line
counts are looked at to choose them. All documents are scored over their whole text.

Defined cases: null and empty texts are one empty line and get a score; several
labels of one document count as the lowest; of the rows that share a sampled id, the one
with the smallest hash of its text teaches; rows without label, or labels
without document, teach nothing; without labels of both kinds the score is the
share of good labels, or 1/2 without any. Repeated rows agree. Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carebasin.llm.common import SPACE, Texts, chunks, fold, powers, mix, BYTE_CODE

SAMPLE = 3000
SAMPLE_LINES = 60_000
#: Lines of a training chain: a text is learned as runs of this length that cover it.
RUN = 32
STEPS = 250
RATE = 0.08
DECAY = 1e-3
#: Score from which a document is predicted good.
GOOD = 0.7

_KIND = np.full(256, 6)                    # other
_KIND[list(b"#*$%&|<>{}[]@^~_=+\\/")] = 5  # symbols
_KIND[list(b".,;:!?'\"()-")] = 4           # punctuation
_KIND[SPACE] = 3
_KIND[48:58] = 2
_KIND[65:91] = 1
_KIND[97:123] = 0
_KIND[128:] = 7
_END = np.zeros(256, bool)
_END[list(b".!?:;\"")] = True
OWN = 17
#: Own features, those of the line before and after, and whether these exist.
FEATURES = 3 * OWN + 3


def line_features(texts: Texts):
    """Features of all lines, line lengths in bytes, and the first line of each text."""
    data, offsets = texts.data, texts.offsets
    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    # a break at the end of a text opens a last, empty line that starts where the next text does
    end = np.sort(np.concatenate([offsets[1:], breaks]))
    first = np.arange(len(texts) + 1) + np.searchsorted(breaks, offsets)
    size = (end - begin).astype(np.float64)

    def sums(values):
        run = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
        return run[end] - run[begin]

    kinds = [sums(_KIND[data] == k) for k in range(8)]
    word = ~SPACE[data]
    opening = word.copy()
    opening[1:] &= ~word[:-1]
    closing = word.copy()
    closing[:-1] &= ~word[1:]
    n_words = sums(opening)
    letters_end = sums(closing & (_KIND[data] < 3) | closing & (data >= 128))
    shouted = sums(data == 33)
    piped = sums(data == 124)
    same = np.zeros(len(data), bool)
    same[1:] = data[1:] == data[:-1]
    # equal to an earlier line of the text
    place = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
    coded = BYTE_CODE[data] * powers(int(size.max()) + 2)[place]
    code = np.concatenate([np.zeros(1, np.uint64), np.cumsum(coded, dtype=np.uint64)])
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    hashed = mix((code[end] - code[begin]) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, earliest = np.unique(hashed, return_index=True)
    repeated = np.ones(len(begin))
    repeated[earliest] = 0
    repeated *= size > 0

    per = np.maximum(size, 1)
    last = np.where(size > 0, data[np.maximum(end - 1, 0)] if len(data) else 0, 0).astype(int)
    head = np.where(size > 0, data[np.minimum(begin, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(int)
    own = np.stack([
        np.log1p(size) / 5, *[k / per for k in kinds], np.log1p(n_words) / 3, size / np.maximum(n_words, 1) / 10,
        letters_end / np.maximum(n_words, 1), shouted / np.maximum(n_words, 1), piped / np.maximum(n_words, 1),
        sums(same) / per, repeated, (_END[last] & (size > 0)).astype(float) - (_KIND[head] == 1),
    ], 1)
    out = np.zeros((len(begin), FEATURES))
    out[:, :OWN] = own
    out[1:, OWN: 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN: 3 * OWN] = own[1:]
    starts, stops = first[:-1], first[1:] - 1
    out[starts, OWN: 2 * OWN] = 0
    out[stops, 2 * OWN: 3 * OWN] = 0
    out[:, -3], out[starts, -2], out[stops, -1] = 1, 1, 1
    return out, size, first


def marginals(emission: np.ndarray, lengths: np.ndarray, first: np.ndarray, chain: np.ndarray):
    """Log likelihood parts of chains laid one after another: P(good) of each
    line, expected neighbours (2 x 2) and the log normaliser of each chain.
    ``emission`` is the log odds of good; ``chain`` the transition scores."""
    order = np.argsort(-lengths, kind="stable")
    sizes, begins = lengths[order], first[order]
    longest = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right")
    score = np.zeros((len(emission), 2))
    score[:, 1] = emission
    weight = np.exp(chain)
    forward, backward = np.zeros((len(emission), 2)), np.ones((len(emission), 2))
    likely = np.exp(score - score.max(1, keepdims=True))
    norm = score.max(1).copy()
    state = None
    for t in range(longest):
        at = begins[: active[t]] + t
        state = likely[at] if t == 0 else (state[: active[t]] @ weight) * likely[at]
        scale = state.sum(1, keepdims=True)
        state = state / scale
        forward[at] = state
        norm[at] += np.log(scale[:, 0])
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = begins[: active[t + 1]] + t
        following = likely[at + 1] * backward[at + 1]
        joint = forward[at][:, :, None] * weight * following[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        back = following @ weight.T
        backward[at] = back / back.sum(1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(1), pairs, np.add.reduceat(norm, first)


class Field:
    def __init__(self):
        self.mean, self.spread = np.zeros(FEATURES), np.ones(FEATURES)
        self.weights, self.chain = np.zeros(FEATURES), np.zeros((2, 2))
        self.slope, self.level = 0.0, 0.0

    def lines(self, features, lengths, first):
        return marginals(((features - self.mean) / self.spread) @ self.weights, lengths, first, self.chain)

    def raw(self, features, size, first):
        """Length-weighted mean of the marginals of each text."""
        lengths = np.diff(first)
        good, _, _ = self.lines(features, lengths, first[:-1])
        weight = size + 1.0
        return np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])

    def score(self, raw):
        return 1.0 / (1.0 + np.exp(-(self.slope * raw + self.level)))


def fit(features, size, lengths, first, labels, documents) -> Field:
    """Train on chains (their lines one after another) with a label each.
    ``documents`` tells which chains belong together for the final curve."""
    field = Field()
    good = float(np.mean(labels)) if len(labels) else 0.5
    if len(labels) == 0 or good in (0.0, 1.0):
        field.level = np.log((good + 1e-3) / (1 - good + 1e-3))
        return field
    field.mean, field.spread = features.mean(0), features.std(0) + 1e-2
    field.mean[-3], field.spread[-3] = 0, 1
    x = (features - field.mean) / field.spread
    per_line = np.repeat(labels, lengths).astype(float)
    steps = lengths - 1
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = steps[labels == 0].sum(), steps[labels == 1].sum()
    n = len(x)
    theta = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):  # Adam on the mean negative log likelihood
        p, pairs, _ = marginals(x @ theta[:FEATURES], lengths, first, theta[FEATURES:].reshape(2, 2))
        gradient = np.append(x.T @ (p - per_line), (pairs - seen).ravel()) / n + DECAY * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    field.weights, field.chain = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
    p, _, _ = marginals(x @ field.weights, lengths, first, field.chain)
    owner = np.repeat(documents, lengths)
    names, owner = np.unique(owner, return_inverse=True)
    raw = np.bincount(owner, p * (size + 1)) / np.bincount(owner, size + 1)
    label = np.bincount(np.searchsorted(names, documents), labels) > 0
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic curve with a small ridge
        q = 1 / (1 + np.exp(-(a * raw + b)))
        w = q * (1 - q) + 1e-9
        g = np.array([((q - label) * raw).sum() + 1e-2 * a, (q - label).sum()])
        h = np.array([[(w * raw * raw).sum() + 1e-2, (w * raw).sum()], [(w * raw).sum(), w.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    field.slope, field.level = float(a), float(b)
    return field


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines_in_all: int = SAMPLE_LINES) -> Field:
    """Fit on a bounded sample of the labelled rows whose id's fold is not held out."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold("doc_id", 4) != 2)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("labelled"), "quality")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # one row an id, chosen by hashes alone: a repeated id does not enlarge the sample
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    rows = texts.select("labelled", F.xxhash64(text).alias("text_hash"), lines.cast("long").alias("lines"))
    rows = rows.groupBy("labelled").agg(F.min(F.struct("text_hash", "lines")).alias("row"))
    rows = rows.where(F.col("row.lines") <= lines_in_all)
    so_far = F.sum("row.lines").over(Window.orderBy(F.xxhash64("labelled"), "labelled").rowsBetween(Window.unboundedPreceding, 0))
    kept = rows.withColumn("so_far", so_far).where(F.col("so_far") <= lines_in_all)  # at most `sample` rows
    kept = kept.select(F.col("labelled").alias("id"), F.col("row.text_hash").alias("text_hash"))
    texts = texts.join(F.broadcast(kept), (F.col("id") == F.col("labelled")) & (F.col("text_hash") == F.xxhash64(text)))
    texts = texts.select(F.xxhash64("doc_id").alias("document"), "text", F.col("quality").cast("int").alias("label"))

    def whole(batches):
        held = set()  # a repeated row of a sampled text leaves a task once
        for piece in chunks(batches):
            features, size, first = line_features(piece)
            document, label = (piece.batch.column(c).to_pylist() for c in ("document", "label"))
            rows = []
            for k in range(len(piece)):
                if document[k] in held:
                    continue
                held.add(document[k])
                for b in range(first[k], first[k + 1], RUN):
                    e = min(b + RUN, first[k + 1])
                    rows.append((document[k], int(b - first[k]), label[k], int(e - b), features[b:e].astype(np.float32).tobytes(), size[b:e].astype(np.float32).tobytes()))
            if rows:
                yield pa.record_batch([pa.array(x) for x in zip(*rows)], ["document", "line", "label", "n", "features", "size"])

    found = texts.mapInArrow(whole, "document long, line long, label long, n long, features binary, size binary")
    # equal rows of one document in several tasks are one again before they reach the driver
    found = found.groupBy("document", "line").agg(F.min(F.struct("label", "n", "features", "size")).alias("r"))
    found = found.select("document", "line", "r.*").toArrow()
    found = found.sort_by([("document", "ascending"), ("line", "ascending")])
    lengths, labels_, document = (np.asarray(found.column(c).combine_chunks(), np.int64) for c in ("n", "label", "document"))
    features = np.frombuffer(b"".join(found.column("features").to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)
    size = np.frombuffer(b"".join(found.column("size").to_pylist()), np.float32).astype(float)
    return fit(features, size, lengths, np.cumsum(lengths) - lengths, (labels_ > 0).astype(int), document)


def score(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, score, n_lines, n_good`` (lines labelled good) of every row."""

    def rate(batches):
        for texts in chunks(batches):
            features, size, first = line_features(texts)
            good, _, _ = field.lines(features, np.diff(first), first[:-1])
            weight = size + 1.0
            raw = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
            n_good = np.add.reduceat((good >= 0.5).astype(np.int64), first[:-1])
            yield pa.record_batch(
                [texts.batch.column("doc_id"), pa.array(field.score(raw)), pa.array(np.diff(first)), pa.array(n_good)],
                ["doc_id", "score", "n_lines", "n_good"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(rate, f"doc_id {kind}, score double, n_lines long, n_good long")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    field = train(docs, labels)
    return score(docs, field).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"), "n_lines", "n_good",
    )
