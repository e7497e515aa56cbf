"""Language identification by multilingual mixture inference.

Learning counts hashed byte trigrams per language over all training documents.
A document is a mixture: each of its trigrams comes from one language, with the
document's proportions. Expectation-maximisation estimates the proportions;
nested sets of languages (best single language first, then by proportion) are
refitted, and the set with the best penalised likelihood is kept. The largest
proportion in it names the language and is the score.

The model has languages x ``BUCKETS`` counts, whatever the corpus size; only it
goes through the driver and to the tasks. Languages are meant to be hundreds at
most.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
texts with a letter but no trigram take the most frequent training language with
score 1 / languages; without any training document all are ``und``. Rows are
predicted one by one, so repeated rows agree and null ids are kept. Extra
columns are carried through by ``predict``, unless they begin with ``lang_``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebasin.llm.common import Texts, chunks, fold, packed

#: Hashed trigram features.
BITS = 15
BUCKETS = 1 << BITS
#: Added to each count.
SMOOTHING = 0.5
#: Rounds of expectation-maximisation over all languages, and for each set.
ROUNDS, SET_ROUNDS = 12, 8
#: Overlapping trigrams count each letter three times.
OVERLAP = 3.0
#: Bytes whose trigrams are counted at once; longer texts are counted in pieces.
PIECE = 4 << 20
#: Share of the best language below which a document is rejected.
LEAST = 0.5

_FOLD = np.full(256, 0x20, np.uint32)
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def bag(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (row, bucket, count) of the trigrams of each text."""
    keys, counts = [], []
    data, offsets = texts.data, texts.offsets
    for begin in range(0, len(data), PIECE):
        stop = min(begin + PIECE, len(data))
        x = _FOLD[data[begin: stop + 2]]
        if len(x) < 3:
            continue
        code = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
        at = np.arange(begin, begin + len(code))
        row = np.searchsorted(offsets, at, "right") - 1
        fits = (at + 2 < offsets[row + 1]) & (code != 0x202020)
        bucket = (code[fits] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        unique, count = np.unique(row[fits] << BITS | bucket.astype(np.int64), return_counts=True)
        keys.append(unique)
        counts.append(count)
    if not keys:
        none = np.zeros(0, np.int64)
        return none, none, none
    if len(keys) > 1:
        unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        keys, counts = [unique], [np.bincount(inverse.ravel(), np.concatenate(counts)).astype(np.int64)]
    return keys[0] >> BITS, keys[0] & (BUCKETS - 1), counts[0]


class Model:
    """Languages, log probabilities of the buckets, and the default language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.log = np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32).copy()
        # only ratios matter; scaling by the best language avoids tiny numbers
        self.odds = np.exp(self.log - self.log.max(1, keepdims=True, initial=-1e9))
        self.default = languages[int(np.argmax(counts.sum(1)))] if languages else None


def train(docs: DataFrame) -> Model:
    """Count trigrams of all rows of ``docs`` that have text and ``lang``."""

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for texts in chunks(batches):
            langs = texts.batch.column("lang").to_pylist()
            names = sorted(set(langs))
            place = np.array([names.index(x) for x in langs])
            row, bucket, n = bag(texts)
            for k, name in enumerate(names):
                own = place[row] == k
                held = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                held += np.bincount(bucket[own], n[own], BUCKETS).astype(np.int64)
        for name, held in totals.items():
            full = np.flatnonzero(held)
            yield pa.record_batch(
                [pa.array([name] * len(full), pa.string()), pa.array(full), pa.array(held[full])], ["lang", "bucket", "n"]
            )

    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    counted = known.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow().combine_chunks()
    names = np.asarray(rows.column("lang").to_pylist(), object)
    languages = sorted(set(names))
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        place = {name: k for k, name in enumerate(languages)}
        at = np.array([place[x] for x in names])
        counts[at, np.asarray(rows.column("bucket"))] = np.asarray(rows.column("n"))
    return Model(languages, counts)


def infer(model: Model, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its proportion and the size of its set for each text; -1
    where there is no trigram."""
    rows, k = len(texts), len(model.languages)
    best, share, chosen = np.full(rows, -1), np.zeros(rows), np.zeros(rows, np.int64)
    row, bucket, n = bag(texts)
    if not len(row) or not k:
        return best, share, chosen
    present, first = np.unique(row, return_index=True)
    owner = np.repeat(np.arange(len(present)), np.diff(np.append(first, len(row))))
    odds, n = model.odds[bucket], n.astype(np.float64)
    total = np.add.reduceat(n, first)

    def fit(odds, n, first, owner, total, pi, rounds):
        for _ in range(rounds):
            q = pi[owner] * odds
            pi = np.add.reduceat(q * (n / q.sum(1))[:, None], first) / total[:, None]
        return pi, np.add.reduceat(n * np.log((pi[owner] * odds).sum(1)), first)

    pi, _ = fit(odds, n, first, owner, total, np.full((len(present), k), 1.0 / k), ROUNDS)
    single = np.add.reduceat(n[:, None] * np.log(odds), first)
    top = single.argmax(1)
    each = np.arange(len(present))
    found, proportion, size = top.copy(), np.ones(len(present)), np.ones(len(present), np.int64)
    value = single[each, top] / OVERLAP
    rank = np.argsort(-np.where(each[:, None] == -1, 0, pi) - 2.0 * (np.arange(k) == top[:, None]), axis=1, kind="stable")
    going = each
    for s in range(2, k + 1):
        if not len(going):
            break
        # only the documents whose last set was an improvement try a larger one
        use = np.isin(owner, going)
        sub_first = np.searchsorted(owner[use], going)
        sub_owner = np.searchsorted(going, owner[use])
        start = np.zeros((len(going), k))
        np.put_along_axis(start, rank[going, :s], 1.0 / s, 1)
        got, ll = fit(odds[use], n[use], sub_first, sub_owner, total[going], start, SET_ROUNDS)
        now = ll / OVERLAP - 0.5 * (s - 1) * np.log(total[going])
        better = now > value[going]
        won = going[better]
        value[won], found[won], proportion[won], size[won] = now[better], got[better].argmax(1), got[better].max(1), s
        going = won
    best[present], share[present], chosen[present] = found, np.minimum(proportion, 1.0), size
    return best, share, chosen


def has_letter(texts: Texts) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    ascii_letters = np.concatenate([[0], np.cumsum((_FOLD[texts.data] != 0x20) & (texts.data < 128))])
    letter = ascii_letters[texts.offsets[1:]] > ascii_letters[texts.offsets[:-1]]
    for row in np.flatnonzero(~letter & (np.diff(texts.offsets) > 0)):
        text = texts.data[texts.offsets[row]: texts.offsets[row + 1]].tobytes().decode("utf-8", "replace")
        letter[row] = any(c.isalpha() for c in text)
    return letter


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_set`` (languages in the set)."""
    docs = docs.drop(*[c for c in docs.columns if c.startswith("lang_")])
    columns = docs.columns

    def label(batches):
        for texts in chunks(batches):
            best, share, chosen = infer(model, texts)
            letter = has_letter(texts)
            names = [
                "und" if not seen or not model.languages else model.languages[b] if b >= 0 else model.default
                for b, seen in zip(best, letter)
            ]
            score = np.where(letter, np.where(best >= 0, share, 1.0 / max(1, len(model.languages))), 0.0)
            score = score if model.languages else score * 0
            yield pa.RecordBatch.from_arrays(
                [texts.batch.column(c) for c in columns]
                + [pa.array(names, pa.string()), pa.array(score), pa.array(np.where(letter, chosen, 0))],
                [*columns, "lang_pred", "lang_score", "lang_set"],
            )

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType()), T.StructField("lang_set", T.LongType())])
    return docs.mapInArrow(label, schema)


def accepted(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` with a language that holds at least ``least`` of the
    text. A model that has learned nothing rejects nothing."""
    if not model.languages:
        return docs
    labelled = predict(packed(docs, "text"), model)
    return labelled.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= least)).select("row.*")


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold("doc_id", 5) != 0)


def report(docs: DataFrame) -> DataFrame:
    model = train(training_rows(docs))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_set").alias("n_languages"),
    )
