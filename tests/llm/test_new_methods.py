"""Periodic runs, b-bit MinHash groups and token alignment, beside brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from carebasin.llm import bbit_minhash, common, lattice_lm, periodic_runs, token_alignment
from carebasin.llm.queries import QUERIES

CASED = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ["key", "id", "n", "row", "runs", "best", "pairs", "signature", "bucket", "family", "label", "kept", "groups", "text_"]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd-new")
    rows = brute.odd_documents(12)
    rows += [
        (200, "a a a a a a a", "en", "s", 13), (201, "a b " * 40 + "c", "en", "s", 0), (202, "x " + "a b c " * 5 + "y", "en", "s", 0),
        (203, "A a A a a A", "en", "s", 0), (None, "p q p q p q p q p q", "en", "s", 0), (204, "go go go go go stop", "en", "s", 0),
        (205, "▁ mark", "en", "s", 0), (206, "<|endoftext|> <s> </s> <0x41>", "en", "s", 0), (207, "\x00 nul 😀🇩🇪 漢字  ", "en", "s", 0),
        (208, "k" * 100_500, "en", "s", 0), (209, " ", "en", "s", 0),
    ]
    brute.write(folder / "documents.parquet", rows, **dict.fromkeys(CLASH, "x"))
    return str(folder), rows


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty-new")
    brute.write(folder / "documents.parquet", [])
    return str(folder)


def collected(spark, name, folder):
    return brute.in_order(tuple(r) for r in QUERIES[name](spark, folder).collect())


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_bbit_minhash", "op13_token_alignment"])
def test_empty_table(spark, empty, name):
    assert collected(spark, name, empty) == []


# -- periodic runs ------------------------------------------------------------------------


def runs_of(words, least=6, repeats=4):
    """(start, length, smallest period) of all maximal stretches, period by period."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def run_row(doc_id, text):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, words = h // 10, CASED.findall(text or "")
    n = len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = sorted(runs_of(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None,) * 4
    if runs:
        s, length, q = min(runs, key=lambda r: (-(r[1] / r[2]), r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, sha(text), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_equal_brute_force(spark, odd):
    folder, rows = odd
    expected = [run_row(r[0], r[1]) for r in rows]
    assert collected(spark, "op11_periodic_runs", folder) == brute.in_order(expected)
    assert sum(r[1] > 0 for r in expected) >= 8


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 4)):
            block = [rng.randrange(5) for _ in range(rng.randint(1, 7))]
            text = ((block * 20)[: rng.randint(0, 60)] if rng.random() < 0.6 else [rng.randrange(2) for _ in range(rng.randint(0, 60))])
            for _ in range(rng.randint(0, 3)):
                if text:
                    text[rng.randrange(len(text))] = rng.randrange(5)
            texts.append(text)
        first = np.cumsum([0, *map(len, texts)])
        least, repeats = rng.choice([(6, 4), (2, 2), (4, 2), (6, 3), (9, 5)])
        got = periodic_runs.find_runs(np.array([w + 1 for t in texts for w in t], np.uint64), first, least, repeats)
        expected = [(s + f, n, q) for t, f in zip(texts, first) for s, n, q in runs_of(t, least, repeats)]
        assert sorted(map(tuple, got.tolist())) == sorted(expected)


def test_long_periodic_text_takes_few_steps():
    words = np.array([1] * 60_000 + [2] + list(range(3, 40)) * 800, np.uint64)
    got = periodic_runs.find_runs(words, np.array([0, len(words)]))
    assert got.tolist() == [[0, 60_000, 1], [60_001, 29_600, 37]]


def test_operator_keeps_texts_and_runs(spark):
    rows = periodic_runs.periodic_runs(spark.createDataFrame([(1, "x a b a b a b y"), (2, None)], "doc_id long, text string"), 4, 2).collect()
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows] == [(1, 8, [(1, 6, 2)], "x a b y"), (2, 0, [], "")]


# -- b-bit MinHash ------------------------------------------------------------------------


def groups(rows, k=4):
    """(doc_id, shingles, smallest id of the group, kept) by comparing all sets."""
    sets = []
    for r in rows:
        w = brute.words(r[1])
        sets.append({tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        both = Counter()
        for g in s:
            both.update(lists[g])
            lists[g].append(i)
        for j, n in both.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    out = []
    for i, r in enumerate(rows):
        component = min(least[find(i)], default=None) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), component, r[0] == component))
    return out


def near_copies(seed, families, copies, edits):
    rng, out = random.Random(seed), []
    for f in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([9, 40, 150]))]
        for k in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // edits))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(3000)}"
            out.append((1000 * (f + 1) + k, " ".join(words), "en", "s", 0))
    return out


@pytest.mark.parametrize("block, rounds", [(1 << 20, 4), (1500, 1)])
def test_groups_equal_brute_force(spark, odd, tmp_path, monkeypatch, block, rounds):
    monkeypatch.setattr(bbit_minhash, "BLOCK", block)
    monkeypatch.setattr(bbit_minhash, "ROUNDS", rounds)
    rows = [r for r in odd[1] if r[0] != 94] + near_copies(4, 3, 60, 12)
    brute.write(tmp_path / "documents.parquet", rows, **dict.fromkeys(CLASH, "x"))
    expected = groups(rows)
    assert collected(spark, "op12_bbit_minhash", str(tmp_path)) == brute.in_order(expected)
    assert sum(not r[3] for r in expected) > 100


def test_estimates_are_corrected_for_collisions():
    rng = np.random.default_rng(3)
    for similarity in (0.0, 0.3, 0.5, 0.8, 1.0):
        pool = rng.integers(1, 1 << 63, 40_000, np.uint64)
        size = 2000
        shared = round(2 * size * similarity / (1 + similarity))
        found = []
        for k in range(8):
            part = pool[k * 5000: (k + 1) * 5000]
            a, b = part[:size], np.concatenate([part[:shared], part[size: 2 * size - shared]])
            least = bbit_minhash.minima(np.concatenate([a, b]), np.array([0, size, 2 * size]))
            words = bbit_minhash.packed(least)
            assert words.shape == (2, bbit_minhash.BITS * bbit_minhash.LANES)
            found.append(bbit_minhash.estimates(words[0], words[1:])[0])
        assert abs(np.mean(found) - similarity) < 4 * bbit_minhash.spread(similarity) / 8**0.5 + 1e-9


def test_estimate_is_the_same_in_sql(spark):
    rng = np.random.default_rng(4)
    words = rng.integers(0, 1 << 63, (30, bbit_minhash.BITS * bbit_minhash.LANES), np.uint64)
    words[1::2] = words[::2] & ~(np.uint64(1) << np.uint64(5))
    pairs = [(words[i].view(np.int64).tolist(), words[i + 1].view(np.int64).tolist()) for i in range(29)]
    got = spark.createDataFrame(pairs, "a array<long>, b array<long>").select(bbit_minhash.estimate("a", "b")).collect()
    expected = [bbit_minhash.estimates(words[i], words[i + 1: i + 2])[0] for i in range(29)]
    assert [r[0] for r in got] == pytest.approx(expected)


# -- token alignment ------------------------------------------------------------------------


def aligned(rows):
    """The report by walking over both token lists."""
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = token_alignment._byte_letters()
    spelled_a = {k: bytes(letters[c] for c in v) for v, k in a_model.get_vocab().items() if k != 50256}

    def spelled_b(k):
        piece = b_model.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(k) else piece.replace("▁", " ").encode()

    def with_ends(ids, spelled):
        end, out = 0, []
        for k in ids:
            end += len(spelled(k))
            out.append((end, k))
        return out

    found, held = [], Counter()
    for r in rows:
        text, whole = r[1] or "", (" " + (r[1] or "")).encode()
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        ok = text and b"".join(map(spelled_a.get, a)) == whole and b"".join(map(spelled_b, b)) == whole
        groups = []
        if ok:
            a_ends, b_ends, start = with_ends(a, spelled_a.get), with_ends(b, spelled_b), 0
            for end in sorted({e for e, _ in a_ends} & {e for e, _ in b_ends}):
                groups.append(tuple([k for e, k in side if start < e <= end] if len(whole) < 4000 else None for side in (a_ends, b_ends)))
                start = end
            if len(whole) >= 4000:  # the same in one pass
                cuts = sorted({e for e, _ in a_ends} & {e for e, _ in b_ends})
                sides = []
                for side in (a_ends, b_ends):
                    parts, at = [], 0
                    for cut in cuts:
                        part = []
                        while at < len(side) and side[at][0] <= cut:
                            part.append(side[at][1])
                            at += 1
                        parts.append(part)
                    sides.append(parts)
                groups = list(zip(*sides))
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        held.update(links.keys())
        found.append((r[0], len(a) if ok else 0, len(b) if ok else 0, groups, links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, n_a, n_b, len(groups), sum(links.values()), sum(n for k, n in links.items() if held[k] == top[k[0]]),
            sum(n * held[k] for k, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if n_a else "",
        ))
    return out


@pytest.mark.parametrize("limit", [token_alignment.HOT, 300, 0])
def test_alignment_equals_brute_force(spark, odd, limit):
    folder, rows = odd
    got = token_alignment.report(spark.read.parquet(f"{folder}/documents.parquet"), limit=limit).collect()
    assert brute.in_order(map(tuple, got)) == brute.in_order(aligned(rows))


def test_products_in_blocks_equal_dense_ones(monkeypatch):
    rng = np.random.default_rng(2)
    for terms in (1, 7, 1 << 20):
        monkeypatch.setattr(token_alignment, "TERMS", terms)
        a, b = rng.integers(0, 4, (13, 9)) * (rng.random((13, 9)) < 0.4), rng.integers(0, 4, (9, 11)) * (rng.random((9, 11)) < 0.4)
        a[3] = 0
        left, right = (token_alignment.Rows.of(*np.nonzero(m), m[np.nonzero(m)], *m.shape) for m in (a, b))
        got = token_alignment.product(left, right)
        dense = np.zeros((13, 11), np.int64)
        dense[got.row_of_entry(), got.columns] = got.values
        assert (dense == a @ b).all() and (np.diff(right.transposed().starts) == (b > 0).sum(axis=0)).all()


def test_overlaps_count_shared_bytes():
    lengths = np.array([2, 3, 1]), np.array([1, 3, 2])
    ids = np.array([4, 5, 6]), np.array([7, 8, 9])
    first = np.array([0, 3])
    got = token_alignment.Alignment(*ids, *lengths, first, first, (10, 10))
    links = list(zip(got.overlaps.row_of_entry().tolist(), got.overlaps.columns.tolist(), got.overlaps.values.tolist()))
    assert links == [(0, 0, 1), (0, 1, 1), (1, 1, 2), (1, 2, 1), (2, 2, 1)]
    assert got.n_groups == 1 and got.links.sum() == 9


def test_most_frequent_rows_by_bins_of_counts(spark):
    rows = [(k, n) for k, n in enumerate([1] * 50 + [2] * 9 + [3, 3, 900, 1000, 10**12])]
    counted = spark.createDataFrame(rows, "hash long, n long")
    got = lambda limit: sorted(r.n for r in common.most_frequent(counted, limit).collect())
    assert got(100) == sorted(n for _, n in rows)
    assert got(63) == sorted(n for _, n in rows if n > 1)  # the bin of ones does not fit
    assert got(4) == [900, 1000, 10**12]
    assert got(1) == [10**12] and got(0) == []
    assert common.most_frequent(counted.limit(0), 5).count() == 0


@pytest.mark.parametrize("top", [0, 7, 1 << 17])
def test_scores_do_not_depend_on_the_words_told_to_tasks(spark, monkeypatch, top):
    texts = ["the cat sat on the mat", "the dog", "", None, "a Cat and a dog and the end", "unseen words here"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(lattice_lm, "TOP", top)
    got = {r.doc_id: r for r in lattice_lm.score_texts(docs, docs.where("doc_id <> 5")).collect()}
    counts = Counter(w for t in texts[:5] for w in (t or "").lower().split())
    n_all = sum(counts.values()) + 5
    below = math.log10(n_all + 0.5 * (len(counts) + 2))
    for k, text in enumerate(texts):
        words_ = (text or "").lower().split()
        base = sum(math.log10(counts[w] + 0.5) - below for w in words_) + math.log10(5.5) - below
        assert abs(got[k].base_score - base) < 1e-9
        assert got[k].n_known == sum(counts[w] > 0 for w in words_) + 1 and got[k].train_tokens == n_all
