"""Parts of the corpus operators on their own."""

import itertools
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carebasin.llm import components, decontaminate, language, lattice_lm, line_dedup, mixing, ngram_join, quality_crf, quality_rules, suffix_dedup, warc
from carebasin.llm.common import Texts, chunks, words
from carebasin.llm.components import connected


def batch(texts):
    return pa.record_batch([pa.array(texts, pa.string())], ["text"])


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_words_of_bytes_equal_the_pattern():
    texts = ["a b", None, "", " A\tb\x0bc ", "é ü", "x" * 1000 + " y", "\n"]
    for size in (1, 5, 10_000):
        got = []
        for piece in chunks([batch(texts)], limit=size):
            starts, ends, hashes, first = words(piece)
            raw = piece.data.tobytes()
            cut = [raw[s:e].decode().translate(brute.LOWER) for s, e in zip(starts, ends)]
            got += [cut[a:b] for a, b in zip(first, first[1:])]
            assert len(set(hashes.tolist())) == len(set(cut))
        assert got == [brute.words(t) for t in texts]


@pytest.mark.parametrize("short, block", [(1, 1 << 20), (2, 60)])
def test_join_through_pivots_and_blocks(spark, monkeypatch, short, block):
    monkeypatch.setattr(ngram_join, "SHORT", short)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "REPEATED", 2)
    rows = [r for r in brute.odd_documents(9) if r[0] is None or r[0] < 90]
    got = [tuple(r) for r in ngram_join.join_documents(frame(spark, rows)).collect()]
    assert brute.in_order(got) == brute.in_order(brute.join(rows))


def test_join_stops_after_its_rounds(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "SHORT", 1)
    rows = [r for r in brute.odd_documents(3) if r[0] is None or r[0] < 90]
    got = [tuple(r) for r in ngram_join.join_documents(frame(spark, rows)).collect()]
    assert brute.in_order(got) == brute.in_order(brute.join(rows))


def test_rest_of_long_lists_is_not_paired(spark, monkeypatch):
    # all documents are made of frequent passages and pairwise far apart, but for a few
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "SHORT", 2)
    monkeypatch.setattr(ngram_join, "BLOCK", 3000)
    rng = random.Random(8)
    passages = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(60)) for _ in range(12)]
    texts = [" ".join(rng.sample(passages, 4)) for _ in range(90)]
    texts += [t + f" tail {k}" for k, t in enumerate(texts[::9])]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    paired, inner = [], ngram_join.pivot_rounds

    def pivot_rounds(lists, every):
        cells, pairs = inner(lists, every)
        paired.append(sum(p.distinct().count() for p in pairs))
        return cells, pairs

    monkeypatch.setattr(ngram_join, "pivot_rounds", pivot_rounds)
    got = [tuple(r) for r in ngram_join.join_documents(frame(spark, rows)).collect()]
    assert brute.in_order(got) == brute.in_order(brute.join(rows))
    assert paired and paired[0] < 2 * len(rows)


def test_pairs_of_a_list_are_given_in_pieces(monkeypatch):
    monkeypatch.setattr(ngram_join, "GIVEN", 1000)
    n = 300
    index = pa.record_batch([
        pa.array([5] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([40] * n, pa.int32()), pa.array([0] * n, pa.int32()),
    ], ["key", "id", "n", "at"])
    found = list(ngram_join.walked([index], n))
    assert max(b.num_rows for b in found) <= 1000 + n
    assert {(a, b) for x in found for a, b in zip(x.column("a").to_pylist(), x.column("b").to_pylist())} == set(itertools.combinations(range(n), 2))


def test_sets_and_lists_are_shuffled_in_short_forms(spark, monkeypatch):
    rng = np.random.default_rng(5)
    plain = np.unique(rng.integers(0, 1 << 63, 900, np.uint64))
    heavy = np.unique(rng.integers(0, 1 << 20, 900).astype(np.uint64)) + np.uint64(1 << 63)
    for keys in (plain, heavy, np.concatenate([plain, heavy]), plain[:1], plain[:0]):
        assert (ngram_join.decoded(ngram_join.coded(keys)) == keys).all()
    size = lambda blob: len(pa.compress(blob, codec="lz4_raw", asbytes=True))  # the codec of shuffles
    assert size(ngram_join.coded(heavy)) < size(heavy.tobytes()) / 2 and size(ngram_join.coded(plain)) < 0.9 * size(plain.tobytes())
    # a frequent gram has a list of its own, and no name is longer than 48 bits
    assert len(np.unique(ngram_join.names(heavy))) == len(heavy)
    assert int(ngram_join.names(np.concatenate([plain, heavy])).max()) < 1 << 48
    # lists of one name are one list, and places end: links stay the same
    monkeypatch.setattr(ngram_join, "names", lambda keys: np.where(keys >= ngram_join._TOP, np.uint64(1 << 47), keys % np.uint64(50)))
    monkeypatch.setattr(ngram_join, "AT_BITS", 2)
    rows = [r for r in brute.odd_documents(9) if r[0] is None or r[0] < 90]
    got = [tuple(r) for r in ngram_join.join_documents(frame(spark, rows)).collect()]
    assert brute.in_order(got) == brute.in_order(brute.join(rows))


def test_one_of_each_group_stays(spark):
    rows = brute.odd_documents()
    kept = [tuple(r) for r in ngram_join.one_per_group(frame(spark, rows)).collect()]
    assert brute.in_order(kept) == brute.in_order(brute.kept_of_groups(rows))


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.label for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}


@pytest.mark.parametrize("held, most", [(1 << 18, 2), (0, 100)])
def test_few_edges_end_without_rounds(spark, monkeypatch, held, most):
    rng, staged, inner = random.Random(6), [], components.stage
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(300)] + [(k + 1, k) for k in range(900, 980)]
    label = {node: node for edge in edges for node in edge if edge[0] != edge[1]}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    monkeypatch.setattr(components, "HELD", held)
    monkeypatch.setattr(components, "stage", lambda *a: staged.append(a[1]) or inner(*a))
    frame_ = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert sorted((r.node, r.label) for r in connected(frame_).collect()) == sorted(label.items())
    assert (len(staged) <= most) and (held or len(staged) > 3)


def test_tasks_give_stars_of_bounded_graphs(monkeypatch):
    monkeypatch.setattr(components, "HELD", 10)
    edges = pa.record_batch([pa.array(range(1, 101), pa.int64()), pa.array(range(100), pa.int64())], ["a", "b"])
    found = list(components.spanned([edges]))
    assert len(found) > 1 and max(b.num_rows for b in found) <= 15
    a, b = (np.concatenate([np.asarray(x.column(c)) for x in found]) for c in ("a", "b"))
    assert (a > b).all() and set(components.rooted(a, b)[1]) == {0}


def test_only_texts_of_wanted_sets_are_cut_into_words(spark):
    docs = frame(spark, [(k, f"one two three four five {k}", "en", "s", 0) for k in range(40)])
    rows = {r.doc_id: r for r in ngram_join.labelled(docs)[0].collect()}
    sources = spark.createDataFrame([(rows[k].id, rows[k].key) for k in range(0, 40, 2)], "id long, key long")
    ids = spark.createDataFrame([(rows[k].id,) for k in range(0, 20)], "id long")
    order = ngram_join.Order(ngram_join.heavy_grams(docs, ngram_join.WORDS))
    # a wanted set that no source names is not looked for in the texts
    got = ngram_join.whole_sets(docs, order, ngram_join.WORDS, ids, sources).collect()
    assert {r.id for r in got} == {rows[k].id for k in range(0, 20, 2)} and all(r.n == 2 and len(r.grams) == 16 for r in got)


def test_suffix_dedup_in_small_pieces(spark, monkeypatch):
    for name, value in (("SORTED", 40), ("BUCKET", 50), ("COMBINED", 25), ("PIECE", 900)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = brute.odd_documents(11)
    got = [tuple(r) for r in suffix_dedup.report(frame(spark, rows)).collect()]
    assert brute.in_order(got) == brute.in_order(brute.suffix(rows))


@pytest.mark.parametrize("hashed", [7, 5_000])
def test_suffixes_of_a_common_phrase_never_meet_in_one_task(spark, monkeypatch, hashed):
    # the phrase is shorter than a string: its contexts all differ
    for name, value in (("SORTED", 40), ("BUCKET", 50), ("HOT", 30), ("HASHED", hashed)):
        monkeypatch.setattr(suffix_dedup, name, value, raising=False)
    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    phrase, tails = prose(90), [prose(60) for _ in range(12)]
    texts = [prose(rng.randint(0, 200)) + phrase + (tails[k % 12] if k % 3 else prose(90)) for k in range(240)]
    texts += [(phrase + prose(8)) * 60, "ab" * 4000, prose(150) + "ab" * 300]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)] + [(None, texts[1] + "x", "en", "s", 1)]
    rng.shuffle(rows)
    meets = []
    inner = suffix_dedup.covered

    def covered(cuts):
        cuts = cuts.persist()
        meets.extend(cuts.where("context IS NOT NULL").groupBy("gram").count().collect())
        return inner(cuts)

    monkeypatch.setattr(suffix_dedup, "covered", covered)
    got = [tuple(r) for r in suffix_dedup.report(frame(spark, rows)).collect()]
    assert brute.in_order(got) == brute.in_order(brute.suffix(rows))
    assert meets and max(r["count"] for r in meets) <= 30


def test_every_string_holds_a_token_at_a_fixed_place():
    rng = np.random.default_rng(1)
    string = rng.integers(97, 100, 100).astype(np.uint8)
    places = set()
    for _ in range(20):
        data = np.concatenate([rng.integers(97, 100, 130).astype(np.uint8), string, rng.integers(97, 100, 150).astype(np.uint8)])
        at, _ = suffix_dedup.tokens(data, np.array([0, len(data)]))
        inside = at[(at >= 130) & (at <= 130 + suffix_dedup.BEFORE)] - 130
        assert len(inside)
        places.update(inside.tolist()) if not places else places.intersection_update(inside.tolist())
    assert places


def test_multikey_order_sorts_bytes():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (500, 20)).astype(np.uint8)
    rows[::3] = rows[0]
    got = [rows[k].tobytes() for k in suffix_dedup.multikey_order(rows)]
    assert got == sorted(r.tobytes() for r in rows)


def test_mixture_of_two_languages():
    a, b = "the ring of that sing", "über schön grün für"
    counts = np.zeros((2, language.BUCKETS))
    for k, text in enumerate((a, b)):
        _, bucket, n = language.bag(Texts(batch([text * 20]), "text"))
        counts[k, bucket] += n
    model = language.Model(["a", "b"], counts)
    texts = [a * 30, b * 30, (a + " " + b) * 30, "xyz", "12", None]
    best, share, size = language.infer(model, Texts(batch(texts), "text"))
    assert best[:2].tolist() == [0, 1] and share[0] == 1 and size[:3].tolist() == [1, 1, 2]
    assert 0.3 < share[2] < 0.7 and best[5] == -1


def test_long_texts_are_counted_in_pieces(monkeypatch):
    texts = Texts(batch(["abc def ghi" * 50, "xyz", None, "q" * 99]), "text")
    whole = language.bag(texts)
    monkeypatch.setattr(language, "PIECE", 13)
    assert all((x == y).all() for x, y in zip(whole, language.bag(texts)))


def test_archive_is_read_back_and_faults_are_found():
    payloads = [f"<html>{'common words ' * 20}{k}</html>".encode() for k in range(60)]
    records = [warc.encode_record(k, "u", p, warc.digest(p), None) for k, p in enumerate(payloads)]
    trained = warc.dictionary(payloads)
    assert trained
    archive = warc.encode_archive(records, trained)
    rows = list(warc.decode_archive(archive))
    assert [r["payload"] for r in rows] == payloads and not any(r["error"] for r in rows)
    assert [r["error"] for r in warc.decode_archive(archive[:-3])][-1] == "frame is cut off"
    assert next(iter(warc.decode_archive(b"nothing")))["error"] == "no dictionary frame"
    broken = bytearray(archive)
    broken[len(archive) - 12] ^= 255
    assert [r["error"] for r in warc.decode_archive(bytes(broken))][-1]
    for change in ((b"WARC/1.1", b"WARC/9.9"), (b"sha1:", b"sha1:A"), (b"WARC-Date", b"WARC-Dato"), (b"</html>", b"</htm>")):
        bad = warc.encode_archive([records[0].replace(*change)], trained)
        assert next(iter(warc.decode_archive(bad)))["error"]


def test_lattice_sums_all_ways():
    pieces = tuple(bytes([k]) for k in range(256)) + (b"ab", b"ba", b"aba", warc.VERSION, lattice_lm.MARK + b"a")
    rng = np.random.default_rng(3)
    logs = np.log(rng.dirichlet(np.ones(len(pieces))))
    model = lattice_lm.Lattice(pieces, logs)
    place = {p: k for k, p in enumerate(pieces)}

    def ways(word):
        if not word:
            yield []
        for j in range(1, len(word) + 1):
            if word[:j] in place:
                for rest in ways(word[j:]):
                    yield [place[word[:j]], *rest]

    given = [b"ab", b"aba", b"c", b"abab", b"a" * 60]
    short = given[:4]
    total = [sum(np.exp(logs[w].sum()) for w in map(np.array, ways(lattice_lm.MARK + x))) for x in short]
    assert np.allclose(model.score(short), np.log(total))
    expected = np.zeros(len(pieces))
    for x, t, n in zip(short, total, (1, 2, 3, 4)):
        for w in ways(lattice_lm.MARK + x):
            for k in w:
                expected[k] += n * np.exp(logs[w].sum()) / t
    assert np.allclose(model.expected(short, np.array([1, 2, 3, 4])), expected)
    long_one, before = model.score(given)[-1], lattice_lm.LONG
    lattice_lm.LONG = 1000
    try:
        assert np.isclose(model.score(given)[-1], long_one)
        both = model.expected(given[-1:], np.array([2]))
    finally:
        lattice_lm.LONG = before
    assert np.allclose(model.expected(given[-1:], np.array([2])), both)


def test_scores_do_not_depend_on_the_travelling_words(spark, monkeypatch):
    docs = frame(spark, [r for r in brute.odd_documents() if r[0] is None or r[0] < 40])
    result = lambda: sorted((r.doc_id or -1, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in lattice_lm.report(docs).collect())
    want = result()
    monkeypatch.setattr(lattice_lm, "TOP", 3)
    assert result() == want


def test_marginals_equal_all_labellings():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 1, 4])
    first = np.array([0, 3, 4])
    emission, chain = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pairs, norm = quality_crf.marginals(emission, lengths, first, chain)
    want_pairs = np.zeros((2, 2))
    for k, (n, f) in enumerate(zip(lengths, first)):
        weights = {
            y: np.exp(sum(emission[f + t] * y[t] for t in range(n)) + sum(chain[y[t], y[t + 1]] for t in range(n - 1)))
            for y in itertools.product((0, 1), repeat=int(n))
        }
        z = sum(weights.values())
        assert np.isclose(norm[k], np.log(z))
        for t in range(n):
            assert np.isclose(good[f + t], sum(w for y, w in weights.items() if y[t]) / z)
            if t + 1 < n:
                for y, w in weights.items():
                    want_pairs[y[t], y[t + 1]] += w / z
    assert np.allclose(pairs, want_pairs)


def test_lines_of_texts():
    texts = ["a\nb\n\na", None, "", "\n", "x" * 50 + "\n" + "x" * 50, "é"]
    features, size, first = quality_crf.line_features(Texts(batch(texts), "text"))
    lines = [len(t.encode()) for x in texts for t in (x or "").split("\n")]
    assert size.tolist() == lines
    assert np.diff(first).tolist() == [len((x or "").split("\n")) for x in texts]
    repeated = features[:, 15]
    assert repeated[3] == 1 and repeated[0] == 0 and repeated[first[4] + 1] == 1 and repeated[first[5]] == 0
    assert np.isfinite(features).all()


def test_curve_without_both_labels():
    x, size, lengths, first = np.ones((2, quality_crf.FEATURES)), np.ones(2), np.array([1, 1]), np.array([0, 1])
    field = quality_crf.fit(x, size, lengths, first, np.array([1, 1]), np.array([0, 1]))
    assert 0.99 < field.score(np.array([0.3]))[0] <= 1
    none = np.zeros(0, int)
    assert quality_crf.fit(x[:0], size[:0], none, none, none, none).score(np.array([0.3]))[0] == 0.5


def test_mix_copies_follow_the_plan(spark):
    rows = brute.odd_documents()
    docs = frame(spark, rows).withColumn("mix_copy", F.lit(1))
    plan = mixing.plan(docs).groupBy("mix_row").agg(F.sum("copies").alias("n")).where("n > 0")
    out = mixing.mixed(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_copy"]
    assert out.count() == plan.agg(F.sum("n")).first()[0]
    assert out.where("mix_copy > 2").count() == 0


def test_taken_words_come_near_the_target(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(["w"] * rng.randint(0, 60)), "en", rng.choice("aabcd"), 0) for k in range(2000)]
    taken = mixing.report(frame(spark, rows)).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most"))
    for r in taken.collect():
        assert abs(r.taken - r.target) <= r.most


def test_targets_stop_and_are_shared_anew(spark):
    sizes = spark.createDataFrame([("0a", 100), ("0b", 1000), ("0c", 1000), ("1", 0)], "mix_source string, size long")
    got = {r.mix_source: r.target for r in mixing.source_targets(sizes).collect()}
    # shares of 3150 by 5, 2, 1, 5: the first stops at 200, the last at 0, then the second at 2000
    assert got == {"0a": 200.0, "0b": 1966.6666666666667, "0c": 983.3333333333334, "1": 0.0}


def test_near_phrases_are_told_from_exact_ones(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    near = item.replace("delta", "other")
    docs = spark.createDataFrame([(1, f"x {item} y"), (2, f"x {near} y"), (3, "delta delta")], "doc_id long, text string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    found = decontaminate.matches(docs, items).select("item", "start", "phrase").collect()
    assert sorted(map(tuple, found)) == [("5", 1, False), ("5", 1, True)]
    assert [r.doc_id for r in decontaminate.clean(docs, items).collect()] == [2, 3]


def test_near_phrases_without_their_rarest_terms(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    absent = item.replace("zeta", "nowhere")
    docs = spark.createDataFrame([(1, f"x {item} y"), (2, f"{item} {item}"), (3, "beta " * 3 + "kappa kappa")], "doc_id long, text string")
    # no text holds `nowhere`; `unseen` and `unread` are too many for a match of eight in ten
    items = spark.createDataFrame(
        [(5, absent), (6, absent.replace("beta", "unseen")), (7, absent.replace("beta", "unseen").replace("eta ", "unread "))],
        "item_id long, text string",
    )
    for bound in (decontaminate.BROADCAST, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(decontaminate, "BROADCAST", bound)
            found = decontaminate.matches(docs, items).select("key", "item", "phrase").distinct().collect()
        assert len(found) == 4 and {r.item for r in found} == {"5", "6"} and not any(r.phrase for r in found)


def test_long_text_beyond_the_bound_is_not_copied_by_word(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST", 0)
    words = [f"w{k % 997}" for k in range(60_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "w1 w2")], "doc_id long, text string")
    items = spark.createDataFrame([(5, " ".join(words[500:515])), (6, "w1 w2 w3 w4 w5 w6 w7 w8 w9 none")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.report(docs, items).collect()}
    assert got == {1: (60_000, 15 * 60, 1), 2: (2, 0, 0)}


def test_lines_of_a_long_text_are_touched_once(spark):
    import time

    passage = "\n".join(f"line {k} of many" for k in range(30_000))
    docs = spark.createDataFrame([(1, passage, "en", "s", 0), (2, "head\n" + passage + "\ntail", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    start = time.perf_counter()
    got = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.shortened(docs).collect()}
    assert got == {1: (passage, 0), 2: ("head\ntail", 9)} and time.perf_counter() - start < 30


def test_one_row_in_a_third_of_the_table(spark):
    rows = [(k, f"text {k} of its own here", "en", f"s{k % 2}", 5) for k in range(200)] + [(7, "one row again and again", "en", "s1", 6)] * 100
    docs = frame(spark, rows)
    plan = mixing.plan(docs)
    total = plan.groupBy("mix_row").agg(F.sum("copies").alias("n")).where("n > 0").collect()
    mixed = mixing.mixed(docs)
    got = mixed.groupBy("doc_id", "text").agg(F.count("*").alias("n"), F.max("mix_copy").alias("most")).collect()
    assert sorted(r.n for r in got) == sorted(r.n for r in total)
    hot = next(r for r in got if r.text.startswith("one"))
    copies = mixed.where(F.col("text") == hot.text).groupBy("mix_copy").count().collect()
    assert all(r["count"] == 100 for r in copies if r.mix_copy < hot.most) and hot.most <= 2
    kept = ngram_join.one_per_group(docs).where("doc_id = 7 AND text LIKE 'one%'").collect()
    assert len(kept) == 1


def test_terms_are_joined_by_shuffle_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST", 0)
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "b c d e f g h i j k"), (6, "a b c")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.report(docs, items).collect()}
    assert got == {1: (11, 11, 2), 2: (3, 3, 1)}


def test_lines_left_of_a_text(spark):
    rows = [(1, "a\nb\nc\nd", "en", "s", 7), (2, "x\na\nb\nc\ny", "en", "s", 9), (3, "a\nb\nc", "en", "s", 5), (4, None, "en", "s", None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.shortened(frame(spark, rows)).collect()}
    assert got == {1: ("a\nb\nc\nd", 7), 2: ("x\ny", 3), 4: (None, None)}


def test_quality_sample_is_one_row_an_id_and_whole_texts(spark, monkeypatch):
    """A repeated id and repeated rows do not enlarge the sample; lines in all are bounded."""
    seen = {}

    def fit(features, size, lengths, first, labels, documents):
        seen.update(lines=len(features), runs=len(lengths), documents=len(set(documents.tolist())), bytes=size.sum())
        return quality_crf.Field()

    monkeypatch.setattr(quality_crf, "fit", fit)
    long = "\n".join(f"Line {k} of a long text." for k in range(300))
    rows = [(1, long)] * 50 + [(1, long + "\nother")] * 50 + [(3, "Short.\nText.")] * 9 + [(4, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 30)] + [(1, 0), (None, 1)], "doc_id long, quality int")
    taught = [k for k in (1, 3, 4) if zlib.crc32(str(k).encode()) % 4 != 2]
    per_id = {1: (300, 301), 3: (2,), 4: (1,)}
    quality_crf.train(docs, labels)
    assert seen["documents"] == len(taught)
    assert seen["lines"] in {sum(x) for x in itertools.product(*[per_id[k] for k in taught])}
    quality_crf.train(docs, labels, lines_in_all=10)
    assert seen["lines"] == sum(per_id[k][0] for k in taught if k != 1)


def test_empty_pages_fill_archives_too(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    pages = spark.createDataFrame([(k, f"http://h/{k}", None) for k in range(600)], "page_id long, url string, html string")
    archives = warc.write_archives(pages.coalesce(1))
    assert archives.count() > 4
    assert warc.read_archives(archives).where("error IS NULL AND payload_bytes = 0").select("record_id").distinct().count() == 600


def test_a_line_of_many_documents_goes_from_a_large_host(spark):
    """Far below the share, above the number; and the other way round."""
    letters = str.maketrans("0123456789", "abcdefghij")  # digits are alike to the rule
    words = lambda k: " ".join(f"w{k}x{i}".translate(letters) for i in range(60))
    shared = " ".join(f"notice{i}" for i in range(80))
    rows = [(k, words(k) + ("\n" + shared if k < 40 else ""), "big") for k in range(900)]
    rows += [(1000 + k, words(k) + ("\n" + shared if k < 30 else ""), None) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = quality_rules.quality_rules(docs, many_docs=500)
    assert {r.doc_id for r in kept.where("NOT kept").collect()} == set(range(1000, 1030))
    kept = quality_rules.quality_rules(docs, many_docs=35)
    assert {r.doc_id for r in kept.where("NOT kept").collect()} == set(range(40)) | set(range(1000, 1030))
