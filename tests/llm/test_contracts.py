"""Results of the registered queries: beside their SQL, and beside brute force."""

import base64
import hashlib
import math
import os
import zlib

import brute
import duckdb
import pyarrow as pa
import pytest

from carebasin.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
VIEWS = ("documents", "benchmark", "pages", "labels")
ITEMS = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Tables of odd rows; extra columns have names that operators use inside."""
    folder = tmp_path_factory.mktemp("odd")
    rows = brute.odd_documents()
    clash = dict.fromkeys(["key", "id", "n", "at", "term", "unit", "size", "line_text", "mix_copy", "lang_pred", "row"], "x")
    brute.write(folder / "documents.parquet", rows, **clash)
    text = [r[1] for r in rows if r[1] and len(r[1]) > 300][:6]
    items = [(k, " ".join(t.split()[7: 7 + 12 + k])) for k, t in enumerate(text)]
    items += [(7, "one"), (8, None), (None, text[0]), (9, ""), (10, "no such words at all"), (0, items[0][1]), (11, "ONE, two; three!")]
    brute.write(folder / "benchmark.parquet", items, ITEMS)
    pages = [(k, f"http://h/{k}", f"<p>{'same' if k % 3 else k}</p>" * 30) for k in range(40)]
    pages += [(40, None, None), (41, "", ""), (None, "http://h/x\r\ny", "<p>same</p>" * 30), (5, "http://h/5", "<p>same</p>" * 30), (43, "u", "é" * 70000)]
    pages += [pages[38]]
    brute.write(folder / "pages.parquet", pages, PAGES, digest="x", refers="x")
    labels = [(r[0], int(r[0] % 3 > 0), 0) for r in rows if r[0] is not None] + [(None, 1, 0), (3, None, 1), (999, 0, 0), (4, 0, 0)]
    brute.write(folder / "labels.parquet", labels, LABELS)
    return str(folder), rows, pages


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in zip(VIEWS, (brute.DOCUMENTS, ITEMS, PAGES, LABELS)):
        brute.write(folder / f"{name}.parquet", [], schema)
    return str(folder)


def result(spark, name, folder, columns=None):
    df = QUERIES[name](spark, folder)
    return [tuple(r) for r in df.select(*(columns or df.columns)).collect()]


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("tables", ["odd", "given", "empty"])
def test_query_equals_its_sql(spark, odd, empty, name, tables):
    folder = {"odd": odd[0], "given": SF_DIR, "empty": empty}[tables]
    if not os.path.isdir(folder):
        pytest.skip("the given tables are absent")
    connection = duckdb.connect()
    for view in VIEWS:
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{folder}/{view}.parquet'")
    relation = connection.sql(SQL[name])
    assert sorted(relation.columns) == sorted(QUERIES[name](spark, folder).columns)
    assert brute.in_order(result(spark, name, folder, relation.columns)) == brute.in_order(relation.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert result(spark, name, empty) == []


def test_join_equals_all_pairs(spark, odd, monkeypatch):
    folder, rows, _ = odd
    got = result(spark, "op1_ngram_join", folder, ["doc_id", "n_shingles", "component_id", "n_links"])
    assert brute.in_order(got) == brute.in_order(brute.join(rows))


def test_suffix_dedup_equals_all_strings(spark, odd):
    folder, rows, _ = odd
    got = result(spark, "op2_suffix_dedup", folder, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    assert brute.in_order(got) == brute.in_order(brute.suffix(rows))


def test_language_contract(spark, odd):
    folder, rows, _ = odd
    got = result(spark, "op3_language", folder, ["doc_id", "held_out", "lang_pred", "score"])
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for id_, held_out, pred, score in got:
        assert held_out == (zlib.crc32(("" if id_ is None else str(id_)).encode()) % 5 == 0)
        assert 0 <= score <= 1 and pred in ("en", "fr", "und")
        if id_ is not None and id_ != 86:
            assert (pred == "und") == (not any(c.isalpha() for c in text[id_] or ""))


def test_warc_round_trip(spark, odd):
    folder, _, pages = odd
    best = {}
    for id_, _, html in pages:
        raw = (html or "").encode()
        best[raw] = max((x for x in (best.get(raw), id_) if x is not None), default=None)
    want = []
    for id_, _, html in pages:
        raw = (html or "").encode()
        code = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        same = best[raw] == id_
        want.append((id_, len(raw), code, "response" if same else "revisit", None if same else best[raw], None))
    assert brute.in_order(result(spark, "op4_warc", folder)) == brute.in_order(want)


def test_base_scores_equal_counts(spark, odd):
    folder, rows, _ = odd
    c = brute.counts(rows, 5, 1)
    n, v = sum(c.values()), len(c)
    want = []
    for r in rows:
        tokens = [*brute.words(r[1]), None]
        base = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        want.append((r[0], len(tokens), sum(c[t] > 0 for t in tokens), n, round(base, 5)))
    got = result(spark, "op7_lattice_lm", folder, ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    assert brute.in_order((*g[:4], round(g[4], 5)) for g in got) == brute.in_order(want)
    assert all(g[5] < 0 for g in got)


def test_quality_contract(spark, odd):
    folder, rows, _ = odd
    got = result(spark, "op10_quality_classifier", folder, ["doc_id", "held_out", "score", "predicted"])
    assert len(got) == len(rows)
    for id_, held_out, score, predicted in got:
        assert held_out == (zlib.crc32(("" if id_ is None else str(id_)).encode()) % 4 == 2)
        assert 0 <= score <= 1 and predicted == int(score >= 0.7)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the given tables are absent")
def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    langs = QUERIES["op3_language"](spark, folder).where("held_out").join(documents, "doc_id")
    assert langs.where("lang = lang_pred").count() >= 0.97 * langs.count()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    quality = QUERIES["op10_quality_classifier"](spark, folder).where("held_out").join(labels, "doc_id")
    assert quality.where("quality = predicted").count() >= 0.93 * quality.count()
