"""The corpus pipeline, stage by stage, beside brute force."""

import re
from functools import reduce
from operator import and_

import brute
import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    rows = brute.odd_documents(21)
    brute.write(folder / "documents.parquet", rows)
    leaked = next(r[1] for r in rows if r[0] == 7)
    items = [(1, leaked[:120].rsplit(" ", 1)[0]), (2, "nothing of this kind is there at all in these texts")]
    brute.write(folder / "benchmark.parquet", items, pa.schema([("item_id", pa.int64()), ("text", pa.string())]))
    return str(folder), rows, items


def lines(rows):
    """Texts without the three-line windows that occur earlier."""
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows if r[1]})
    seen, out = set(), {}
    for no_id, id_, text in order:
        cut = text.split("\n")
        clean = [x.strip(" \t\n\r\x0b\x0c") for x in cut]
        gone = set()
        for i in range(len(cut) - 2):
            w = tuple(clean[i: i + 3])
            if any(w):
                gone |= {i, i + 1, i + 2} if w in seen else set()
                seen.add(w)
        left = "\n".join(x for i, x in enumerate(cut) if i not in gone)
        out[no_id, id_, text] = (left, bool(gone))
    result = []
    for r in rows:
        left, changed = out.get((r[0] is None, r[0] or 0, r[1] or ""), (r[1], False))
        if not changed:
            result.append(r)
        elif brute.words(left):
            result.append((r[0], left, r[2], r[3], len(left)))
    return result


def test_stages_equal_brute_force(spark, tables, tmp_path):
    folder, rows, items = tables
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), rows
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_duplicates", "decontaminate", "mix"]
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        got = [tuple(r) for r in docs.collect()]
        if name == "language":
            assert set(map(repr, got)) <= set(map(repr, rows)) and len(got) >= 0.8 * len(rows)
            assert all(any(c.isalpha() for c in r[1] or "") for r in got)
            kept = got
        elif name == "line_dedup":
            assert brute.in_order(got) == brute.in_order(lines(kept))
        elif name == "near_duplicates":
            assert brute.in_order(got) == brute.in_order(brute.kept_of_groups(kept))
        elif name == "decontaminate":
            term = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
            cut = lambda t: term.findall((t or "").translate(brute.LOWER))
            windows = {tuple(w[i: i + 10]) for _, t in items for w in [cut(t)] for i in range(max(1, len(w) - 9))}
            hit = lambda t: any(tuple(cut(t)[i: i + 10]) in windows for i in range(len(cut(t))))
            assert brute.in_order(got) == brute.in_order(r for r in kept if not hit(r[1]))
            assert len(got) < len(kept)
        else:
            assert docs.columns == [*COLUMNS, "mix_copy"]
            assert {r[:5] for r in got} <= set(kept) and max(r[5] for r in got) <= 2
            size = lambda rs: sum(len(brute.words(r[1])) for r in rs)
            assert abs(size(got) - 1.5 * size(kept)) <= 5 * max(len(brute.words(r[1])) for r in kept)
        if name != "mix":
            assert docs.columns == COLUMNS
            kept = got


def test_columns_of_the_caller_come_back_unchanged(spark, tables, tmp_path):
    _, rows, items = tables
    names = ["lang_conf", "lang_pred", "lang_score", "line_x", "line_key", "join_key", "join_rank", "leak_key", "mix_x", "mix_copy",
             "mix_row", "row", "key", "worded", "kind", "kept", "every", "starts", "left", "removed", "each", "more", "odd.name"]
    brute.write(tmp_path / "documents.parquet", rows, **{name: f"of {name}" for name in names})
    brute.write(tmp_path / "benchmark.parquet", items, pa.schema([("item_id", pa.int64()), ("text", pa.string())]))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).withColumn("held", F.struct(F.create_map(F.lit("a"), F.lit(1)).alias("m")))
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "mix":  # the number of the copy takes the place of the caller's column
            names.remove("mix_copy")
        assert docs.columns == [*COLUMNS, *names, "held"] + (["mix_copy"] if name == "mix" else [])
        same = [F.col(f"`{n}`") == F.lit(f"of {n}") for n in names] + [F.col("held.m")["a"] == 1]
        assert docs.where(~reduce(and_, same)).count() == 0 and docs.count() > 20


def test_run_gives_the_last_stage(spark, tables):
    folder, _, _ = tables
    once, again = (brute.in_order(map(tuple, corpus_pipeline.run(spark, folder).collect())) for _ in range(2))
    assert once == again and once


def test_empty_documents(spark, tmp_path):
    brute.write(tmp_path / "documents.parquet", [])
    brute.write(tmp_path / "benchmark.parquet", [], pa.schema([("item_id", pa.int64()), ("text", pa.string())]))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
