"""Remove repeated passages by overlapping windows of three lines.

A text is cut at ``\\n``. Every three consecutive lines are a window, hashed
after each line is stripped of blanks. A window that occurs earlier (smaller
id, or the same document at an earlier line) is repeated; the lines under a
document's repeated windows are merged to covered runs and removed. Windows are
judged on the input, not on what is left.

Defined cases: a text of fewer than three lines has no window and is kept; a
window without any word is never repeated; a null text stays null; null ids
stand last in the order; rows that repeat id and text are one document and are
treated alike; an empty table gives an empty result. Extra columns, whatever their
names, come back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import WORD, packed, row_key
from carebasin.sources.writers import stage

#: Lines in a window.
LINES = 3
STRIP = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def windows(docs: DataFrame) -> DataFrame:
    """``line_key, doc_id, at, hash`` of each document's windows. Documents that
    repeat id and text in one task give them once; the rest merge in the counts."""
    lines = docs.select(
        row_key().alias("line_key"), "doc_id",
        F.transform(F.split("text", "\n", -1), lambda x: F.regexp_replace(x, STRIP, "")).alias("lines"),
    ).where(F.size("lines") >= LINES)
    hashed = lines.withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x))).withColumn(
        "filled", F.transform("lines", lambda x: x != "")
    )
    each = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - LINES),
        lambda i: F.when(
            F.get("filled", i) | F.get("filled", i + 1) | F.get("filled", i + 2),
            F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2)),
        ),
    )
    return hashed.select("line_key", "doc_id", F.posexplode(each).alias("at", "hash")).where("hash IS NOT NULL")


def covered_lines(docs: DataFrame) -> DataFrame:
    """``line_key, starts``: where each document's repeated windows start."""
    held = stage(windows(docs), "line-windows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line_key", "at")
    first = held.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("final"))
    # a table of its own, so that the join reads two plain shuffles and a hot window is split
    first = stage(first.where("first < final").select("hash", "first"), "line-firsts")
    later = held.join(first, "hash").where(place > F.col("first"))
    return later.groupBy("line_key").agg(F.sort_array(F.collect_set("at")).alias("starts"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``row`` (the columns of ``docs``), ``text``, ``kept`` (what is left of it), and
    the number of ``lines``, of ``removed`` lines and of removed runs (``spans``)."""
    starts = stage(covered_lines(docs), "line-covered")
    # a merge join at every size: the texts are shuffled by key, the starts never broadcast
    keyed = packed(docs, "text", row_key().alias("line_key"))
    joined = keyed.join(starts.hint("merge"), "line_key", "left").withColumn("every", F.split("text", "\n", -1))
    # lines and starts of windows in one sorted array: a line is covered if a start stands
    # close before it. Both lambdas take a bound array, so no step searches or copies it
    marks = F.concat(
        F.transform("every", lambda x, i: F.struct(i.alias("at"), F.lit(1).alias("kind"), x.alias("line"))),
        F.transform("starts", lambda s: F.struct(s.alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("line"))),
    )

    def uncovered(sorted_: Column) -> Column:
        def stays(mark: Column, i: Column) -> Column:
            start = F.lit(False)
            for k in range(1, 2 * LINES):
                before = F.get(sorted_, i - k)
                start = start | F.coalesce((before["kind"] == 0) & (before["at"] > mark["at"] - LINES), F.lit(False))
            return (mark["kind"] == 1) & ~start

        return F.transform(F.filter(sorted_, stays), lambda mark: mark["line"])

    left = F.element_at(F.transform(F.array(F.sort_array(marks)), uncovered), 1)
    spans = F.size(F.filter("starts", lambda s, i: F.get("starts", i - 1).isNull() | (s - F.get("starts", i - 1) > LINES)))
    covered = F.col("starts").isNotNull()
    joined = joined.withColumn("left", F.when(covered, left))
    return joined.select(
        "row", "text", F.when(covered, F.concat_ws("\n", "left")).otherwise(F.col("text")).alias("kept"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("every")).cast("long").alias("lines"),
        F.when(covered, F.size("every") - F.size("left")).otherwise(F.lit(0)).cast("long").alias("removed"),
        F.when(covered, spans).otherwise(F.lit(0)).cast("long").alias("spans"),
    )


def shortened(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept text in place of ``text`` and its length in
    ``n_chars``; documents of which no word is left go."""
    marked = deduplicated(docs).where((F.col("removed") == 0) | F.col("kept").rlike(WORD))
    new = {"text": F.col("kept").alias("text")}
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("removed") > 0, F.length("kept")).otherwise(F.col("row.n_chars"))
        new["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return marked.select(*[new.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """One row per document with a digest of what is kept (null text: of '')."""
    kept = F.coalesce("kept", F.lit(""))
    return deduplicated(docs.select("doc_id", "text")).select(
        "row.doc_id", F.col("lines").alias("n_lines"), F.col("removed").alias("n_removed"), F.col("spans").alias("n_spans"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines
    FROM documents),
stripped AS (
    SELECT *, list_transform(lines, lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS clean
    FROM d),
w AS (
    SELECT r, doc_id, text, i, [list_extract(clean, i), list_extract(clean, i + 1), list_extract(clean, i + 2)] AS h
    FROM (SELECT *, unnest(range(1, len(clean) - 1)) AS i FROM stripped)),
ranked AS (
    SELECT r, i, dense_rank() OVER (PARTITION BY h ORDER BY doc_id NULLS LAST, text, i) AS k
    FROM w WHERE list_aggregate(list_transform(h, lambda x: length(x)), 'sum') > 0),
gone AS (
    SELECT DISTINCT r, i + o AS i FROM ranked, (VALUES (0), (1), (2)) AS v(o) WHERE k > 1),
spans AS (
    SELECT r, count(*) AS n, sum(CASE WHEN p IS NULL OR i > p + 1 THEN 1 ELSE 0 END) AS s
    FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM gone) GROUP BY r),
kept AS (
    SELECT r, string_agg(x, chr(10) ORDER BY i) AS t
    FROM (SELECT r, unnest(lines) AS x, unnest(range(1, len(lines) + 1)) AS i FROM d) ANTI JOIN gone USING (r, i)
    GROUP BY r)
SELECT doc_id, len(lines)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed, coalesce(s, 0)::BIGINT AS n_spans,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN spans USING (r) LEFT JOIN kept USING (r)
"""
