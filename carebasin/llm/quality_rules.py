"""Quality rules: base counts per document, and lines that a host repeats.

Lines are normalised (ASCII lower case, digits as 0, blanks as one space) and
hashed. Per host, each line's distinct documents are counted. Lines in more than
``MANY_DOCS`` documents are removed, and in small hosts those in more than ``MIN_DOCS``
documents that are more than ``MAX_SHARE`` of the host's: either limit is enough. A document that loses more than half of its words is depleted and rejected.

Exact copies of a text in one host count as one document: a page that is merely
stored often is the business of deduplication. The text is read once; what the
later steps need is written to the shared folder.

Defined cases: a null text has no words and fails the base rules; null sources
are one host; repeated rows each get a result; an empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import WORD, ascii_lower
from carebasin.llm.mixing import source_key
from carebasin.sources.writers import stage

MIN_WORDS = 50
MAX_REPEATED = 50
#: A line is removed from a host if more documents hold it than this number
#: and this share of the host's documents,
MIN_DOCS = 20
MAX_SHARE = 0.1
#: or more than this number, however large the host is.
MANY_DOCS = 500
#: A document is depleted if less than this share of its words is left.
MIN_LEFT = 0.5

BLANKS = r"[\x20\x09-\x0D]+"


def normalised(line: Column) -> Column:
    plain = F.regexp_replace(F.translate(ascii_lower(line), "123456789", "000000000"), BLANKS, " ")
    return F.trim(plain)


def with_repeats(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` from ``words``: the words inside three-word windows
    that the text holds twice or more. The windows are compared by 64-bit hashes."""
    df = df.withColumn("w1", F.transform("words", lambda w: F.xxhash64(w)))
    three = F.transform(
        "w1", lambda w, i: F.xxhash64(w, F.get("w1", i + 1), F.get("w1", i + 2))
    )
    df = df.withColumn("w3", F.slice(three, F.lit(1), F.greatest(F.size("w1") - 2, F.lit(0))))
    df = df.withColumn("twice", F.size(F.array_distinct("w3")) < F.size("w3"))
    df = df.withColumn(
        "ranked",
        F.when(F.col("twice"), F.sort_array(F.transform("w3", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))),
    )
    same = lambda x, i: (
        (x["w"] == F.get("ranked", i - 1)["w"]) | (x["w"] == F.get("ranked", i + 1)["w"])
    )
    places = F.sort_array(F.transform(F.filter("ranked", same), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def measured(docs: DataFrame) -> DataFrame:
    """Base counts and hashed lines of every document, one row each."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(
        "doc_id", source_key().alias("host"), text.alias("text"), F.xxhash64(text).alias("text_hash"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
    )
    df = with_repeats(df)
    lines = F.transform(
        "lines", lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n"))
    )
    blank = F.length(F.translate("text", " \t\n\x0b\x0c\r", ""))
    return df.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "host", "text_hash",
        F.size("words").cast("long").alias("n_words"),
        blank.cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        lines.alias("lines"),
    )


def frequent_lines(slim: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
                   many_docs: int = MANY_DOCS) -> DataFrame:
    """``host, line, n_docs`` of the lines above one of their host's limits."""
    texts = slim.select("host", "text_hash").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    lines = slim.select("host", "text_hash", F.explode("lines.line").alias("line")).distinct()
    counted = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > min(min_docs, many_docs))
    share = (F.col("n_docs") > min_docs) & (F.col("n_docs") > F.lit(max_share) * F.col("host_docs"))
    over = counted.join(texts, "host").where(share | (F.col("n_docs") > many_docs))
    return over.select("host", "line", "n_docs")


def quality_rules(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
                  min_left: float = MIN_LEFT, many_docs: int = MANY_DOCS) -> DataFrame:
    """Base counts, words in removed lines, and the verdict, one row a document."""
    slim = stage(measured(docs), "rules")
    frequent = stage(frequent_lines(slim, min_docs, max_share, many_docs), "rules-lines")
    held = slim.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.n")
    lost = held.join(frequent, ["host", "line"]).groupBy("row").agg(
        F.sum("n").alias("n_removed_words"), F.count(F.lit(1)).alias("n_removed_lines")
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED) * F.col("n_words")
    )
    removed = F.coalesce("n_removed_words", F.lit(0)).cast("long")
    depleted = F.col("n_words") - removed < F.lit(min_left) * F.col("n_words")
    return slim.join(lost, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept"),
        removed.alias("n_removed_words"), F.coalesce("n_removed_lines", F.lit(0)).cast("long").alias("n_removed_lines"),
    )


W = r"[^\x20\x09-\x0D]+"
SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS host,
        regexp_extract_all(coalesce(text, ''), '{W}') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{W}')) AS lines
    FROM documents),
w3 AS (
    SELECT r, i, list_extract(words, i) || ' ' || list_extract(words, i + 1) || ' ' || list_extract(words, i + 2) AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
again AS (SELECT r, i FROM w3 QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
repeats AS (
    SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
held AS (
    SELECT r, host, text, trim(regexp_replace(translate(x,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
        len(regexp_extract_all(x, '{W}')) AS n
    FROM (SELECT r, host, text, unnest(lines) AS x FROM d)),
hosts AS (SELECT host, count(DISTINCT text) AS host_docs FROM d GROUP BY host),
frequent AS (
    SELECT host, line FROM held JOIN hosts USING (host) GROUP BY host, line, host_docs
    HAVING count(DISTINCT text) > {MANY_DOCS}
        OR count(DISTINCT text) > {MIN_DOCS} AND count(DISTINCT text) > {MAX_SHARE} * host_docs),
lost AS (SELECT r, sum(n) AS words, count(*) AS lines FROM held JOIN frequent USING (host, line) GROUP BY r),
base AS (
    SELECT doc_id, len(d.words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(d.lines) - len(list_distinct(d.lines)) AS n_dup_lines,
        coalesce(repeats.n, 0) AS n_repeat_words, coalesce(lost.words, 0) AS removed, coalesce(lost.lines, 0) AS gone
    FROM d LEFT JOIN repeats USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
    (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AS base_failed,
    NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
        AND n_words - removed >= {MIN_LEFT} * n_words AS kept,
    removed::BIGINT AS n_removed_words, gone::BIGINT AS n_removed_lines
FROM base
"""
