"""Benchmark decontamination by a distributed positional inverted index.

Items are cut into windows of ten consecutive words (a shorter item is one
window). Corpus frequencies of the items' terms rank the terms of each window.

* **Phrases.** The index stores the positions of every window's two rarest terms in
  the training texts. The two lists are shifted by the terms' offsets in the window
  and intersected, once for all windows with the same two terms at the same
  distance. Only places in both lists are compared word by word with the
  words around the rarest term, which are kept beside its position.
* **Proximity.** A match holds ``NEAR`` percent of a window's different words within a
  window's length on both sides of one of them. It lacks few of them, so it
  holds one of the few rarest (one more than it may lack; those that no text holds
  have empty lists): all of these are probed.

Terms are compared by 64-bit hashes of their words. The texts are cut into terms
once, and these are written; later steps read them. Items are the small side:
their terms and windows are broadcast if they are counted below ``BROADCAST``
rows, and joined by shuffle otherwise. Then positions alone are shuffled by term, and
the words around them are cut out where they meet their document's terms again.

Defined cases: null or wordless texts have no words, no windows and no hits; an
item without words never occurs; repeated items count once by id, and a null id
as the empty text; rows that repeat id and text share their result; empty
tables give no hits or no rows. Extra columns, whatever their names, are ignored by
``report`` and come back unchanged from ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebasin.llm.common import ascii_lower, free_name, row_key
from carebasin.sources.writers import stage

#: Words, after lower-casing: digits, small letters, and all beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a window.
WINDOW = 10
#: A proximity match holds so many of 100 different words of a window.
NEAR = 80
#: Rows of terms or windows up to which they are broadcast (16 to 200 bytes each).
BROADCAST = 200_000


def terms(text: Column) -> Column:
    found = F.regexp_extract_all(ascii_lower(text), F.lit(TERM), F.lit(0))
    return F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda w: F.xxhash64(w))


def small(df: DataFrame) -> DataFrame:
    """Broadcast a staged table of the item side if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


def item_windows(items: DataFrame) -> DataFrame:
    """``window, item, terms`` of every window of every item."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), terms(F.col("text")).alias("all"))
    words = words.where(F.size("all") > 0).distinct()
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - WINDOW + 1, F.lit(1)))
    cut = words.withColumn("starts", starts).select(
        "item", F.explode(F.transform("starts", lambda s: F.slice("all", s, F.lit(WINDOW)))).alias("terms")
    )
    return cut.select(F.xxhash64("item", "terms").alias("window"), "item", "terms").distinct()


def cut_texts(docs: DataFrame) -> DataFrame:
    """``key, doc_id, terms`` of all rows, written once."""
    return stage(docs.select(row_key().alias("key"), "doc_id", terms(F.col("text")).alias("terms")), "leak-texts")


def ranked_windows(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``window, item, terms, ranked``: terms and offsets, the rarest in the corpus first."""
    windows = stage(item_windows(items), "leak-windows")
    offsets = windows.select("window", "item", "terms", F.posexplode("terms").alias("offset", "term"))
    vocabulary = stage(offsets.select("term").distinct(), "leak-terms")
    corpus = texts.select(F.explode("terms").alias("term"))
    counts = stage(corpus.join(small(vocabulary), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "leak-counts")
    rank = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term")))
    return stage(offsets.join(counts, "term", "left").groupBy("window", "item", "terms").agg(rank.alias("ranked")), "leak-ranked")


def positions(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The index: ``term, key, at`` of all wanted terms (``term, probe``), and for those
    to probe the words ``around`` each place."""
    wanted = stage(wanted.groupBy("term").agg(F.max("probe").alias("probe")), "leak-wanted")
    around = F.when(F.col("probe"), F.slice("terms", F.greatest(F.col("at") - (WINDOW - 1), F.lit(0)) + 1, F.lit(2 * WINDOW - 1)))
    if wanted.count() <= BROADCAST:
        found = texts.select("key", "terms", F.posexplode("terms").alias("at", "term")).join(F.broadcast(wanted), "term")
    else:
        # places alone go to their terms; a text's places come back to it together
        places = texts.select("key", F.posexplode("terms").alias("at", "term")).join(wanted, "term")
        held = places.groupBy("key").agg(F.collect_set(F.struct("at", "term", "probe")).alias("places"))
        found = texts.select("key", "terms").join(held.hint("merge"), "key").select("key", "terms", F.explode("places").alias("x"))
        found = found.select("key", "terms", "x.at", "x.term", "x.probe")
    return stage(found.select("term", "key", "at", around.alias("around")), "leak-index")


def phrases(texts: DataFrame, ranked: DataFrame) -> DataFrame:
    """``key, item, window, start, length`` of exact phrases."""
    first, second = F.get("ranked", F.lit(0)), F.get("ranked", F.lit(1))
    present = stage(ranked.where(first["n"] > 0).select(
        "window", "item", "terms", first["term"].alias("t0"), first["offset"].alias("offset"),
        second["term"].alias("t1"), (second["offset"] - first["offset"]).alias("gap"),
    ), "leak-present")
    wanted = present.select(F.col("t0").alias("term"), F.lit(True).alias("probe"))
    wanted = wanted.unionByName(present.where("t1 IS NOT NULL").select(F.col("t1").alias("term"), F.lit(False).alias("probe")))
    index = positions(texts, wanted)
    pairs = stage(present.select("t0", "t1", "gap").distinct(), "leak-pairs")
    rarest = index.where("around IS NOT NULL").withColumnRenamed("term", "t0").join(small(pairs), "t0")
    # lists of the second terms, shifted to the places where the rarest ones must be
    shifted = index.select(F.col("term").alias("t1"), "key", F.col("at").alias("there")).hint("merge")
    both = rarest.where("t1 IS NOT NULL").withColumn("there", F.col("at") + F.col("gap")).join(shifted, ["t1", "key", "there"], "left_semi")
    both = both.drop("there").unionByName(rarest.where("t1 IS NULL"))
    both = stage(both.withColumns({"t1": F.coalesce("t1", F.lit(0)), "gap": F.coalesce("gap", F.lit(0))}), "leak-both")
    named = present.withColumns({"t1": F.coalesce("t1", F.lit(0)), "gap": F.coalesce("gap", F.lit(0))})
    begin = F.least(F.col("at"), F.lit(WINDOW - 1)) - F.col("offset")
    inside = F.when(begin >= 0, F.slice("around", begin + 1, F.size("terms")))
    found = both.join(small(named), ["t0", "t1", "gap"]).where(inside == F.col("terms"))
    return found.select("key", "item", "window", (F.col("at") - F.col("offset")).alias("start"), F.size("terms").alias("length"))


def near_matches(texts: DataFrame, ranked: DataFrame) -> DataFrame:
    """``key, item, window, start, length`` of all proximity matches, phrases
    included; ``start`` is where the window would begin by the probed word."""
    probed = F.floor(F.size(F.array_distinct("terms")) * F.lit(100 - NEAR) / 100) + 1
    different = F.array_distinct(F.transform("ranked", lambda r: r["term"]))
    probes = stage(ranked.select(
        "window", "item", "terms", F.explode(F.slice(different, F.lit(1), probed.cast("int"))).alias("term")
    ).withColumn("offset", F.array_position("terms", F.col("term")) - 1), "leak-probes")
    index = positions(texts, probes.select("term", F.lit(True).alias("probe")))
    found = index.join(small(probes), "term").where(
        F.size(F.array_intersect("terms", "around")) * 100 >= F.lit(NEAR) * F.size(F.array_distinct("terms"))
    )
    return found.select("key", "item", "window", (F.col("at") - F.col("offset")).cast("int").alias("start"), F.size("terms").alias("length"))


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``key, item, window, start, length, phrase`` of exact phrases, and (``phrase``
    false) of proximity matches that are none."""
    texts = cut_texts(docs)
    ranked = ranked_windows(texts, items)
    exact = stage(phrases(texts, ranked).distinct(), "leak-phrases")
    near = near_matches(texts, ranked).distinct().join(exact.hint("merge"), ["key", "item", "window", "start", "length"], "left_anti")
    return exact.withColumn("phrase", F.lit(True)).unionByName(near.withColumn("phrase", F.lit(False)))


def hits(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``key, n_hit, items`` of the documents with exact phrases."""
    found = phrases(texts, ranked_windows(texts, items))
    spans = F.sort_array(F.collect_set(F.struct("start", "length")))
    merged = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(s["start"], a["end"]))).alias("n"),
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    grouped = found.groupBy("key").agg(spans.alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    return stage(grouped.select("key", merged.cast("long").alias("n_hit"), "items"), "leak-hits")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    texts = cut_texts(docs)
    found = hits(texts, items)
    every = texts.select("key", "doc_id", F.size("terms").cast("long").alias("n_words"))
    ids = F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>")))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return every.join(found, "key", "left").select(
        "doc_id", "n_words", hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any exact phrase of an item."""
    name = free_name(docs, "leak_key")
    found = hits(cut_texts(docs), items).select(F.col("key").alias(name))
    return docs.withColumn(name, row_key()).join(found, name, "left_anti").drop(name)


T = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CUT = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_CUT}, '{T}') AS words FROM benchmark),
iw AS (
    SELECT DISTINCT item, n, array_to_string(words[s:s + n - 1], ' ') AS w
    FROM (SELECT item, words, least(len(words), 10) AS n, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s
        FROM i WHERE len(words) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_CUT}, '{T}') AS words FROM documents),
dw AS (
    SELECT r, s, n, array_to_string(words[s:s + n - 1], ' ') AS w
    FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(words) >= n)),
found AS (SELECT r, s, n, item FROM dw JOIN iw USING (n, w)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r),
ids AS (
    SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""
