"""Mix sources to target weights by systematic sampling.

Every source gets a target of words. Each of its documents then has the same
expected number of copies, target / size of the source. The documents of a
source stand in a fixed order, by size first; their expected copies are summed
up along it, one random offset per source is added, and a document is emitted
once for every whole number that its step crosses. Ordering by size keeps the
taken words within about the largest document of the target.

Nothing is collected and no source sits in one task: places in the order come
from counts per size (first window, rows: the distinct sizes of a source), then
counts per bucket of equal sizes (second window, at most 4,096 rows), then a
row number inside a bucket.

Defined cases: a null text has size 0; a null source is a source of its own and
stands last; a null id is ordered first; repeated rows are separate rows and are
sampled one by one; sources without words get target 0, and their documents no
copies; an empty table gives an empty result. Extra columns, whatever their names, are
ignored by ``plan`` and come back unchanged from ``mixed``, but for a ``mix_copy``,
which is replaced by the new number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carebasin.llm.common import WORD, orderable_part, packed, row_key
from carebasin.sources.writers import stage

#: Weights of the sources in code point order, repeated.
WEIGHTS = (5, 2, 1)
#: All targets together, as a share of all words.
SHARE = 1.5
#: No source, and no document, is taken more often than this.
MOST = 2.0
SEED = "mix"


def source_key(source: str = "source") -> Column:
    """Sorts like the source by code point, with null last."""
    name = F.col(source).cast("string")
    return F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name))


def uniform(seed: str, key: Column) -> Column:
    """A number in [0, 1) that depends on seed and key only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``mix_source, source_size, target`` from ``mix_source, size`` rows.

    Targets share the wanted total by weight and stop at ``most`` times the
    source's size. Sources are passed in the order of size to weight: once one
    is below its stop, so are all after it, hence one pass reshares the excess
    fully. The windows run over one row per source.
    """
    by_source = sizes.groupBy("mix_source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    in_order = everything.orderBy("mix_source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = by_source.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    )
    by_stop = everything.orderBy(F.col("source_size") / F.col("weight"), "mix_source")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    stop = F.col("source_size") * F.lit(most)
    left = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    )
    level = weighed.withColumn("level", left / F.sum("weight").over(after))
    # the first source that stays below its stop sets the level of all after it
    level = level.withColumn("place", F.row_number().over(by_stop))
    open_ = F.when(F.col("level") * F.col("weight") < stop, F.struct("place", "level"))
    level = level.withColumn("common", F.min(open_).over(everything)["level"])
    below = F.col("common").isNotNull() & (F.col("common") * F.col("weight") < stop)
    return level.select(
        "mix_source", "source_size",
        F.when(below, F.col("common") * F.col("weight")).otherwise(stop).alias("target"),
    )


def plan(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Each document's ``doc_id, mix_row, mix_source, size, source_size, target,
    copies``; ``mix_row`` is a key of id and text."""
    slim = stage(
        docs.select(
            "doc_id", row_key().alias("mix_row"), source_key().alias("mix_source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3)
            .alias("mix_bucket"),
        ),
        "mix-sizes",
    )
    targets = stage(source_targets(slim, weights, share, most), "mix-targets")

    group = ["mix_source", "size"]
    per_bucket = slim.groupBy(*group, "mix_bucket").agg(F.count(F.lit(1)).alias("n"))
    per_size = slim.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    ahead = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before_size = per_size.select(*group, ahead(Window.partitionBy("mix_source").orderBy("size")).alias("by_size"))
    before_bucket = per_bucket.select(
        *group, "mix_bucket", ahead(Window.partitionBy(*group).orderBy("mix_bucket")).alias("by_bucket")
    )
    places = before_bucket.join(before_size, group).join(targets, "mix_source")
    places = places.withColumn("before", F.col("by_size") + F.col("by_bucket")).drop("by_size", "by_bucket")
    inside = Window.partitionBy(*group, "mix_bucket").orderBy("doc_id", "mix_row")
    placed = slim.withColumn("inside", F.row_number().over(inside)).join(places, [*group, "mix_bucket"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("before") + F.col("inside")
    offset = uniform(seed, F.col("mix_source"))
    crossed = F.floor(offset + place * expected) - F.floor(offset + (place - 1) * expected)
    return placed.select(
        "doc_id", "mix_row", "mix_source", "size", "source_size", "target", crossed.cast("long").alias("copies")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the plan says, with
    the number of the copy in ``mix_copy`` (from 1). Rows that repeat id and text
    share their copies evenly: as many as all can have go to each, and one more to the
    first of them by source and the other columns."""
    docs = docs.drop("mix_copy")
    copies = plan(docs, **options).groupBy("mix_row").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    keyed = packed(docs, row_key().alias("mix_row"), source_key().alias("mix_source"))
    keyed = keyed.withColumn("kind", F.xxhash64(orderable_part(docs)))
    # equal rows are counted, in tasks first, and never ranked one by one
    kinds = keyed.groupBy("mix_row", "kind").agg(F.min("mix_source").alias("mix_source"), F.count(F.lit(1)).alias("n"))
    in_order = Window.partitionBy("mix_row").orderBy("mix_source", "kind")
    before = F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shared = kinds.withColumn("before", before).join(copies.where("copies > 0").hint("merge"), "mix_row")
    rest = F.col("copies") % F.col("rows") - F.col("before")
    shared = shared.select(
        "mix_row", "kind", F.floor(F.col("copies") / F.col("rows")).cast("int").alias("each"),
        F.least(F.greatest(rest, F.lit(0)), F.col("n")).cast("int").alias("more"), "n",
    )
    shared = stage(shared.where("each > 0 OR more > 0").withColumns({
        # a row that stands alone has its one more copy at once
        "each": F.when(F.col("n") == 1, F.col("each") + F.col("more")).otherwise(F.col("each")),
        "more": F.when(F.col("n") == 1, F.lit(0)).otherwise(F.col("more")),
    }), "mix-shared")
    # merge joins at every size; nothing above them keeps a hot row from being split
    name = "mix_copy"
    held = keyed.join(shared.where("each > 0").select("mix_row", "kind", "each").hint("merge"), ["mix_row", "kind"])
    held = held.select("row", F.explode(F.sequence(F.lit(1), F.col("each"))).alias(name))
    extra = keyed.join(shared.where("more > 0").select("mix_row", "kind", "each", "more").hint("merge"), ["mix_row", "kind"])
    one = extra.groupBy("mix_row", "kind").agg(F.first("row").alias("row"), F.first("each").alias("each"), F.first("more").alias("more"))
    one = one.select("row", (F.col("each") + 1).alias(name), F.explode(F.sequence(F.lit(1), F.col("more")))).select("row", name)
    return held.unionByName(one).select("row.*", name)


def report(docs: DataFrame) -> DataFrame:
    """One row per document of the mix plan, with the words taken."""
    return plan(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


SQL = f"""
WITH sized AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS s,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
        substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3) AS bucket
    FROM documents),
sums AS (SELECT s, sum(size)::DOUBLE AS source_size FROM sized GROUP BY s),
weighed AS (
    SELECT *, CASE (row_number() OVER (ORDER BY s) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
    FROM sums),
levels AS (
    SELECT *, row_number() OVER (ORDER BY source_size / w, s) AS place, ({SHARE} * sum(source_size) OVER () - {MOST} * coalesce(sum(source_size) OVER (
            ORDER BY source_size / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY source_size / w, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed),
shared AS (
    SELECT *, (SELECT level FROM levels WHERE level * w < {MOST} * source_size ORDER BY place LIMIT 1) AS common
    FROM levels),
targets AS (
    SELECT s, source_size, CASE WHEN common IS NOT NULL AND common * w < {MOST} * source_size
        THEN common * w ELSE {MOST} * source_size END AS target,
        ('0x' || substr(md5('{SEED}:' || s), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
    FROM shared),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY s ORDER BY size, bucket, doc_id NULLS FIRST) AS k FROM sized),
taken AS (
    SELECT doc_id, size, source_size, target, (floor(u + k * f) - floor(u + (k - 1) * f))::BIGINT AS copies
    FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS f
        FROM placed JOIN targets USING (s)))
SELECT doc_id, size, source_size::BIGINT AS source_size, target, copies * size AS taken, copies FROM taken
"""
