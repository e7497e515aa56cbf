"""Single operators on the given tables as they are."""

from __future__ import annotations

from pyspark.sql import functions as F

from carebasin.functions import columns as fx
from carebasin.operators import claims, clinical, conform, money, people
from carebasin.operators.dedup import one_per_key
from carebasin.operators.profile import null_profile, row_counts
from carebasin.operators.quantile import approximate_quantile, exact_quantile
from carebasin.schemas import RawColumn, TYPES
from pyspark.sql import types as T
from checks import marts as sqltext
from checks.expected import AGE_GROUP, age_of
from checks.registry import check
from checks.standins import given

AS_OF = "2010-06-30"


# -- projections and types ------------------------------------------------------

_CUSTOMER = (
    RawColumn("C_CUSTKEY", "patient_id", "string"),
    RawColumn("c_name", "full_name", "string"),
    RawColumn("c_mktsegment", "segment", "string"),
    RawColumn("absent", "never", "string"),
)


@check("""
    SELECT c_custkey AS patient_id, c_name AS full_name, c_nationkey, c_acctbal,
      c_mktsegment AS segment FROM customer
""")
def rename_columns(spark, sf_dir):
    return conform.rename_columns(given(spark, sf_dir, "customer"), _CUSTOMER)


_ORDER = (
    RawColumn("o_orderdate", "o_orderdate", "date"),
    RawColumn("o_totalprice", "o_totalprice", "amount"),
    RawColumn("o_custkey", "o_custkey", "int"),
    RawColumn("is_open", "is_open", "flag"),
)


@check("""
    SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
      strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
      o_totalprice, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_open
    FROM orders
""")
def cast_types(spark, sf_dir):
    text = given(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate"),
        F.col("o_totalprice").cast("decimal(14,2)").cast("string").alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "O", "1").otherwise("0").alias("is_open"),
    )
    return conform.cast_columns(text, _ORDER)


@check("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS compact,
      strftime(o_orderdate, '%Y-%m-%d') AS dashed,
      strftime(o_orderdate - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS moment
    FROM orders
""")
def parse_dates(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    text = F.when(F.col("o_orderkey") % 3 == 1, day).when(F.col("o_orderkey") % 3 == 2, day)
    return given(spark, sf_dir, "orders").select(
        "o_orderkey",
        fx.text_to_day(text.otherwise(F.concat(F.lit("x"), day))).alias("compact"),
        fx.text_to_day(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("dashed"),
        fx.text_to_moment(
            F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30"))
        ).alias("moment"),
    )


@check("""
    SELECT l_orderkey, l_linenumber,
      CASE l_returnflag WHEN 'A' THEN 'Assigned' WHEN 'N' THEN 'Non-assigned' ELSE 'Unknown' END
        AS claim_status,
      CASE l_linenumber WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS gender_label,
      CASE l_linenumber WHEN 1 THEN 'White' WHEN 2 THEN 'Black' WHEN 3 THEN 'Other'
        WHEN 4 THEN 'Asian' WHEN 5 THEN 'Hispanic' WHEN 6 THEN 'North American Native'
        ELSE 'Unknown' END AS race_label
    FROM lineitem
""")
def decode_codes(spark, sf_dir):
    coded = given(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("claim_status_code"),
        F.col("l_linenumber").alias("gender_code"),
        F.col("l_linenumber").alias("race_code"),
    )
    return (
        coded.transform(claims.decode_claim_status)
        .transform(people.decode_gender)
        .transform(people.decode_race)
        .drop("claim_status_code", "gender_code", "race_code")
    )


@check("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_payment_missing,
      CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS payment_amount
    FROM orders
""")
def null_flags_fill(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", fx.to_money(F.col("o_totalprice")))
        .alias("payment_amount"),
    )
    return money.fill_missing_amounts(orders, ["payment_amount", "total_cost"])


@check("""
    WITH stacked AS (
      SELECT 'orders' AS claim_type, o_orderkey AS claim_id, o_totalprice AS payment_amount,
        o_orderpriority AS drg_code, NULL AS submitted_amount FROM orders UNION ALL
      SELECT 'lines', l_orderkey, l_extendedprice, NULL, l_tax FROM lineitem)
    SELECT * FROM stacked
""")
def union_missing_columns(spark, sf_dir):
    first = given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_totalprice").alias("payment_amount"),
        F.col("o_orderpriority").alias("drg_code"),
    )
    second = given(spark, sf_dir, "lineitem").select(
        F.col("l_tax").alias("submitted_amount"), F.col("l_orderkey").alias("claim_id"),
        F.col("l_extendedprice").alias("payment_amount"),
    )
    return conform.stack(
        conform.tag(first, claim_type="orders"), conform.tag(second, claim_type="lines")
    )


_TARGET = T.StructType(
    [
        T.StructField("o_orderkey", TYPES["string"]),
        T.StructField("o_totalprice", TYPES["money"]),
        T.StructField("o_custkey", TYPES["int"]),
        T.StructField("note", TYPES["string"]),
    ]
)


@check("""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice,
      CAST(o_custkey AS INTEGER) AS o_custkey, CAST(NULL AS VARCHAR) AS note FROM orders
""")
def align_by_name(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    return conform.align_by_name(orders.toDF(*[c.upper() for c in orders.columns]), _TARGET)


# -- keys, duplicates, masking -----------------------------------------------------


@check("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_quantity DESC, l_partkey, l_extendedprice) AS rn FROM lineitem) z
    WHERE rn = 1
""")
def dedup_business_key(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return one_per_key(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_quantity")])


@check("SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS patient_key FROM customer")
def surrogate_key(spark, sf_dir):
    return people.add_key(
        given(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "patient_key"
    )


@check("""
    SELECT c_custkey, sha256(c_name) AS c_name,
      CASE WHEN c_acctbal >= 0 THEN sha256(c_mktsegment) END AS c_mktsegment, c_nationkey
    FROM customer
""")
def mask_columns(spark, sf_dir):
    customers = given(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    return people.mask_columns(customers, ["c_name", "c_mktsegment", "absent"])


# -- dates and durations --------------------------------------------------------------


@check("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
      CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
      CAST(month(o_orderdate) AS INTEGER) AS month,
      CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year,
      CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key
    FROM orders
""")
def date_parts(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return claims.add_date_parts(orders, "o_orderdate").drop("o_orderdate")


_AGED = age_of("birth").replace("2024-06-30", AS_OF)


@check(f"""
    SELECT o_orderkey, age, {AGE_GROUP} AS age_group FROM (
      SELECT o_orderkey, {_AGED} AS age FROM (
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
          THEN CAST(o_orderdate AS DATE) - CAST(o_orderkey % 90 * 365 AS INTEGER) END AS birth
        FROM orders) a) b
""")
def age_bands(spark, sf_dir):
    day = F.date_sub("o_orderdate", (F.col("o_orderkey") % 90 * 365).cast("int"))
    people_ = given(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", day).alias("birth_date")
    )
    return people.add_age(people_, as_of=F.to_date(F.lit(AS_OF))).drop("birth_date")


@check("""
    SELECT l_orderkey, l_linenumber,
      CAST(date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS INTEGER) AS length_of_stay
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def length_of_stay(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("admit_date")
    )
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("discharge_date")
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return claims.add_length_of_stay(joined).drop("admit_date", "discharge_date", "o_orderkey")


@check("""
    SELECT event_id, (floor(epoch(ts)) - epoch(date_trunc('day', ts))) / 3600 AS hours FROM events
""")
def duration_hours(spark, sf_dir):
    return given(spark, sf_dir, "events").select(
        "event_id", fx.hours_between(F.to_date("ts").cast("timestamp"), F.col("ts")).alias("hours")
    )


# -- amounts and thresholds -------------------------------------------------------------

_CLEANED = """
    WITH cut AS (SELECT quantile_disc(CAST(c_acctbal AS DECIMAL(12,2)), 0.99) AS t FROM customer)
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
      CAST(c_acctbal < 0 AS INTEGER) AS is_negative_c_acctbal,
      CAST(greatest(c_acctbal, 0) > (SELECT t FROM cut) AS INTEGER) AS is_high_cost
    FROM customer
"""


def _balances(spark, sf_dir):
    return given(spark, sf_dir, "customer").select("c_custkey", fx.to_money(F.col("c_acctbal")).alias("c_acctbal"))


@check(_CLEANED)
def clean_amounts(spark, sf_dir):
    return money.clean_amounts(_balances(spark, sf_dir), ["c_acctbal"])


@check("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
      CAST(c_acctbal < 0 AS INTEGER) AS is_negative_c_acctbal, 1 AS within_error FROM customer
""")
def clean_amounts_approximate(spark, sf_dir):
    """With the sketch, the share of flagged rows lies within its rank error."""
    cleaned = money.clean_amounts(_balances(spark, sf_dir), ["c_acctbal"], method="approx")
    shares = cleaned.agg(
        F.avg(F.col("is_high_cost").cast("double")).alias("flagged"), F.count(F.lit(1)).alias("n")
    )
    close = F.abs(F.col("flagged") - 0.01) <= 1 / 10_000 + 2 / F.col("n")
    within = shares.select(close.cast("int").alias("within_error"))
    return cleaned.drop("is_high_cost").crossJoin(F.broadcast(within))  # one row


@check("SELECT quantile_disc(l_extendedprice, 0.99) AS threshold FROM lineitem")
def exact_p99(spark, sf_dir):
    prices = given(spark, sf_dir, "lineitem").select(
        fx.to_money(F.col("l_extendedprice")).alias("price")
    )
    return exact_quantile(prices, "price", 0.99)


@check("SELECT 1 AS within_error, count(*) AS n FROM lineitem")
def approximate_p99(spark, sf_dir):
    """The rank of the approximate value lies within the error."""
    prices = given(spark, sf_dir, "lineitem").select("l_extendedprice")
    threshold = approximate_quantile(prices, "l_extendedprice", 0.99).scalar()
    ranks = prices.agg(
        F.avg((F.col("l_extendedprice") < threshold).cast("double")).alias("below"),
        F.avg((F.col("l_extendedprice") <= threshold).cast("double")).alias("reached"),
        F.count(F.lit(1)).alias("n"),
    )
    error = 1 / 10_000 + 1 / F.col("n")
    close = (F.col("below") - error <= 0.99) & (F.col("reached") + error >= 0.99)
    return ranks.select(close.cast("int").alias("within_error"), "n")


@check("""
    SELECT quantile_disc(k, 0.01) AS low, quantile_disc(k, 0.99) AS high
    FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN -9223372036854775808 WHEN 1 THEN 9223372036854775807
      ELSE o_orderkey END AS k FROM orders)
""")
def exact_quantile_of_any_bigint(spark, sf_dir):
    part = F.col("o_orderkey") % 3
    ends = F.when(part == 0, F.lit(-(2**63))).when(part == 1, F.lit(2**63 - 1)).otherwise(F.col("o_orderkey"))
    keys = given(spark, sf_dir, "orders").select(ends.alias("k"))
    return spark.range(1).select(
        exact_quantile(keys, "k", 0.01).scalar().alias("low"), exact_quantile(keys, "k", 0.99).scalar().alias("high")
    )


@check("""
    SELECT o_orderpriority, kind, CASE kind WHEN 'plain' THEN round(total, 7) ELSE total END AS total,
      CASE kind WHEN 'plain' THEN round(mean, 7) ELSE mean END AS mean, n FROM (
      SELECT o_orderpriority, kind, count(*) AS n,
        CASE WHEN kind IN ('tiny', 'plain') THEN CAST(sum(CAST(CASE kind WHEN 'tiny' THEN 0.0000004
          ELSE o_totalprice END AS DECIMAL(38,7))) AS DOUBLE) ELSE sum(v) END AS total,
        CASE kind WHEN 'tiny' THEN 0.0000004::DOUBLE WHEN 'plain' THEN
          CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) ELSE avg(v) END AS mean
      FROM (SELECT *, CASE kind WHEN 'nan' THEN 'NaN'::DOUBLE WHEN 'infinite' THEN 'Infinity'::DOUBLE
          WHEN 'huge' THEN 1e18::DOUBLE WHEN 'tiny' THEN 0.0000004::DOUBLE ELSE o_totalprice END AS v
        FROM (SELECT *, ['nan', 'infinite', 'huge', 'tiny', 'plain'][o_custkey % 5 + 1] AS kind FROM orders))
      GROUP BY 1, 2)
""")
def sums_of_any_doubles(spark, sf_dir):
    """Totals and means keep NaN, infinite, very large and very small values."""
    kinds = ["nan", "infinite", "huge", "tiny", "plain"]
    values = [F.lit(float("nan")), F.lit(float("inf")), F.lit(1e18), F.lit(4e-7), F.col("o_totalprice")]
    at = (F.col("o_custkey") % 5).cast("int")
    orders = given(spark, sf_dir, "orders").select(
        "o_orderpriority", F.get(F.array(*map(F.lit, kinds)), at).alias("kind"), F.get(F.array(*values), at).alias("v")
    )
    return orders.groupBy("o_orderpriority", "kind").agg(
        fx.double_total(F.col("v"), 7).alias("total"), fx.double_mean(F.col("v"), 7).alias("mean"),
        F.count(F.lit(1)).alias("n"),
    )


@check("""
    SELECT o_orderstatus, count(*) FILTER (WHERE o_custkey % 5 = 0) + count(*) FILTER (WHERE o_custkey % 7 = 0) AS lost,
      count(*) FILTER (WHERE o_custkey % 5 <> 0) AS whole FROM orders GROUP BY 1
""")
def unfit_values(spark, sf_dir):
    """Values that a load makes NULL are counted."""
    custkey = F.col("o_custkey")
    arrived = given(spark, sf_dir, "orders").select(
        "o_orderstatus", F.concat(custkey, F.when(custkey % 5 == 0, "x").otherwise("")).alias("WHOLE"),
        F.when(custkey % 7 == 0, F.lit(12345678901.0)).otherwise(F.lit(1.5)).alias("amount"),
    )
    target = T.StructType.fromDDL("o_orderstatus string, whole int, amount decimal(12,2)")
    lost = arrived.select("o_orderstatus", conform.unfit_values(arrived, target).alias("n"))
    loaded = conform.align_by_name(arrived, target).groupBy("o_orderstatus").agg(F.count("whole").alias("whole"))
    return lost.groupBy("o_orderstatus").agg(F.sum("n").cast("long").alias("lost")).join(loaded, "o_orderstatus")


@check("""
    SELECT o_orderkey, CAST(trunc(date_diff('day', CAST(o_orderdate AS DATE), CAST(now() AT TIME ZONE 'UTC' AS DATE))
      / CAST(365.25 AS DOUBLE)) AS INTEGER) AS age FROM orders
""")
def age_today(spark, sf_dir):
    """Without a date, ages count up to the current one."""
    return given(spark, sf_dir, "orders").select("o_orderkey", fx.age_in_years(F.to_date("o_orderdate")).alias("age"))


# -- scores and flags ---------------------------------------------------------------------

_RISKS = {
    "r1": "p_size > 10", "r2": "p_size > 20", "r3": "p_size > 40", "r4": "p_retailprice > 930",
    "r5": "p_retailprice > 960", "r6": "p_partkey % 2 = 0", "r7": "p_partkey % 3 = 0",
    "r8": "p_type = 'ECONOMY'", "r9": "p_brand = 'Brand#1'",
}


@check(f"""
    SELECT p_partkey, score AS risk_score,
      CASE WHEN score <= 2 THEN 'Low' WHEN score <= 5 THEN 'Medium' ELSE 'High' END AS risk_tier,
      CAST(score >= 3 AS INTEGER) AS is_chronic
    FROM (SELECT p_partkey, {' + '.join(f'CAST({r} AS INTEGER)' for r in _RISKS.values())} AS score
          FROM part) s
""")
def risk_score_tier(spark, sf_dir):
    parts = given(spark, sf_dir, "part").select(
        "p_partkey", *[F.expr(rule).alias(name) for name, rule in _RISKS.items()]
    )
    return people.add_risk(parts, list(_RISKS)).drop(*_RISKS)


@check("""
    SELECT event_id, CAST(event_type IN ('H', 'L') AS INTEGER) AS plain,
      CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 1 ELSE 0 END AS is_abnormal
    FROM events
""")
def flag_membership(spark, sf_dir):
    code = F.when(F.col("event_type") == "error", "H").when(F.col("event_type") == "view", "L")
    events = given(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").isin("H", "L").alias("plain"),
        code.alias("interpretation_code"),
    )
    return clinical.flag_abnormal(events).drop("interpretation_code")


@check("""
    SELECT p_partkey, CASE WHEN p_size > 5 THEN
      CAST(lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%bolt%' AS INTEGER) END AS hit
    FROM part
""")
def flag_keywords(spark, sf_dir):
    name = F.when(F.col("p_size") > 5, F.upper("p_name"))
    return given(spark, sf_dir, "part").select(
        "p_partkey", fx.mentions_any(name, ["ring", "bolt"]).alias("hit")
    )


# -- joins and nested text ------------------------------------------------------------------


@check("""
    SELECT c_custkey, c_nationkey, n_name AS nation, n_regionkey AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def enrich_lookup(spark, sf_dir):
    customers = given(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    names = {"n_name": "nation", "n_regionkey": "region"}
    return clinical.enrich(
        customers, "c_nationkey", given(spark, sf_dir, "nation"), "n_nationkey", names
    )


@check("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark, sf_dir):
    return given(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k")
    )


@check("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_struct(spark, sf_dir):
    parsed = F.from_json("props", "k int, absent string")
    return given(spark, sf_dir, "events").select("event_id", parsed.getField("k").alias("k"))


@check("""
    SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', 2)
      AS second_word, CAST(NULL AS VARCHAR) AS ninth_word FROM part
""")
def array_positions(spark, sf_dir):
    words = F.split("p_name", " ")
    return given(spark, sf_dir, "part").select(
        "p_partkey", F.get(words, F.lit(0)).alias("first_word"),
        F.get(words, F.lit(1)).alias("second_word"), F.get(words, F.lit(8)).alias("ninth_word"),
    )


# -- summaries of the given tables ---------------------------------------------------------------


@check(f"""
    SELECT c_custkey, c_mktsegment, n, spend, CAST((2 * cents + n) // (2 * n) AS DOUBLE) / 100 AS mean
    FROM (SELECT c_custkey, c_mktsegment, count(*) AS n, {sqltext.total('o_totalprice')} AS spend,
            sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
          FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2) g
    ORDER BY spend DESC, c_custkey LIMIT 20
""")
def high_cost_customers(spark, sf_dir):
    """The highest spenders among customers: sum orders first, then join."""
    price = fx.to_money(F.col("o_totalprice"))
    spend = given(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), fx.total(price).alias("spend"), fx.mean(price).alias("mean")
    )
    customers = given(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = customers.join(spend, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")
    return joined.orderBy(F.desc_nulls_last("spend"), "c_custkey").limit(20)


@check("""
    SELECT c_mktsegment, n_name, count(*) AS n FROM customer
    JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
""")
def cross_breakdown(spark, sf_dir):
    nations = given(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = given(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy("c_mktsegment", "n_name").agg(F.count(F.lit(1)).alias("n"))


@check(f"""
    SELECT p_brand, count(*) AS n, {sqltext.mean('l_quantity', 1, 0)} AS mean_quantity,
      {sqltext.total('l_extendedprice')} AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10
""")
def top_parts(spark, sf_dir):
    parts = given(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = given(spark, sf_dir, "lineitem").join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    grouped = joined.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"),
        fx.mean(F.col("l_quantity").cast("int"), 1).alias("mean_quantity"),
        fx.total(fx.to_money(F.col("l_extendedprice"))).alias("revenue"),
    )
    return grouped.orderBy(F.desc("n"), "p_brand").limit(10)


@check(f"""
    SELECT user_id, count(*) AS n, {sqltext.share("event_type = 'error'")} AS error_pct,
      count(DISTINCT event_type) AS kinds, count(DISTINCT props) AS settings
    FROM events GROUP BY 1 HAVING count(*) > 5
""")
def abnormal_rate(spark, sf_dir):
    grouped = given(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        fx.share(F.col("event_type") == "error").alias("error_pct"),
        F.countDistinct("event_type").alias("kinds"),
        F.countDistinct("props").alias("settings"),
    )
    return grouped.where(F.col("n") > 5)


_ALL = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@check(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL
))
def given_row_counts(spark, sf_dir):
    return row_counts({t: given(spark, sf_dir, t) for t in _ALL})


@check("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def sample_first_rows(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy("o_orderkey").limit(5)


@check("""
    SELECT 'status' AS column_name, count(*) FILTER (WHERE o_orderstatus = 'P') * 100.0::DOUBLE
      / count(*) AS null_pct FROM orders
    UNION ALL SELECT 'priority', count(*) FILTER (WHERE o_orderpriority = '5-LOW') * 100.0::DOUBLE
      / count(*) FROM orders
""")
def null_profile_of_orders(spark, sf_dir):
    return null_profile(
        given(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.nullif("o_orderstatus", F.lit("P")).alias("status"),
            F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        )
    )
