"""Scalar column builders. Each returns a built-in Spark expression.

Text is parsed with the ``try_`` forms: bad input becomes NULL, while ANSI
mode stays on for everything else.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound (exclusive) and label of each age band.
AGE_BANDS = [(18, "0-17"), (35, "18-34"), (50, "35-49"), (65, "50-64")]
OLDEST_BAND = "65+"

# Upper bound (inclusive) and label of each risk tier.
RISK_TIERS = [(2, "Low"), (5, "Medium")]
TOP_TIER = "High"
CHRONIC_FROM = 3

DAYS_PER_YEAR = 365.25


# -- text to typed values ---------------------------------------------------

def text_to_day(text: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date from text; NULL, empty or impossible dates give NULL."""
    return F.try_to_date(text, pattern)


def text_to_moment(text: Column) -> Column:
    """Timestamp from ISO-8601 text, with or without offset or time part."""
    return F.try_to_timestamp(text)


def text_to_int(text: Column) -> Column:
    """Whole number from text such as ``7`` or ``7.0``; otherwise NULL."""
    return text.try_cast("double").try_cast("int")


def text_to_flag(text: Column) -> Column:
    """Boolean from 0/1 text; any other non-zero number counts as true."""
    return text_to_int(text).cast("boolean")


def to_money(amount: Column, precision: int = 12) -> Column:
    """Decimal with two places, half-up; unusable input gives NULL."""
    return amount.try_cast(f"decimal({precision},2)")


# -- codes, bands and flags ---------------------------------------------------

def decode(code: Column, labels: Mapping, default: str = "Unknown") -> Column:
    """Label of a code; NULL and unlisted codes get the default."""
    cases = reduce(lambda done, item: done.when(code == item[0], item[1]), labels.items(), F)
    return cases.otherwise(default)


def age_in_years(birth: Column, as_of: Column | None = None) -> Column:
    """Completed years, truncated; ``as_of`` defaults to the current date."""
    today = F.current_date() if as_of is None else as_of
    return (F.datediff(today, birth) / F.lit(DAYS_PER_YEAR)).cast("int")


def age_band(age: Column, null_label: str | None = None) -> Column:
    """Band label. A NULL age falls in the oldest band unless relabelled."""
    bands = reduce(lambda done, band: done.when(age < band[0], band[1]), AGE_BANDS, F)
    if null_label is not None:
        return F.when(age.isNull(), null_label).otherwise(bands.otherwise(OLDEST_BAND))
    return bands.otherwise(OLDEST_BAND)


def risk_tier(score: Column, labels: Mapping[str, str] | None = None) -> Column:
    """Tier of a risk score; a NULL score counts as the top tier."""
    name = (labels or {}).get
    tiers = reduce(
        lambda done, tier: done.when(score <= tier[0], name(tier[1], tier[1])), RISK_TIERS, F
    )
    return tiers.otherwise(name(TOP_TIER, TOP_TIER))


def count_flags(flags: Iterable[Column]) -> Column:
    """Number of true flags in the row."""
    return reduce(lambda total, flag: total + flag, (f.cast("int") for f in flags))


def mentions_any(text: Column, words: Iterable[str]) -> Column:
    """True if the text holds one of the words in any case; NULL text gives NULL."""
    lowered = F.lower(text)
    return reduce(lambda hit, word: hit | lowered.contains(word), words, F.lit(False))


# -- dates, durations and keys --------------------------------------------------

def date_parts(day: Column) -> dict[str, Column]:
    """Calendar columns of a date: calendar year, ISO week, integer date key."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
        "date_key": F.date_format(day, "yyyyMMdd").cast("int"),
    }


def hours_between(start: Column, end: Column) -> Column:
    """Hours from start to end, on whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600.0)


def sha_key(value: Column) -> Column:
    """SHA-256 hex of the value as text; NULL stays NULL."""
    return F.sha2(value.cast("string"), 256)


# -- aggregates --------------------------------------------------------------------

def total(number: Column, places: int = 2) -> Column:
    return F.round(F.sum(number), places)


def mean(number: Column, places: int = 2) -> Column:
    """Average rounded half-up once, from the exact sum and count."""
    # decimal(26,6) / bigint keeps 18 places, so rounding happens only once.
    return F.round(F.try_divide(F.sum(number).cast("decimal(26,6)"), F.count(number)), places)


def _fixed(number: Column) -> Column:
    """A double as a decimal of the same value, or NULL if there is none."""
    fixed = number.try_cast("decimal(38,18)")
    return F.when((F.abs(number) < F.lit(1e15)) & (fixed.cast("double") == number), fixed)


def _all_fixed(number: Column) -> Column:
    return F.count_if(number.isNotNull() & _fixed(number).isNull()) == 0


def double_total(number: Column, places: int = 2) -> Column:
    """Rounded sum of doubles.

    If every value of the group has an equal decimal of 18 places, the sum is
    that of the decimals and does not depend on the row order. Otherwise (NaN,
    infinities, very large or very small values) it is the sum of the doubles;
    no value is ever left out or rounded beforehand.
    """
    exact = F.round(F.try_sum(_fixed(number)), places).cast("double")
    return F.coalesce(F.when(_all_fixed(number), exact), F.round(F.sum(number), places))


def double_mean(number: Column, places: int = 2) -> Column:
    """Rounded mean of doubles, from the exact sum where ``double_total`` has one."""
    # decimal(30,10) / bigint keeps 18 places, so rounding happens only once.
    whole = F.try_sum(_fixed(number)).try_cast("decimal(30,10)")
    exact = F.round(F.try_divide(whole, F.count(number)), places).cast("double")
    return F.coalesce(F.when(_all_fixed(number), exact), F.round(F.avg(number), places))


def share(condition: Column, places: int = 1) -> Column:
    """Percentage of the group's rows that meet the condition."""
    hits = (F.count_if(condition) * F.lit(100)).cast("decimal(20,0)")
    return F.round(F.try_divide(hits, F.count(F.lit(1))), places)
