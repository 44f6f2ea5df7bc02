"""Reusable column expressions: lenient casts, exact money, percentages, calendar, labels.

Money and quantities are DOUBLE columns that keep the digits they were read with.  Sums are taken in
DECIMAL(38,8): exact to eight digits, independent of the order in which partitions arrive, and with
room for 1e30 per group.  Rounding happens in output columns that are defined as rounded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits that sums keep.
DIGITS = 8

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- lenient casts (ANSI mode would fail the job on one bad value) -----------------------------


def money(c: ColumnLike) -> Column:
    """An amount, as it was read."""
    return number(c)


def quantity(c: ColumnLike) -> Column:
    """A quantity, as it was read."""
    return number(c)


def settled(c: ColumnLike) -> Column:
    """A computed amount without the noise of double arithmetic behind the eighth digit."""
    value, scale = dbl(c), float(10**DIGITS)
    # Larger numbers have no eighth digit that a double could hold.
    small = F.abs(value) < 2.0**53 / scale
    return F.when(small, F.rint(value * scale) / scale).otherwise(value)


def difference(a: ColumnLike, b: ColumnLike) -> Column:
    """Exact difference of two amounts."""
    return from_units(units(a) - units(b))


def number(c: ColumnLike) -> Column:
    return as_col(c).try_cast("double")


def whole(c: ColumnLike) -> Column:
    return as_col(c).try_cast("int")


def day(c: ColumnLike) -> Column:
    return as_col(c).try_cast("date")


def flag(c: ColumnLike) -> Column:
    return as_col(c).try_cast("boolean")


# ---- text --------------------------------------------------------------------------------------


def text(c: ColumnLike) -> Column:
    return F.trim(as_col(c))


def code(c: ColumnLike) -> Column:
    return F.upper(F.trim(as_col(c)))


# ---- ratios ------------------------------------------------------------------------------------


def dbl(c: ColumnLike) -> Column:
    return as_col(c).cast("double")


def safe_div(num: ColumnLike, den: ColumnLike) -> Column:
    """num / den in DOUBLE; NULL when the denominator is zero."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def ratio(num: ColumnLike, den: ColumnLike, digits: int, scale: int = 1) -> Column:
    """Rounded num / den (times ``scale``); NULL when the denominator is zero."""
    quotient = safe_div(num, den)
    return F.round(quotient * scale if scale != 1 else quotient, digits)


def percent_or_zero(num: ColumnLike, den: ColumnLike) -> Column:
    """Percentage with two digits, and 0.0 when the denominator is not positive or unknown."""
    return F.when(
        as_col(den) > 0, F.round(dbl(num) / dbl(den) * 100, 2)
    ).otherwise(F.lit(0.0))


def divide_or_zero(num: ColumnLike, den: ColumnLike) -> Column:
    return F.coalesce(safe_div(num, den), F.lit(0.0))


# ---- aggregates --------------------------------------------------------------------------------


def units(c: ColumnLike) -> Column:
    """A number that adds up exactly."""
    return dbl(c).cast(f"decimal(38,{DIGITS})")


def from_units(c: ColumnLike) -> Column:
    return dbl(c)


def exact_sum(c: ColumnLike) -> Column:
    return from_units(F.sum(units(c)))


def exact_mean(c: ColumnLike) -> Column:
    """Mean as exact sum over count: the same value for every partitioning and every retry."""
    return F.try_divide(exact_sum(c), F.count(as_col(c)).cast("double"))


def try_mean(c: ColumnLike) -> Column:
    """Mean of a ratio column."""
    return exact_mean(c)


def mean_days(c: ColumnLike) -> Column:
    """Mean of an integer column."""
    value = as_col(c)
    return F.try_divide(F.sum(value.cast("long")).cast("double"), F.count(value).cast("double"))


def sum_when(cond: Column, value: ColumnLike) -> Column:
    return exact_sum(F.when(cond, dbl(value)).otherwise(F.lit(0.0)))


# ---- dates -------------------------------------------------------------------------------------


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The job's "today".  Passing it in makes a run repeatable; None means the current date."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def year_month(c: ColumnLike) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def with_calendar(
    df: DataFrame, date_col: str, calendar: tuple[str, str] | None, parts: Sequence[str]
) -> DataFrame:
    """Calendar attributes of a date column.

    The attributes are functions of the date, so computing them in place saves the join with
    ``dim_date``, and every row keeps its place: a row without a date gets NULL attributes.  A
    caller may give a range; then only dates inside it count, and the range reaches the scan.
    """
    c = F.col(date_col)
    builders = {"year": F.year(c), "quarter": F.quarter(c), "year_month": year_month(c)}
    if calendar is not None:
        first, last = (F.lit(d).cast("date") for d in calendar)
        df = df.filter(c.between(first, last))
    return df.select("*", *[builders[p].alias(p) for p in parts])


# ---- labels ------------------------------------------------------------------------------------

# ISO codes of the regions, and the country names that occur in the source feeds.
REGION_COUNTRIES: dict[str, tuple[str, ...]] = {
    "NORTH AMERICA": ("US", "CA", "MX", "USA", "UNITED STATES", "CANADA", "MEXICO"),
    "EUROPE": (
        "GB", "DE", "FR", "IT", "ES", "NL", "NO", "SE",
        "UK", "UNITED KINGDOM", "GERMANY", "FRANCE", "ITALY", "SPAIN", "NETHERLANDS", "NORWAY",
        "SWEDEN",
    ),
    "MIDDLE EAST": (
        "AE", "SA", "QA", "KW", "OM", "BH",
        "UAE", "UNITED ARAB EMIRATES", "SAUDI ARABIA", "QATAR", "KUWAIT", "OMAN", "BAHRAIN",
    ),
    "ASIA PACIFIC": (
        "AU", "NZ", "SG", "MY", "IN", "JP", "KR", "CN",
        "AUSTRALIA", "NEW ZEALAND", "SINGAPORE", "MALAYSIA", "INDIA", "JAPAN", "SOUTH KOREA",
        "CHINA",
    ),
}


def region_of(country: ColumnLike) -> Column:
    """Region of a country given as ISO code or as name."""
    c = code(country)
    label = F.lit("OTHER")
    for region, countries in reversed(REGION_COUNTRIES.items()):
        label = F.when(c.isin(*countries), F.lit(region)).otherwise(label)
    return label


def band(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches, e.g. ``[(80, 'LOW'), (60, 'MEDIUM')]``."""
    label: Column | None = None
    for bound, name in steps:
        hit = value >= F.lit(bound)
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return label.otherwise(F.lit(otherwise))
