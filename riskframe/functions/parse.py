"""Column functions that turn raw text and dates into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(c: Column) -> Column:
    """``'13.99%'`` to 13.99; other text is an error."""
    return F.replace(c, F.lit("%"), F.lit("")).cast("double")


def percent_or_null(c: Column) -> Column:
    """Like :func:`percent`, but unreadable text and NaN give null."""
    return nan_to_null(F.replace(c, F.lit("%"), F.lit("")).try_cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def first_integer(c: Column) -> Column:
    """First run of digits in the text, null when there is none."""
    return F.regexp_extract(c, r"(\d+)", 1).try_cast("int")


def employment_years(c: Column) -> Column:
    """``'10+ years'`` 10, ``'< 1 year'`` 0.5, else all digits read as one number, else null."""
    text = F.trim(F.lower(c))
    digits = F.regexp_replace(text, "[^0-9]", "")
    return (
        F.when(text.contains("10+"), F.lit(10.0))
        .when(text.contains("< 1"), F.lit(0.5))
        .when(digits != "", digits.try_cast("double"))
    )


def month_year(c: Column) -> Column:
    """``'Dec-2015'`` to the first of the month; other text is an error."""
    return F.to_date(c, "MMM-yyyy")


def month_year_or_null(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("MMM-yyyy")).cast("date")


def whole_days(later: Column, earlier: Column) -> Column:
    """Full days between two timestamps, rounded towards the past."""
    gap = later - earlier
    days = F.extract(F.lit("DAY"), gap)
    return F.when(gap < F.make_dt_interval(days), days - 1).otherwise(days).cast("int")


def thirty_day_months(end: Column, start: Column) -> Column:
    """Months of 30 days between two dates, half-even to one decimal."""
    return F.bround(F.datediff(end, start) / F.lit(30.0), 1)


def text_id(c: Column) -> Column:
    return F.trim(c.cast("string"))


def or_unknown(c: Column) -> Column:
    """Null or empty id to ``'unknown'``."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))
