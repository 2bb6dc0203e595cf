"""Column expressions for dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_timestamp(c: Column) -> Column:
    """Invalid text becomes NULL."""
    return c.cast("string").try_cast("timestamp")


def lenient_date(c: Column) -> Column:
    return c.cast("string").try_cast("date")


def two_format_timestamp(c: Column) -> Column:
    """With fraction and zone offset first, plain seconds second, NULL otherwise."""
    return F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSXX")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSXXX")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
    )


def year_only_date(c: Column) -> Column:
    """`"2016.0"` -> 2016-01-01."""
    year = F.regexp_extract(c, r"^(\d{4})\.0$", 1)
    return F.try_to_timestamp(F.nullif(year, F.lit("")), F.lit("yyyy")).cast("date")


def release_version(day: Column) -> Column:
    """Half-year release a download of that day carries.

    The first release of a year replaces the old one after 1 April, the second after 1 October.
    """
    month_day = F.month(day) * 100 + F.dayofmonth(day)
    year = F.year(day)
    number = F.when((month_day > 401) & (month_day <= 1001), F.lit(1)).otherwise(F.lit(2))
    release_year = F.when(month_day <= 401, year - 1).otherwise(year)
    return F.concat(F.lpad((release_year % 100).cast("string"), 2, "0"), F.lit("."), number.cast("string"))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def iso_timestamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
