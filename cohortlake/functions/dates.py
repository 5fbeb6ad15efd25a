"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EOD_DATE_FORMAT = "d/M/yyyy"

def parse_eod_date(c: Column) -> Column:
    """Day-first date. The guard keeps two-digit parts at most two digits wide."""
    return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, EOD_DATE_FORMAT))


def parse_course_date(c: Column) -> Column:
    """ISO date with or without a time, year/month/day, or month/day/year.

    The form is told by the separators, so each value is parsed once: a failed attempt
    costs far more than a good one.
    """
    return (
        F.when(F.substring(c, 5, 1) == "-", c.try_cast("timestamp"))
        .when(c.rlike(r"^\d{4}/"), F.try_to_timestamp(c, F.lit("yyyy/M/d")))
        .when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(c, F.lit("M/d/yyyy")))
    )


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def iso_week(d: Column) -> Column:
    return F.weekofyear(d).cast("bigint")


def month(d: Column) -> Column:
    return F.month(d).cast("bigint")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def year(d: Column) -> Column:
    """Calendar year, not the year of the ISO week: the warehouse groups by this pair."""
    return F.year(d).cast("bigint")


def week_label(year_col: Column, week_col: Column) -> Column:
    return F.concat(
        year_col.cast("string"), F.lit("-W"), F.lpad(week_col.cast("string"), 2, "0")
    )


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)
