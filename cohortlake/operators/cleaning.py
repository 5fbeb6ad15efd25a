"""Raw exports to typed rows: one projection per source, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, lookups, numbers, text
from ..schemas import RAW_EOD, RAW_LMS, SEQ

HOURS_LOW, HOURS_HIGH = 0.5, 4.0


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns an export leaves out as typed nulls, so the output schema never varies."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _carried(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(n) for n in names if n in df.columns]


def hours_column(df: DataFrame, name: str = "Hours") -> Column:
    """Hours as double; a column that is numeric already needs no text parsing."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return numbers.finite(_col(name).cast("double"))
    return numbers.parse_number(_col(name))


def clean_eod(
    raw: DataFrame, low: float = HOURS_LOW, high: float = HOURS_HIGH
) -> DataFrame:
    df = with_columns_of(raw, RAW_EOD)
    first, last = _col("First Name"), _col("Last Name")
    full = text.joined_name(first, last)
    hours = hours_column(df)
    return df.select(
        text.short_id(full).alias("intern_id"),
        full.alias("full_name"),
        text.strip(first).alias("first_name"),
        text.strip(last).alias("last_name"),
        dates.parse_eod_date(_col("Date")).alias("date"),
        text.non_blank(_col("Activity")).alias("activity"),
        hours.alias("hours"),
        numbers.outlier_flag(hours, low, high).alias("hours_outlier_flag"),
        *_carried(df, SEQ),
    )


# Fraction column of the export, and the names of its three parts.
FRACTIONS = {
    "Completed Assignment": ("completed_count", "total_assignments", "assignment_ratio"),
    "Overall Knowledge Check": ("kc_score", "kc_max", "kc_pct"),
    "Overall Test": ("test_score", "test_max", "test_pct"),
    "Reviewed / Submitted": ("reviewed", "submitted", "reviewed_pct"),
}


def _with_fractions(df: DataFrame) -> DataFrame:
    """Append the three parts of every fraction column.

    Each step is a projection of its own: later steps use the values of earlier ones
    twice or more, and generated code per projection stays small enough to be compiled.
    """
    stripped = {f"_s{i}": text.strip(_col(c)) for i, c in enumerate(FRACTIONS)}
    halves, numerals, ratios = {}, {}, {}
    for i, (num, den, ratio) in enumerate(FRACTIONS.values()):
        s, top, bottom = F.col(f"_s{i}"), F.col(f"_t{i}"), F.col(f"_b{i}")
        halves[f"_t{i}"] = F.regexp_extract(s, numbers.FRACTION, 1)
        halves[f"_b{i}"] = F.regexp_extract(s, numbers.FRACTION, 2)
        numerals[num] = numbers.fraction_number(s, top)
        numerals[den] = bottom.try_cast("double")
        ratios[ratio] = numbers.fraction_ratio(F.col(num), F.col(den))
    return (
        df.withColumns(stripped)
        .withColumns(halves)
        .withColumns(numerals)
        .withColumns(ratios)
        .drop(*stripped, *halves)
    )


def clean_lms(raw: DataFrame, course_name_override: str | None = None) -> DataFrame:
    """All courses in one frame; ``course_key``, where present, picks the registered name."""
    df = with_columns_of(raw, RAW_LMS)
    user, source_course = _col("User Name"), _col("Course Name")
    if course_name_override is not None:
        course = F.lit(course_name_override)
    elif "course_key" in df.columns:
        course = lookups.course_name(F.col("course_key"), source_course)
    else:
        course = text.strip(source_course)
    df = _with_fractions(df)
    parts = [F.col(name) for names in FRACTIONS.values() for name in names]
    return df.select(
        text.short_id(user).alias("intern_id"),
        text.strip(user).alias("full_name"),
        course.alias("course_name"),
        dates.parse_course_date(_col("Start Date")).alias("start_date"),
        dates.parse_course_date(_col("End Date")).alias("end_date"),
        numbers.parse_percent(_col("Progress (%)")).alias("progress_pct"),
        *parts,
        lookups.status(_col("Overall Status")).alias("overall_status"),
        text.strip(_col("Mentor Name")).alias("mentor_name_raw"),
        *_carried(df, "course_key", SEQ),
    )


def explode_mentors(lms: DataFrame) -> DataFrame:
    """One row per person, course and mentor.

    Repeated rows are dropped before the list is split as well as after it, so copies
    of one row are combined in the map tasks and never meet in one reducer.
    """
    keys = [c for c in ("intern_id", "course_name", "course_key") if c in lms.columns]
    return (
        lms.select(*keys, "mentor_name_raw")
        .filter(F.col("mentor_name_raw").isNotNull())
        .distinct()
        .select(*keys, F.explode(F.split("mentor_name_raw", ",")).alias("mentor_name"))
        .withColumn("mentor_name", text.non_blank(F.col("mentor_name")))
        .filter(F.col("mentor_name").isNotNull())
        .distinct()
    )
