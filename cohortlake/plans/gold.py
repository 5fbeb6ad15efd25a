"""Gold aggregates over the Silver tables.

Facts are aggregated by key before any join, so a person or course that owns a large
share of the rows is combined in the map tasks and joins as a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numbers import merged_parts, sum_parts, summed_parts
from ..operators.skew import join_one_per_key
from ..schemas import COLUMNS

Tables = Mapping[str, DataFrame]


#: Names of the fact rows before they are numbered, where a warehouse has them. Sums over the progress
#: facts take a row once for every course key whose name has its course id, as ``lms_people`` does.
EOD_ROWS, LMS_ROWS, LMS_KEYED_ROWS = "eod_rows", "lms_rows", "lms_keyed_rows"
LMS_SCORES = ("kc_pct", "test_pct", "assignment_ratio")


def _facts(t: Tables, name: str, rows: str) -> DataFrame:
    """Fact rows for sums and joins, which need no row numbers."""
    return t[rows] if rows in t else t[name]


def eod_groups(t: Tables, *keys: str | Column) -> DataFrame:
    """``n`` entries, ``n_hours`` with hours and exact parts of their sum, per group of the daily log.

    Keys are among person, date and activity, or made of them. Where the counts per day are stored as
    ``eod_days``, they are added up; else the facts are.
    """
    if "eod_days" in t:
        counts = [F.sum("n").alias("n"), F.sum("n_hours").alias("n_hours"), *merged_parts("h")]
        return t["eod_days"].groupBy(*keys).agg(*counts)
    counts = [F.count(F.lit(1)).alias("n"), F.count("hours").alias("n_hours"), *sum_parts("hours", "h")]
    return _facts(t, "fact_eod_log", EOD_ROWS).groupBy(*keys).agg(*counts)


def lms_groups(t: Tables, *keys: str | Column) -> DataFrame:
    """Rows, progress, states and exact parts of the scores per group of the progress facts; keys are person and course, or made of them."""
    status = F.col("overall_status")
    sums = ("lms_rows", "progress", "n_progress", "completed", "not_started", *[f"n_{c}" for c in LMS_SCORES])
    if "lms_people" in t:
        counts = [*[F.sum(c).alias(c) for c in sums], *[part for c in LMS_SCORES for part in merged_parts(c)]]
        return t["lms_people"].groupBy(*keys).agg(*counts)
    counts = [
        F.count(F.lit(1)).alias("lms_rows"), F.sum("progress_pct").alias("progress"), F.count("progress_pct").alias("n_progress"),
        F.sum((status == "Completed").cast("bigint")).alias("completed"), F.sum((status == "Not Started").cast("bigint")).alias("not_started"),
        *[F.count(c).alias(f"n_{c}") for c in LMS_SCORES], *[part for c in LMS_SCORES for part in sum_parts(c, c)],
    ]
    return _facts(t, "fact_lms_progress", LMS_KEYED_ROWS).groupBy(*keys).agg(*counts)


def _total_hours() -> Column:
    return summed_parts("h")


def _avg_hours() -> Column:
    return F.try_divide(_total_hours(), F.sum("n_hours"))


def weekly_hours(t: Tables) -> DataFrame:
    """Hours per person, calendar year, ISO week and month; undated rows drop out.

    The date dimension holds every date of the facts, and its columns are functions of
    the date, so they are computed here instead of joined on a key of few values.
    """
    day = F.col("date")
    daily = eod_groups(t, "intern_id", "date").filter(day.isNotNull())
    weekly = daily.groupBy(
        "intern_id",
        dates.year(day).alias("year"),
        dates.iso_week(day).alias("week_number"),
        dates.month_name(day).alias("month_name"),
    ).agg(
        F.sum("n").alias("activity_count"),
        _total_hours().alias("total_hours"),
        _avg_hours().alias("avg_hours_per_activity"),
        F.count(F.lit(1)).alias("active_days"),
    )
    people = t["dim_intern"].select("intern_id", "full_name")
    return weekly.join(people, "intern_id").select(*COLUMNS["gold_weekly_hours"])


def activity_summary(t: Tables) -> DataFrame:
    per_activity = (
        eod_groups(t, "intern_id", "activity_id").filter(F.col("activity_id").isNotNull())
        .groupBy("intern_id", "activity_id")
        .agg(F.sum("n").alias("activity_count"), _total_hours().alias("total_hours"), _avg_hours().alias("avg_hours"))
    )
    people = t["dim_intern"].select("intern_id", "full_name")
    named = join_one_per_key(per_activity, t["dim_activity"], "activity_id")
    return named.join(people, "intern_id").select(*COLUMNS["gold_activity_summary"])


def course_progress(t: Tables) -> DataFrame:
    """Progress facts with names: the one Gold table of fact grain."""
    people = t["dim_intern"].select("intern_id", "full_name")
    # One row per registered course.
    courses = t["dim_course"].select("course_id", "course_name")
    rows = _facts(t, "fact_lms_progress", LMS_ROWS).join(courses, "course_id")
    return join_one_per_key(rows, people, "intern_id").select(*COLUMNS["gold_course_progress"])


def eod_by_intern(t: Tables) -> DataFrame:
    return eod_groups(t, "intern_id", "activity_id").groupBy("intern_id").agg(
        _total_hours().alias("total_hours"),
        F.sum("n").alias("total_activity_entries"),
        F.count("activity_id").alias("distinct_activities"),
    )


def lms_by_intern(t: Tables) -> DataFrame:
    def mean(c: str) -> Column:
        return F.try_divide(summed_parts(c), F.sum(f"n_{c}"))

    # All that matters of a course is whether it is known.
    known = F.col("course_id").isNotNull().alias("known_course")
    return lms_groups(t, "intern_id", known).groupBy("intern_id").agg(
        F.try_divide(F.sum("progress").cast("double"), F.sum("n_progress")).alias("avg_progress_pct"),
        mean("kc_pct").alias("avg_kc_pct"),
        mean("test_pct").alias("avg_test_pct"),
        F.sum("completed").alias("courses_completed"),
        mean("assignment_ratio").alias("avg_assignment_ratio"),
        F.sum(F.when(F.col("known_course"), F.col("lms_rows")).otherwise(0)).alias("lms_rows"),
    )


def intern_performance(t: Tables) -> DataFrame:
    """One row per person. The three inputs share the partitioning by person."""
    joined = (
        t["dim_intern"].select("intern_id", "full_name")
        .join(eod_by_intern(t), "intern_id", "left")
        .join(lms_by_intern(t), "intern_id", "left")
    )
    columns = COLUMNS["gold_intern_performance"]
    return joined.select(*columns).fillna(0, subset=columns[2:])


def mentor_workload(t: Tables) -> DataFrame:
    """Mentees and their progress per mentor and course.

    Progress rows are reduced to one per person and course before they meet the bridge,
    so several rows of a person do not multiply with the person's mentors.
    """
    per_course = lms_groups(t, "intern_id", "course_id")
    per_mentor = (
        t["bridge_intern_mentor"].join(per_course, ["intern_id", "course_id"])
        .groupBy("mentor_id", "course_id")
        .agg(
            F.count(F.lit(1)).alias("intern_count"),
            F.try_divide(F.sum("progress").cast("double"), F.sum("n_progress")).alias("avg_mentee_progress"),
            F.sum("completed").alias("completed_count"),
            F.sum("not_started").alias("not_started_count"),
        )
    )
    # One row per registered course.
    courses = t["dim_course"].select("course_id", "course_name")
    return (
        per_mentor.join(courses, "course_id")
        .join(t["dim_mentor"], "mentor_id")
        .select(*COLUMNS["gold_mentor_workload"])
    )


BUILDERS = {
    "gold_weekly_hours": weekly_hours,
    "gold_activity_summary": activity_summary,
    "gold_course_progress": course_progress,
    "gold_intern_performance": intern_performance,
    "gold_mentor_workload": mentor_workload,
}
