"""Silver star schema from cleaned rows.

Surrogate keys are pure functions of the text they stand for, so facts and bridge
compute them in place; no fact row is shuffled to look a key up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, lookups, text
from ..operators.dense_id import with_dense_id
from ..schemas import COLUMNS, SEQ

NAME = ["full_name", "first_name", "last_name"]


def _named(df: DataFrame) -> DataFrame:
    return df.filter(text.strip(F.col("full_name")) != "")


def eod_names(eod: DataFrame, *by: str) -> DataFrame:
    """Ways a person is written in the daily logs, with the first row of each; ``source`` and ``course_rank`` put them first."""
    first = _named(eod).groupBy("intern_id", *NAME, *by).agg(F.min(SEQ).alias(SEQ))
    return first.select("intern_id", F.lit(0).alias("source"), F.lit(0).alias("course_rank"), SEQ, *NAME, *by)


def lms_names(lms: DataFrame, *by: str) -> DataFrame:
    """The same for progress exports, with the first row of each course."""
    rank = lookups.course_rank(F.col("course_key")).cast("int")
    first = _named(lms).groupBy("intern_id", rank.alias("course_rank"), "full_name", *by).agg(F.min(SEQ).alias(SEQ))
    name = F.col("full_name")
    return first.select(
        "intern_id", F.lit(1).alias("source"), "course_rank", SEQ,
        "full_name", text.first_name(name).alias("first_name"), text.last_name(name).alias("last_name"), *by,
    )


def best_names(names: DataFrame) -> DataFrame:
    """One row per person; daily logs win over progress exports, then the first row wins."""
    best = F.min(F.struct("source", "course_rank", SEQ, *NAME)).alias("best")
    return names.groupBy("intern_id").agg(best).select("intern_id", *[F.col("best")[c].alias(c) for c in NAME])


def dim_intern(eod: DataFrame, lms: DataFrame) -> DataFrame:
    return best_names(eod_names(eod).unionByName(lms_names(lms)))


def course_variants(lms: DataFrame) -> DataFrame:
    """Names of a course as they are written, with the first row, earliest start and latest end of each."""
    return lms.groupBy("course_key", "course_name").agg(
        F.min(SEQ).alias(SEQ), F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")
    )


def dim_course(lms: DataFrame) -> DataFrame:
    """One row per course key: its first name, earliest start, latest end."""
    return (
        course_variants(lms).groupBy("course_key")
        .agg(
            F.min_by("course_name", SEQ).alias("course_name"),
            F.min("start_date").alias("start_date"),
            F.max("end_date").alias("end_date"),
        )
        .withColumn("course_id", text.short_id(F.col("course_name")))
        .select(*COLUMNS["dim_course"])
    )


def dim_mentor(mentors: DataFrame) -> DataFrame:
    """One row per mentor id; of names that differ in case only, the least is kept."""
    return (
        mentors.select("mentor_name")
        .distinct()
        .groupBy(text.short_id(F.col("mentor_name")).alias("mentor_id"))
        .agg(F.min("mentor_name").alias("mentor_name"))
    )


def dim_activity(eod: DataFrame) -> DataFrame:
    """One row per activity id; of names that differ in case only, one with a category is kept."""
    names = (
        eod.select(F.col("activity").alias("activity_name"))
        .filter(F.col("activity_name").isNotNull())
        .distinct()
        .withColumn("activity_category", lookups.activity_category(F.col("activity_name")))
    )
    ranked = F.struct(
        (F.col("activity_category") == lookups.OTHER_CATEGORY).alias("other"),
        "activity_name",
        "activity_category",
    )
    return (
        names.groupBy(text.short_id(F.col("activity_name")).alias("activity_id"))
        .agg(F.min(ranked).alias("best"))
        .select("activity_id", "best.activity_name", "best.activity_category")
    )


def dim_date(eod: DataFrame) -> DataFrame:
    d = F.col("date")
    return eod.select("date").filter(d.isNotNull()).distinct().select(
        "date",
        dates.day_name(d).alias("day_of_week"),
        dates.iso_week(d).alias("week_number"),
        dates.month(d).alias("month"),
        dates.month_name(d).alias("month_name"),
        dates.year(d).alias("year"),
    )


def _course_ids(courses: DataFrame) -> DataFrame:
    # Bounded: course_key is a literal attached per registered source, one row per key.
    return courses.select("course_key", "course_id")


def bridge_intern_mentor(mentors: DataFrame, courses: DataFrame) -> DataFrame:
    return (
        mentors.join(_course_ids(courses), "course_key", "left")
        .select("intern_id", "course_id", text.short_id(F.col("mentor_name")).alias("mentor_id"))
        .distinct()
    )


def eod_facts(eod: DataFrame) -> DataFrame:
    """Fact rows without the dense id, which only the stored table needs."""
    return eod.select(
        "intern_id",
        "date",
        F.when(F.col("activity").isNotNull(), text.short_id(F.col("activity"))).alias("activity_id"),
        "hours",
        "hours_outlier_flag",
        SEQ,
    )


def lms_facts(lms: DataFrame, courses: DataFrame) -> DataFrame:
    measures = COLUMNS["fact_lms_progress"][3:]
    return lms.join(_course_ids(courses), "course_key", "left").select(
        "intern_id",
        "course_id",
        *measures,
        lookups.course_rank(F.col("course_key")).alias("course_rank"),
        SEQ,
    )


def fact_eod_log(eod: DataFrame) -> DataFrame:
    return with_dense_id(eod_facts(eod), [SEQ], "log_id").select(*COLUMNS["fact_eod_log"])


def fact_lms_progress(lms: DataFrame, courses: DataFrame) -> DataFrame:
    return with_dense_id(
        lms_facts(lms, courses), ["course_rank", SEQ], "progress_id"
    ).select(*COLUMNS["fact_lms_progress"])


# How each table follows from the cleaned rows and the tables before it.
BUILDERS = {
    "dim_intern": lambda t: dim_intern(t["eod_clean"], t["lms_clean"]),
    "dim_course": lambda t: dim_course(t["lms_clean"]),
    "dim_mentor": lambda t: dim_mentor(t["mentors"]),
    "dim_activity": lambda t: dim_activity(t["eod_clean"]),
    "dim_date": lambda t: dim_date(t["eod_clean"]),
    "bridge_intern_mentor": lambda t: bridge_intern_mentor(t["mentors"], t["dim_course"]),
    "fact_eod_log": lambda t: eod_facts(t["eod_clean"]),
    "fact_lms_progress": lambda t: lms_facts(t["lms_clean"], t["dim_course"]),
}
DENSE_BUILDERS = {
    **BUILDERS,
    "fact_eod_log": lambda t: fact_eod_log(t["eod_clean"]),
    "fact_lms_progress": lambda t: fact_lms_progress(t["lms_clean"], t["dim_course"]),
}
