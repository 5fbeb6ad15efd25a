"""Fixed lookups: course names, activity categories, status spellings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import normalize_name, strip

# Course key to course name, in the order of loading.
COURSE_NAMES = {
    "python": "Basic Python Programming",
    "sql": "Basic SQL",
    "numpy_pandas": "Data Processing using NumPy & Pandas",
    "pyspark": "Data Processing using PySpark",
}

# Activity name to category.
ACTIVITY_CATEGORIES = {
    "PySpark Session": "PySpark",
    "NumPy Practice": "NumPy/Pandas",
    "Power BI Dashboard Work": "BI/Reporting",
    "PL/SQL Concepts": "SQL",
    "SQL Revision": "SQL",
    "Data Engineering Course": "Data Engineering",
    "Pandas Practice": "NumPy/Pandas",
    "Pandas Exam Preparation": "NumPy/Pandas",
    "PySpark LMS Learning": "PySpark",
    "Advanced SQL Practice": "SQL",
    "Spark Architecture Study": "PySpark",
    "Project Research": "Research",
}
OTHER_CATEGORY = "Other"

# Lower-case status to its spelling in the warehouse.
STATUSES = {
    "completed": "Completed",
    "in progress": "In Progress",
    "not started": "Not Started",
}
UNKNOWN_STATUS = "Unknown"


def lookup(c: Column, mapping: dict[str, str], default: Column) -> Column:
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(pairs, c), default)


def activity_category(name: Column) -> Column:
    return lookup(name, ACTIVITY_CATEGORIES, F.lit(OTHER_CATEGORY))


def status(c: Column) -> Column:
    return lookup(normalize_name(c), STATUSES, F.lit(UNKNOWN_STATUS))


def course_name(course_key: Column, source_name: Column) -> Column:
    """The registered name of the course, else the name in the export."""
    return lookup(course_key, COURSE_NAMES, strip(source_name))


def course_rank(course_key: Column) -> Column:
    """Loading order of the course; courses without a registered name come last."""
    rank = F.lit(len(COURSE_NAMES))
    for i, key in reversed(list(enumerate(COURSE_NAMES))):
        rank = F.when(course_key == key, F.lit(i)).otherwise(rank)
    return rank.cast("bigint")
