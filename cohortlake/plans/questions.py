"""Checks on questions and statements, read-only SQL, and the common questions as functions."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import presentable, stable_avg
from ..functions.text import WHITESPACE, strip
from ..operators.skew import join_one_per_key
from ..operators.topk import asc, desc, top
from .gold import Tables

ANSWER_LIMIT = 50
PREVIEW_ROWS = 10

# What a question must not contain, regardless of case.
BLOCKED = (
    r"(?iuU)(ignore previous|system prompt|drop table|delete from|update\s+\w|"
    r"insert into|truncate\s+\w|--\s|/\*)"
)
OUT_OF_CONTEXT = "OUT_OF_CONTEXT"

# How people name the courses, and what the course name then contains.
COURSE_TERMS = {
    "sql": ["SQL"],
    "python": ["Python"],
    "pyspark": ["PySpark"],
    "numpy": ["NumPy"],
    "pandas": ["NumPy"],
    "numpy/pandas": ["NumPy"],
    "big data": ["Big Data", "Engineering"],
}


def allowed(question: Column) -> Column:
    return ~question.rlike(BLOCKED)


def _head(answer: Column) -> Column:
    """Without code fences, up to the first semicolon that ends a line."""
    bare = strip(F.replace(F.replace(answer, F.lit("```sql"), F.lit("")), F.lit("```"), F.lit("")))
    return F.split(bare, r"(?m);+[ \t\r]*$", 2)[0]


def out_of_context(answer: Column) -> Column:
    return _head(answer).rlike(rf"(?im)^\s*{OUT_OF_CONTEXT}")


def statement(answer: Column) -> Column:
    """The first statement in a generated answer; null where the answer declines."""
    return F.when(~out_of_context(answer), strip(F.rtrim(_head(answer), F.lit(";" + WHITESPACE))))


# Expressions that run code from outside the engine, or tell of its surroundings.
REFUSED = {
    "CallMethodViaReflection", "ScalaUDF", "PythonUDF", "PythonUDAF", "InputFileName", "InputFileBlockStart",
    "InputFileBlockLength", "CurrentUser", "CurrentDatabase", "CurrentCatalog", "SparkVersion", "Version",
}
EXPRESSIONS = "org.apache.spark.sql.catalyst."
# Plans without rows from outside the statement.
OWN_ROWS = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef"}


def _listed(seq: Any) -> list[Any]:
    return [seq.apply(i) for i in range(seq.size())]


def _check_expression(node: Any, views: set[str]) -> None:
    kind = node.getClass()
    if kind.getSimpleName() in REFUSED or not kind.getName().startswith(EXPRESSIONS):
        raise ValueError(f"{kind.getSimpleName()} is not run")
    for child in _listed(node.children()):
        _check_expression(child, views)
    if hasattr(node, "plan") and "Subquery" in kind.getSimpleName():
        _check_plan(node.plan(), views)


def _check_plan(node: Any, views: set[str]) -> None:
    """Refuse rows from anything but the named views and the statement itself, and refused expressions."""
    kind = node.getClass().getSimpleName()
    if kind == "View":
        if not node.isTempView() or node.desc().identifier().table() not in views:
            raise ValueError("only the given views are read")
        return
    children = _listed(node.children())
    if not children and kind not in OWN_ROWS:
        raise ValueError(f"only the given views are read, not {kind}")
    for expression in _listed(node.expressions()):
        _check_expression(expression, views)
    for child in children:
        _check_plan(child, views)


def run_sql(
    spark: SparkSession,
    sql: str,
    views: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run one query over the named views; cells come back as plain values.

    The text is placed in a FROM clause, where the grammar admits queries only, so a
    statement that writes or changes anything does not parse. It is analysed, but not run,
    in a session of its own; the analysed plan is then walked: it may read the given views
    and rows it makes itself, no other table or file, and call no refused expression. The
    caller's session, its settings and its views stay as they are, so calls do not disturb
    each other.
    """
    text = sql.strip().rstrip(";")
    if not text.upper().startswith(("SELECT", "WITH")):
        raise ValueError("only SELECT and WITH statements are run")
    own = spark.newSession()
    shared = {name: f"v{uuid.uuid4().hex}" for name in views or {}}
    try:
        for name, df in (views or {}).items():
            df.createGlobalTempView(shared[name])
            own.table(f"global_temp.{shared[name]}").createTempView(name)
        result = own.sql(f"SELECT * FROM (\n{text}\n)", args=dict(args or {}))
        _check_plan(result._jdf.queryExecution().analyzed(), set(shared))
        return result.select(
            *[presentable(F.col(f"`{c}`"), dtype).alias(c) for c, dtype in result.dtypes]
        )
    finally:
        for name in shared.values():
            spark.catalog.dropGlobalTempView(name)


def answered(
    spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None, k: int = ANSWER_LIMIT
) -> tuple[list[str], list[tuple], str | None]:
    """Columns and the first ``k`` rows for showing, or the error as text."""
    try:
        df = run_sql(spark, sql, views)
        return df.columns, [tuple(r) for r in df.take(k)], None
    except (ValueError, PySparkException) as error:
        return [], [], str(error)


def preview(df: DataFrame, order: list[Column], k: int = PREVIEW_ROWS) -> DataFrame:
    """(line_no, line): header, the first k rows, and how many rows there are beyond."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("None")) for c in df.columns]
    first = top(df, k, *order)
    # At most k rows reach this window.
    numbered = first.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("line_no"),
        F.concat_ws(" | ", *cells).alias("line"),
    )
    header = df.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("line_no"), F.lit(" | ".join(df.columns)).alias("line")
    )
    more = F.col("n") - k
    footer = (
        df.agg(F.count(F.lit(1)).alias("n"))
        .filter(more > 0)
        .select(
            F.lit(k + 1).cast("bigint").alias("line_no"),
            F.concat(F.lit("... and "), more.cast("string"), F.lit(" more rows.")).alias("line"),
        )
    )
    return reduce(DataFrame.unionByName, [header, numbered, footer])


# ---- the common questions ----------------------------------------------------------

def about_course(term: str) -> Column:
    """Course name contains the term or its synonym, regardless of case."""
    def like(word: str) -> Column:
        escaped = word.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
        return F.col("course_name").ilike(f"%{escaped}%")

    words = COURSE_TERMS.get(term.strip().lower(), [term])
    return reduce(lambda a, b: a | b, [like(w) for w in words])


def top_k_course(t: Tables, term: str, k: int = ANSWER_LIMIT) -> DataFrame:
    rows = t["gold_course_progress"].filter(about_course(term)).select(
        "full_name", "course_name", "progress_pct", "overall_status", "test_pct"
    )
    return top(
        rows, k, desc("progress_pct"), asc("full_name"), asc("course_name"),
        asc("overall_status"), asc("test_pct"),
    )


def with_status(t: Tables, term: str, status: str = "Not Started", k: int | None = None) -> DataFrame:
    rows = (
        t["gold_course_progress"].filter(about_course(term) & (F.col("overall_status") == status))
        .select("full_name", "course_name", "overall_status", "progress_pct")
    )
    return top(rows, k, asc("full_name"), asc("course_name"), asc("progress_pct"))


def average_test_per_course(t: Tables) -> DataFrame:
    return t["gold_course_progress"].groupBy("course_name").agg(
        stable_avg("test_pct").alias("avg_test_pct")
    )


def most_hours_in_week(t: Tables, year: int, week: int, k: int | None = None) -> DataFrame:
    rows = (
        t["gold_weekly_hours"].filter((F.col("year") == year) & (F.col("week_number") == week))
        .select("full_name", "year", "week_number", "month_name", "total_hours")
    )
    return top(rows, k, desc("total_hours"), asc("full_name"), asc("month_name"))


def daily_detail(t: Tables, day: datetime.date, k: int | None = None) -> DataFrame:
    """What everybody did on a day. The day is filtered on the fact before its joins."""
    of_day = t["fact_eod_log"].filter(F.col("date") == F.lit(day))
    named = join_one_per_key(of_day, t["dim_activity"], "activity_id")
    rows = join_one_per_key(named, t["dim_intern"], "intern_id").select(
        "full_name", "date", "activity_name", "hours"
    )
    order = [asc("full_name"), asc("activity_name"), asc("hours")]
    return rows.orderBy(*order) if k is None else top(rows, k, *order)


def raw_scores(t: Tables) -> DataFrame:
    # One row per registered course.
    courses = t["dim_course"].select("course_id", "course_name")
    people = t["dim_intern"].select("intern_id", "full_name")
    rows = t["fact_lms_progress"].join(courses, "course_id")
    return join_one_per_key(rows, people, "intern_id").select(
        "full_name", "course_name", "kc_score", "kc_max", "kc_pct",
        "test_score", "test_max", "test_pct", "completed_count", "total_assignments",
    )


def mentor_listing(t: Tables) -> DataFrame:
    pairs = t["bridge_intern_mentor"].select("mentor_id", "intern_id").distinct()
    people = t["dim_intern"].select("intern_id", "full_name")
    named = join_one_per_key(pairs, t["dim_mentor"], "mentor_id")
    return join_one_per_key(named, people, "intern_id").select("mentor_name", "full_name")


def best_overall(t: Tables, k: int = 1) -> DataFrame:
    rows = t["gold_intern_performance"].select("full_name", "total_hours", "courses_completed")
    return top(rows, k, desc("total_hours"), asc("full_name"))
