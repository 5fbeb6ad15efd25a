"""Stored Silver and Gold, rewritten by month and course.

What a table needs of all rows is kept per month or course in reduced form: ways names are
written, activities, courses and mentors that occur, hours per person, day and activity,
scores per person and course. A new load rewrites the partitions it touched; dimensions and
the Gold tables that span months are made from the reduced tables, never from all facts again.
Sums are kept in exact parts, so adding up months gives what one pass over all rows would give.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean_eod, clean_lms, explode_mentors
from ..operators.dense_id import with_dense_id
from ..schemas import COLUMNS, SEQ
from ..sources.bronze import EOD_TABLE, LMS_TABLE, numbered_rows, partition_value, read_bronze, table_exists
from . import gold, silver
from .warehouse import Warehouse

PART = "part"
SIDE_BY_SIDE = 4
Touched = dict[str, list[str] | None]

#: How the tables are partitioned; those not named are rewritten whole, from reduced tables.
PARTITIONED = {
    "fact_eod_log": ["date"], "fact_lms_progress": ["course_id"], "eod_days": [PART], "lms_people": [PART],
    "eod_names": [PART], "lms_names": [PART], "activity_names": [PART], "course_names": [PART], "mentor_names": [PART],
    "gold_weekly_hours": ["year", "month_name"], "gold_course_progress": ["course_name"],
}


class Source(Protocol):
    """Raw rows of the months or courses asked for (all if none are named), and their dense numbers."""

    def rows(self, kind: str, parts: list[str] | None) -> DataFrame: ...

    def numbered(self, rows: DataFrame, kind: str, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class BronzeSource:
    spark: SparkSession
    database: str

    def rows(self, kind: str, parts: list[str] | None) -> DataFrame:
        return read_bronze(self.spark, self.database, kind, parts)

    def numbered(self, rows: DataFrame, kind: str, name: str) -> DataFrame:
        return numbered_rows(rows, self.spark, self.database, kind, name)


@dataclass(frozen=True)
class FrameSource:
    """Raw frames that carry an ingestion number; numbers are dense over the rows asked for."""

    frames: Mapping[str, DataFrame]

    def rows(self, kind: str, parts: list[str] | None) -> DataFrame:
        raw = self.frames[kind]
        return raw if parts is None else raw.where(partition_value(kind).isin(parts))

    def numbered(self, rows: DataFrame, kind: str, name: str) -> DataFrame:
        return with_dense_id(rows, [SEQ] if kind == EOD_TABLE else ["course_rank", SEQ], name)


def month(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("undated"))


def write_partitions(df: DataFrame, database: str, name: str, whole: bool) -> None:
    """Write a table anew, or only the partitions that occur in ``df``.

    Partitions are replaced under the table's path, since the writer's option for that is
    not heeded by inserts by table name; the catalog is told of new ones afterwards.
    """
    by = PARTITIONED.get(name, [])
    table = f"{database}.{name}"
    if by:
        # Rows of a partition are brought together for large files; a crowded one is split again.
        df = df.hint("rebalance", *by)
    spark = df.sparkSession
    if by and not whole and table_exists(spark, table):
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
        columns = spark.table(table).columns
        df.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(place)
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
        return
    writer = df.write.format("parquet").mode("overwrite")
    (writer.partitionBy(*by) if by else writer).saveAsTable(table)


def refresh_layers(
    spark: SparkSession, source: Source, silver_db: str, gold_db: str, touched: Mapping[str, list[str] | None],
    low: float, high: float, also: Callable[[Touched], None] = lambda touched: None,
) -> None:
    """Rewrite what the months (of daily logs) and courses in ``touched`` change; None stands for all of them.

    ``also`` is told of partitions that have to be rewritten because a name in them changed.
    """
    def stored(name: str) -> DataFrame:
        return spark.table(f"{silver_db}.{name}")

    def put(name: str, df: DataFrame, kind: str | None = None) -> None:
        write_partitions(df, silver_db, name, kind is None or touched[kind] is None)

    months, courses = touched[EOD_TABLE], touched[LMS_TABLE]
    jobs: list[Callable[[], None]] = []
    if months != []:
        eod = clean_eod(source.rows(EOD_TABLE, months), low, high)

        def logs() -> None:
            facts = source.numbered(silver.eod_facts(eod), EOD_TABLE, "log_id").select(*COLUMNS["fact_eod_log"])
            put("fact_eod_log", facts, EOD_TABLE)
            table = stored("fact_eod_log")
            fresh = table if months is None else table.where(month(F.col("date")).isin(months))
            days = gold.eod_groups({"fact_eod_log": fresh}, "intern_id", "date", "activity_id")
            put("eod_days", days.withColumn(PART, month(F.col("date"))), EOD_TABLE)

        jobs += [
            logs,
            lambda: put("eod_names", _by_part(eod, silver.eod_names, month(F.col("date"))), EOD_TABLE),
            lambda: put("activity_names", eod.select("activity", month(F.col("date")).alias(PART)).distinct(), EOD_TABLE),
        ]
    if courses != []:
        lms = clean_lms(source.rows(LMS_TABLE, courses))
        part = F.coalesce("course_key", F.lit("none"))

        def progress() -> None:
            put("course_names", silver.course_variants(lms).withColumn(PART, part), LMS_TABLE)
            put("dim_course", silver.dim_course(stored("course_names")))
            dim = stored("dim_course")
            facts = source.numbered(silver.lms_facts(lms, dim), LMS_TABLE, "progress_id").select(*COLUMNS["fact_lms_progress"])
            put("fact_lms_progress", facts, LMS_TABLE)
            keyed = stored("fact_lms_progress").join(dim.select("course_id", "course_key"), "course_id", "left")
            fresh = keyed if courses is None else keyed.where(part.isin(courses))
            people = gold.lms_groups({"fact_lms_progress": fresh}, "intern_id", "course_id", "course_key")
            put("lms_people", people.withColumn(PART, part).drop("course_key"), LMS_TABLE)

        jobs += [
            progress,
            lambda: put("lms_names", _by_part(lms, silver.lms_names, part), LMS_TABLE),
            lambda: put("mentor_names", explode_mentors(lms).withColumn(PART, part), LMS_TABLE),
        ]
    _side_by_side(spark, jobs)

    names = stored("eod_names").unionByName(stored("lms_names"))
    renamed = _renamed(spark, f"{silver_db}.dim_intern", names, touched)
    also(renamed)
    jobs = [lambda: put("dim_intern", silver.best_names(names))]
    if months != []:
        jobs += [
            lambda: put("dim_activity", silver.dim_activity(stored("activity_names"))),
            lambda: put("dim_date", silver.dim_date(stored("eod_days"))),
        ]
    if courses != []:
        jobs += [
            lambda: put("dim_mentor", silver.dim_mentor(stored("mentor_names"))),
            lambda: put("bridge_intern_mentor", silver.bridge_intern_mentor(stored("mentor_names"), stored("dim_course"))),
        ]
    _side_by_side(spark, jobs)
    t = Warehouse.from_catalog(spark, silver_db, gold_db).replaced_by(gold.BUILDERS)
    _side_by_side(spark, _gold_jobs(t, gold_db, renamed))


def on_demand(spark: SparkSession, source: Source, database: str, low: float, high: float) -> Warehouse:
    """Silver and Gold as stored tables, each written in full when it is first asked for, with the tables it reads.

    The rows are those that ``refresh_layers`` writes for all months and courses. Nothing is kept per month
    or course for later loads: sums over facts are made from the cleaned rows in one pass, and only who
    reads a fact table itself has its rows numbered.
    """
    eod, lms = partial(_cleaned_rows, source, EOD_TABLE, low, high), partial(_cleaned_rows, source, LMS_TABLE, low, high)

    def written(name: str, build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        def table(t: Warehouse) -> DataFrame:
            write_partitions(build(t).select(*COLUMNS[name]), database, name, True)
            return spark.table(f"{database}.{name}").select(*COLUMNS[name])

        return table

    builders = {
        "dim_intern": lambda t: silver.dim_intern(eod(), lms()),
        "dim_course": lambda t: silver.dim_course(lms()),
        "dim_mentor": lambda t: silver.dim_mentor(explode_mentors(lms())),
        "dim_activity": lambda t: silver.dim_activity(eod()),
        "dim_date": lambda t: silver.dim_date(eod()),
        "bridge_intern_mentor": lambda t: silver.bridge_intern_mentor(explode_mentors(lms()), t["dim_course"]),
        "fact_eod_log": lambda t: source.numbered(t[gold.EOD_ROWS], EOD_TABLE, "log_id"),
        "fact_lms_progress": lambda t: source.numbered(t[gold.LMS_ROWS], LMS_TABLE, "progress_id"),
        **gold.BUILDERS,
    }
    rows = {
        gold.EOD_ROWS: lambda t: silver.eod_facts(eod()),
        gold.LMS_ROWS: lambda t: silver.lms_facts(lms(), t["dim_course"]),
        gold.LMS_KEYED_ROWS: lambda t: t[gold.LMS_ROWS].join(t["dim_course"].select("course_id"), "course_id", "left"),
    }
    return Warehouse(rows | {name: written(name, build) for name, build in builders.items()})


def _cleaned_rows(source: Source, kind: str, low: float, high: float) -> DataFrame:
    raw = source.rows(kind, None)
    return clean_eod(raw, low, high) if kind == EOD_TABLE else clean_lms(raw)


def _side_by_side(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Tables that do not need each other are written at the same time; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=SIDE_BY_SIDE) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


def _by_part(rows: DataFrame, reduce: Callable[..., DataFrame], part: Column) -> DataFrame:
    return reduce(rows.withColumn(PART, part), PART)


def _renamed(spark: SparkSession, table: str, names: DataFrame, touched: Mapping[str, list[str] | None]) -> Touched:
    """``touched`` with the months and courses of people whose name is about to change."""
    out = {kind: None if parts is None else list(parts) for kind, parts in touched.items()}
    if None in out.values() or not table_exists(spark, table):
        return {kind: None for kind in out}
    now = silver.best_names(names)
    old = spark.table(table).select("intern_id", *[F.col(c).alias(f"old_{c}") for c in silver.NAME])
    changed = [~F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in silver.NAME]
    people = now.join(old, "intern_id").where(changed[0] | changed[1] | changed[2]).select("intern_id")
    # One row per month or course.
    for source, part in names.join(people, "intern_id", "left_semi").select("source", PART).distinct().collect():
        kind = (EOD_TABLE, LMS_TABLE)[source]
        if part not in out[kind]:
            out[kind].append(part)
    return out


def _gold_jobs(t: Warehouse, database: str, touched: Touched) -> list[Callable[[], None]]:
    months, courses = touched[EOD_TABLE], touched[LMS_TABLE]

    def put(name: str, df: DataFrame, whole: bool = True) -> Callable[[], None]:
        return lambda: write_partitions(df, database, name, whole)

    jobs = []
    if months != []:
        days = t["eod_days"] if months is None else t["eod_days"].where(F.col(PART).isin(months))
        jobs.append(put("gold_weekly_hours", gold.weekly_hours(t.replaced(eod_days=days)), months is None))
        jobs.append(put("gold_activity_summary", gold.activity_summary(t)))
    if courses != []:
        facts = t["fact_lms_progress"]
        if courses is not None:
            part = F.coalesce("course_key", F.lit("none"))
            facts = facts.join(t["dim_course"].where(part.isin(courses)).select("course_id"), "course_id", "left_semi")
        jobs.append(put("gold_course_progress", gold.course_progress(t.replaced(fact_lms_progress=facts)), courses is None))
        jobs.append(put("gold_mentor_workload", gold.mentor_workload(t)))
    if jobs:
        jobs.append(put("gold_intern_performance", gold.intern_performance(t)))
    return jobs
