"""Data quality: row counts per layer, nulls, outliers, cleaning losses."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..schemas import GOLD_TABLES
from .gold import Tables

# The tables of the report, by layer. Bronze keeps all courses in raw_lms.
REPORT = {
    "Bronze": ["raw_eod_activities", "raw_lms"],
    "Silver": [
        "dim_intern", "dim_course", "dim_mentor", "dim_activity", "fact_eod_log", "fact_lms_progress",
    ],
    "Gold": GOLD_TABLES,
}


def _count_row(df: DataFrame, layer: str, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"
    )


def _missing_row(spark: SparkSession, layer: str, table: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        F.lit(None).cast("bigint").alias("row_count"),
    )


def row_counts(t: Tables, report: Mapping[str, list[str]] = REPORT) -> DataFrame:
    rows = [_count_row(t[name], layer, name) for layer, names in report.items() for name in names]
    return reduce(DataFrame.unionByName, rows)


def catalog_row_counts(
    spark: SparkSession, databases: Mapping[str, str], report: Mapping[str, list[str]] = REPORT
) -> DataFrame:
    """Row counts of the stored tables in one plan; a table that is not there counts as null."""
    rows = []
    for layer, names in report.items():
        for name in names:
            full = f"{databases[layer]}.{name}"
            if spark.catalog.tableExists(full):
                rows.append(_count_row(spark.table(full), layer, name))
            else:
                rows.append(_missing_row(spark, layer, name))
    return reduce(DataFrame.unionByName, rows)


NULL_REPORT = ["test_pct", "kc_pct", "assignment_ratio", "progress_pct"]


def null_counts(df: DataFrame, columns: list[str] = NULL_REPORT) -> DataFrame:
    """(column_name, null_count), one scan."""
    missing = lambda c: F.count(F.lit(1)) - F.count(c)
    wide = df.agg(*[missing(c).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count")


def outlier_counts(t: Tables) -> DataFrame:
    return t["fact_eod_log"].groupBy("hours_outlier_flag").agg(F.count(F.lit(1)).alias("entry_count"))


def _losses() -> list[Column]:
    return [
        F.count(F.when(F.col("date").isNull(), 1)).alias("undated_rows"),
        F.coalesce(F.sum(F.col("hours_outlier_flag").cast("bigint")), F.lit(0)).alias("outlier_rows"),
        F.count(
            F.when(text.strip(F.coalesce(F.col("full_name"), F.lit(""))) == "", 1)
        ).alias("nameless_rows"),
        F.count(F.when(F.col("hours").isNull(), 1)).alias("hourless_rows"),
    ]


def cleaning_counts(eod_clean: DataFrame) -> DataFrame:
    return eod_clean.agg(*_losses())


def course_counts(raw_lms: DataFrame) -> DataFrame:
    """Raw rows of each course's export; the course partitions the table."""
    return raw_lms.groupBy("course_key").agg(F.count(F.lit(1)).alias("row_count"))


def progress_losses(t: Tables) -> DataFrame:
    """What cleaning and joining lose of the progress rows, per course: one aggregate, and one over people."""
    lms, people = t["lms_clean"], t["dim_intern"].select("intern_id", F.lit(1).alias("known"))
    scores = ("progress_pct", "kc_pct", "test_pct", "assignment_ratio")
    per_person = lms.groupBy("course_key", "intern_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("start_date").isNull()).alias("undated"),
        F.count_if(F.col("overall_status") == "Unknown").alias("unknown"),
        *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in scores],
    )
    lost = F.when(F.col("known").isNull() | F.col("course_key").isNull(), F.col("n")).otherwise(0)
    return per_person.join(people, "intern_id", "left").groupBy("course_key").agg(
        F.sum("n").alias("row_count"), F.sum("undated").alias("undated_rows"), F.sum("unknown").alias("unknown_status_rows"),
        *[F.sum(f"no_{c}").alias(f"no_{c}_rows") for c in scores], F.sum(lost).alias("rows_not_in_gold"),
    )


def observed_cleaning(eod_clean: DataFrame, observation: Observation) -> DataFrame:
    """The same counts as a by-product of whatever job reads the returned frame."""
    return eod_clean.observe(observation, *_losses())
