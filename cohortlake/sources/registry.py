"""Which files feed which source, and how they are read.

The exports are CSV or Parquet files; workbooks have to be exported first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_EOD, RAW_LMS, SEQ


@dataclass(frozen=True)
class Registry:
    """Paths of the daily logs, and per course key the paths of its progress exports."""

    eod: Sequence[str]
    lms: Mapping[str, Sequence[str]] = field(default_factory=dict)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenation by column name; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The CSV files of a path, those with the same first line together."""
    first = (
        spark.read.text(path)
        .select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
        .where("file_block_start = 0")
        .groupBy("file_path")
        .agg(F.min_by("value", "at").alias("header"))
    )
    # One row per file reaches the driver, which lists the files anyway.
    groups: dict[str, list[str]] = {}
    for row in first.orderBy("file_path").collect():
        groups.setdefault(row["header"], []).append(row["file_path"])
    return list(groups.values())


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One export, a file or a folder, by column name: of the schema's columns those that any file has.

    Files may hold their columns in different orders, or lack some; those are null there.
    """
    if path.rstrip("/").endswith(".parquet"):
        frames = [spark.read.option("mergeSchema", True).parquet(path)]
    else:
        frames = [spark.read.option("header", True).csv(files) for files in _files_by_header(spark, path)]
    if not frames:
        return spark.createDataFrame([], schema)
    known = [
        df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns])
        for df in frames
    ]
    return union_all(known)


def ingest_eod(spark: SparkSession, registry: Registry) -> DataFrame:
    return union_all([read_export(spark, p, RAW_EOD) for p in registry.eod])


def ingest_lms(spark: SparkSession, registry: Registry, course_key: str) -> DataFrame:
    frames = [read_export(spark, p, RAW_LMS) for p in registry.lms[course_key]]
    return union_all(frames).withColumn("course_key", F.lit(course_key))


def ingest_all_lms(spark: SparkSession, registry: Registry) -> DataFrame:
    return union_all([ingest_lms(spark, registry, key) for key in registry.lms])


def numbered(df: DataFrame) -> DataFrame:
    """Attach the position in the order of reading, for frames used without Bronze."""
    return df.withColumn(SEQ, F.monotonically_increasing_id())
