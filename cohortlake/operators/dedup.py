"""Keep-first deduplication and exact new-row detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """One row per key: the row with the least ``order`` columns.

    A window over the key would send all rows of a frequent key to one task. Here the
    equal rows are combined in the map tasks first, with the last order column as a
    plain long minimum, and only the few distinct variants of a key meet.
    """
    *outer, inner = order
    variants = df.groupBy(*keys, *payload, *outer).agg(F.min(inner).alias(inner))
    best = variants.groupBy(*keys).agg(
        F.min(F.struct(*order, *payload)).alias("best")
    )
    return best.select(*keys, *[F.col("best")[p].alias(p) for p in payload])


def row_key(columns: list[str]) -> Column:
    """SHA-256 over all values; nulls, order and types of the columns are kept apart."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
    return F.unhex(F.sha2(row, 256))


def new_rows(staging: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct staging rows the target lacks; nulls equal nulls, columns match by position.

    Both sides are made distinct first: the anti-join would otherwise bring all copies of
    a frequent row together.
    """
    return staging.distinct().subtract(target.distinct())


def new_rows_by_key(staging: DataFrame, target: DataFrame, columns: list[str], key: str) -> DataFrame:
    """The same result, with the row key appended, against a target that stores the key.

    Only the key column of the target is read and shuffled, and both sides are reduced
    to one row per key in the map tasks, so a row with very many copies costs one key.
    """
    distinct = staging.select(*[F.col(f"`{c}`") for c in columns]).distinct()
    return distinct.withColumn(key, row_key(columns)).join(
        target.select(key).distinct(), key, "left_anti"
    )
