"""Orderings and limits. A limit after an ordering is planned as top-k per task plus a merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, k: int | None, *order: Column) -> DataFrame:
    """The first ``k`` rows of the ordering, or all of them in order."""
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)


def asc(name: str) -> Column:
    """Ascending with nulls last, the order of the warehouse's SQL dialect."""
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def top_by_total(df: DataFrame, key: str, value: Column, k: int, total: str = "total") -> DataFrame:
    """The k keys with the greatest sum; ties go to the first key in alphabetical order."""
    return top(df.groupBy(key).agg(value.alias(total)), k, desc(total), asc(key))
