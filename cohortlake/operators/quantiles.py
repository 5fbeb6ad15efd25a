"""Exact quantiles, histograms and medians that never hold a group in one buffer."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dense_id import with_running_total

QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Five-number summary and 1.5 IQR fences per group, for a value with few distinct levels.

    Rows are first counted per (group, level); the exact percentile then weighs the
    levels by their counts, so its buffer holds levels and not rows. For a percentage
    stored as a whole number that is about a hundred entries per group.
    """
    levels = (
        df.filter(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    q = levels.groupBy(group).agg(
        F.percentile(F.col(value), F.array(*[F.lit(p) for p in QUARTILES]), F.col("_n")).alias("q"),
        F.sum("_n").alias("row_count"),
    )
    iqr = F.col("q")[3] - F.col("q")[1]
    return q.select(
        group,
        "row_count",
        F.col("q")[0].alias("min_value"),
        F.col("q")[1].alias("q1"),
        F.col("q")[2].alias("median"),
        F.col("q")[3].alias("q3"),
        F.col("q")[4].alias("max_value"),
        (F.col("q")[1] - F.lit(1.5) * iqr).alias("lower_fence"),
        (F.col("q")[3] + F.lit(1.5) * iqr).alias("upper_fence"),
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins over the observed range; the greatest value is in the last bin.

    The range enters as scalar subqueries, so no row is paired with another.
    """
    known = df.filter(F.col(value).isNotNull()).select(value)
    limits = known.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    bin_no = F.when(
        width > 0,
        F.least(F.floor((F.col(value) - lo) / F.when(width > 0, width)) + 1, F.lit(bins).cast("bigint")),
    ).otherwise(F.lit(1).cast("bigint"))
    return known.select(bin_no.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("entry_count"))


#: Ranks that a sketch may be off by, as a part of all rows: the bracket round a median holds twice that.
SKETCH_ERROR = 1e-4


def exact_medians(df: DataFrame, columns: list[str], error: float = SKETCH_ERROR) -> DataFrame:
    """(feature, median) of every column, nulls skipped, for values with any number of levels.

    A mergeable sketch brackets the middle ranks of all columns in one pass. Values below
    the bracket are only counted; those inside, a small part of the rows, are counted per
    level and sorted by range, and the exact middle ranks are found by running counts. No
    group's levels lie in one buffer.
    """
    # Read three times below, and the columns may be costly to make.
    df = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _medians(df, columns, error)
    finally:
        df.unpersist()


def _medians(df: DataFrame, columns: list[str], error: float) -> DataFrame:
    reach = 4 * error
    shares = F.array(F.lit(0.5 - reach), F.lit(0.5 + reach))
    accuracy = F.lit(int(1 / error))
    sketches = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(c) for c in columns])
    bounds = sketches.first()  # two numbers per column
    known = [c for c in columns if bounds[c] is not None]
    if not known:
        return df.sparkSession.createDataFrame([], "feature string, median double")
    values = {c: F.col(c).cast("double") for c in known}
    counts = df.agg(
        *[F.count(v).alias(f"n_{c}") for c, v in values.items()],
        *[F.count_if(v < bounds[c][0]).alias(f"b_{c}") for c, v in values.items()],
        *[F.count_if(v <= bounds[c][1]).alias(f"u_{c}") for c, v in values.items()],
    ).first()
    if any(not counts[f"b_{c}"] <= (counts[f"n_{c}"] - 1) // 2 <= counts[f"n_{c}"] // 2 < counts[f"u_{c}"] for c in known):
        raise RuntimeError("a sketch missed its error bound")
    inside = {c: F.when((v >= bounds[c][0]) & (v <= bounds[c][1]), v) for c, v in values.items()}
    placed = _ranked(df.select(*[v.alias(c) for c, v in inside.items()]), known)
    # One span row per column named in the call, so it may be broadcast.
    spans = placed.groupBy("feature").agg(F.min("before").alias("start"))
    spans = F.broadcast(spans)
    low_rank = {c: (counts[f"n_{c}"] - 1) // 2 - counts[f"b_{c}"] for c in known}
    high_rank = {c: counts[f"n_{c}"] // 2 - counts[f"b_{c}"] for c in known}

    def rank(of: dict[str, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for c, r in of.items() for x in (c, r)]), F.col("feature"))

    first = F.col("before") - F.col("start")
    last = first + F.col("n") - 1

    def at(r: Column) -> Column:
        return F.max(F.when((first <= r) & (r <= last), F.col("value")))

    return placed.join(spans, "feature").groupBy("feature").agg(((at(rank(low_rank)) + at(rank(high_rank))) / 2).alias("median"))


def _ranked(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, n, before): levels of all columns, each with the number of values that lie before it."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    levels = (
        df.select(F.explode(cells).alias("cell"))
        .select("cell.*")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_running_total(levels, ["feature", "value"], "n", "before")
