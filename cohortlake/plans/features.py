"""Feature frames for the models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_weekend
from ..functions.numbers import summed_parts
from ..operators.skew import join_one_per_key
from .gold import Tables, course_progress, eod_groups, lms_by_intern
from .preparation import MedianImputer, PopulationScaler, levels_of  # noqa: F401

# Domain-hours feature to activity category.
DOMAINS = {
    "hours_sql": "SQL",
    "hours_pyspark": "PySpark",
    "hours_numpy": "NumPy/Pandas",
    "hours_bi": "BI/Reporting",
}

# What each model is trained on.
COURSE_FEATURES = ["progress_pct", "assignment_ratio", "kc_pct", "test_pct", *DOMAINS]
SCORE_FEATURES = ["progress_pct", "kc_pct", "assignment_ratio", *DOMAINS]
PERSON_FEATURES = [
    "total_hours", "distinct_activities", "avg_progress_pct", "avg_assignment_ratio",
    *DOMAINS, "weekend_hours",
]


def _per_activity(t: Tables) -> DataFrame:
    """Hours per person, activity and kind of day, with the category: what all hour features are made of.

    Grouped by the kind of day at once: by date there would be nearly as many groups as rows. The
    category is joined to aggregated rows; what has no category keeps a null.
    """
    weekend = F.coalesce(is_weekend(F.col("date")), F.lit(False))
    reduced = eod_groups(t, "intern_id", "activity_id", weekend.alias("weekend"))
    categories = t["dim_activity"].select("activity_id", "activity_category")
    return join_one_per_key(reduced, categories, "activity_id", "left")


def _hours_where(condition: str | None) -> Column:
    return F.coalesce(summed_parts("h", condition), F.lit(0.0))


def _domains() -> list[Column]:
    return [_hours_where(f"activity_category = '{c}'").alias(name) for name, c in DOMAINS.items()]


def domain_hours(t: Tables) -> DataFrame:
    """Hours per person in the four domains."""
    rows = _per_activity(t).where(F.col("activity_category").isNotNull())
    return rows.groupBy("intern_id").agg(*_domains())


def _zero_filled(df: DataFrame) -> DataFrame:
    numeric = [c for c, dtype in df.dtypes if dtype in ("double", "bigint", "int")]
    return df.fillna(0, subset=numeric)


def course_features(t: Tables, zero_missing_test: bool = True) -> DataFrame:
    """One row per progress row. Missing values are 0, the test score too unless told otherwise."""
    rows = course_progress(t).select(
        "intern_id", "full_name", "course_name", "progress_pct",
        "assignment_ratio", "kc_pct", "test_pct", "overall_status",
    )
    joined = join_one_per_key(rows, domain_hours(t), "intern_id", "left")
    columns = [c for c in COURSE_FEATURES if zero_missing_test or c != "test_pct"]
    return joined.fillna(0, subset=columns)


def person_features(t: Tables) -> DataFrame:
    """One row per person; every joined frame has one row per person as well."""
    hours = _per_activity(t).groupBy("intern_id").agg(
        _hours_where(None).alias("total_hours"),
        F.countDistinct("activity_id").alias("distinct_activities"),
        _hours_where("weekend").alias("weekend_hours"),
        *_domains(),
    )
    progress = lms_by_intern(t).withColumnRenamed("lms_rows", "total_activity_entries")
    return _zero_filled(
        t["dim_intern"].select("intern_id", "full_name")
        .join(hours, "intern_id", "left")
        .join(progress, "intern_id", "left")
    )


def one_hot(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """A 0/1 column per level, none left out."""
    flags = {f"{column}_{v}": F.coalesce((F.col(column) == v).cast("double"), F.lit(0.0)) for v in levels}
    return df.withColumns(flags)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): codes count up in alphabetical order."""
    from pyspark.ml.feature import StringIndexer

    # Counted first: the indexer then sees one row per value.
    values = df.select(column).distinct()
    model = StringIndexer(
        inputCol=column, outputCol="code", stringOrderType="alphabetAsc", handleInvalid="skip"
    ).fit(values)
    return model.transform(values).select(column, F.col("code").cast("bigint").alias("code"))


def median_imputed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls replaced by the column's exact median."""
    return MedianImputer(columns=columns).fit(df).transform(df)


def standardised(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns minus mean over population deviation; constant columns become 0."""
    scaler = PopulationScaler(columns=columns, arrays=[], output="_scaled").fit(df)
    scaled = scaler.transform(df).withColumn("_scaled", vector_to_array("_scaled"))
    return scaled.withColumns({c: F.col("_scaled")[i] for i, c in enumerate(columns)}).drop("_scaled")
