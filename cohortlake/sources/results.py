"""Stored model results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names of the result folders.
RESULTS = ["cluster_results", "regression_results", "pca_results"]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def write_result(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def load_all_results(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The results that are there."""
    paths = {name: f"{folder}/{name}.parquet" for name in RESULTS}
    return {n: spark.read.parquet(p) for n, p in paths.items() if path_exists(spark, p)}
