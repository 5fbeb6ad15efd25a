"""The refresh job: Bronze upsert, Silver and Gold where rows are new, training. Stops at the first failure."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..operators.cleaning import HOURS_HIGH, HOURS_LOW
from ..sources.bronze import EOD_TABLE, LMS_TABLE, last_load, table_exists, touched_parts, write_bronze
from ..sources.registry import Registry, ingest_all_lms, ingest_eod
from ..sources.results import write_result
from . import features, layers, models
from .warehouse import Warehouse


@dataclass(frozen=True)
class Databases:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def create(self, spark: SparkSession) -> None:
        for name in (self.bronze, self.silver, self.gold):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ingest(spark: SparkSession, registry: Registry, dbs: Databases) -> None:
    """Files to Bronze."""
    write_bronze(spark, ingest_eod(spark, registry), dbs.bronze, EOD_TABLE)
    write_bronze(spark, ingest_all_lms(spark, registry), dbs.bronze, LMS_TABLE)


def build_warehouse(
    spark: SparkSession, dbs: Databases, low: float = HOURS_LOW, high: float = HOURS_HIGH, everything: bool = False
) -> Warehouse:
    """Bring Silver and Gold up to date with Bronze: only months and courses with new rows are read.

    The ledger of Bronze tells which those are. They are written down before anything is
    changed and struck out when all tables are done, so a run that broke off is made up for
    by the next one; writing a partition again gives the same rows.
    """
    loads = {kind: last_load(spark, dbs.bronze, kind) for kind in (EOD_TABLE, LMS_TABLE)}
    state = State(spark, dbs.silver)
    done = {} if everything else state.loads()
    touched = {
        kind: None if kind not in done else touched_parts(spark, dbs.bronze, kind, done[kind]) for kind in loads
    }
    touched = state.with_unfinished(touched)
    state.begin(touched)
    layers.refresh_layers(spark, layers.BronzeSource(spark, dbs.bronze), dbs.silver, dbs.gold, touched, low, high, also=state.begin)
    state.finish(loads)
    return Warehouse.from_catalog(spark, dbs.silver, dbs.gold)


class State:
    """Which loads the layers hold, and which partitions a run has begun to rewrite: a table of a few lines a run."""

    def __init__(self, spark: SparkSession, database: str):
        self._spark, self._table = spark, f"{database}.refresh_state"

    def _lines(self) -> list[dict]:
        if not table_exists(self._spark, self._table):
            return []
        return [json.loads(r["line"]) for r in self._spark.table(self._table).orderBy("at").collect()]

    def _add(self, line: dict) -> None:
        rows = [(len(self._lines()), json.dumps(line))]
        self._spark.createDataFrame(rows, "at long, line string").coalesce(1).write.format("parquet").mode("append").saveAsTable(self._table)

    def loads(self) -> dict[str, int]:
        finished = [line["loads"] for line in self._lines() if "loads" in line]
        return finished[-1] if finished else {}

    def with_unfinished(self, touched: dict[str, list[str] | None]) -> dict[str, list[str] | None]:
        out = dict(touched)
        for line in reversed(self._lines()):
            if "loads" in line:
                break
            for kind, parts in line["touched"].items():
                out[kind] = None if parts is None or out[kind] is None else sorted({*out[kind], *parts})
        return out

    def begin(self, touched: dict[str, list[str] | None]) -> None:
        self._add({"touched": touched})

    def finish(self, loads: dict[str, int]) -> None:
        self._add({"loads": loads})


@dataclass(frozen=True)
class Trained:
    classifier: models.Classifier
    clustering: models.Clustering
    regression: models.Regression


def train(warehouse: Warehouse, folder: str, trees: int = 100, depth: int = 30) -> Trained:
    """Train all models, store them and their results under ``folder``.

    The feature frames are stored first: every model and result reads them again.
    """
    spark = warehouse["dim_intern"].sparkSession
    write_result(features.course_features(warehouse), folder, "course_features")
    write_result(features.person_features(warehouse), folder, "person_features")
    courses = spark.read.parquet(f"{folder}/course_features.parquet")
    people = spark.read.parquet(f"{folder}/person_features.parquet")
    trained = Trained(
        models.train_classifier(courses, trees, depth),
        models.train_clustering(people),
        models.train_regression(courses),
    )
    assigned = models.assign_clusters(trained.clustering, people)
    write_result(assigned.select(*models.CLUSTER_RESULT), folder, "cluster_results")
    write_result(
        models.regression_results(trained.regression, courses), folder, "regression_results"
    )
    write_result(models.pca_results(people, assigned), folder, "pca_results")
    save_models(spark, trained, folder)
    return trained


def save_models(spark: SparkSession, trained: Trained, folder: str) -> None:
    for name in ("classifier", "clustering", "regression"):
        getattr(trained, name).model.write().overwrite().save(f"{folder}/{name}")
    facts = {
        "labels": trained.classifier.labels,
        "accuracy": trained.classifier.accuracy,
        "names": trained.clustering.names,
        "cost": trained.clustering.cost,
        "r2": trained.regression.r2,
        "mae": trained.regression.mae,
    }
    row = spark.createDataFrame([(json.dumps(facts),)], "value string")
    row.write.mode("overwrite").text(f"{folder}/summary")


def load_models(spark: SparkSession, folder: str) -> Trained:
    facts = json.loads(spark.read.text(f"{folder}/summary").first()["value"])

    def stored(name: str) -> PipelineModel:
        return PipelineModel.load(f"{folder}/{name}")

    return Trained(
        models.Classifier(stored("classifier"), facts["labels"], facts["accuracy"]),
        models.Clustering(stored("clustering"), facts["names"], facts["cost"]),
        models.Regression(stored("regression"), facts["r2"], facts["mae"]),
    )


def refresh(
    spark: SparkSession, registry: Registry, model_folder: str, dbs: Databases = Databases()
) -> Trained:
    dbs.create(spark)
    ingest(spark, registry, dbs)
    return train(build_warehouse(spark, dbs), model_folder)
