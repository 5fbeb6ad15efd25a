"""The three models and the projection, as pipelines trained and scored in batch."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import round_half_even, stable_avg
from ..operators import forest
from ..operators.moments import dot, moments
from ..operators.topk import desc
from ..session import ensure_checkpoint_dir, shared_folder
from .features import COURSE_FEATURES, PERSON_FEATURES, SCORE_FEATURES
from .preparation import CentresOfStarts, LevelFlags, MedianImputer, PopulationScaler, Ridge, StoredForest, VotesOfForests, joined

SEED = 42
CLUSTERS = 3
RESTARTS = 10
CENTRE_SAMPLE = 10_000  # rows that starting centres are drawn from
# Names of the clusters, by mean hours, highest first.
CLUSTER_NAMES = ["High Performer", "Average Performer", "At Risk"]
UNKNOWN_CLUSTER = "Unknown"


def with_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Make sure all feature columns exist as doubles; what is missing is 0."""
    present = set(df.columns)
    return df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in present else F.lit(0.0)
            for c in columns
        }
    )


def _course_stages(numeric: list[str]) -> list:
    """Exact medians for what is missing, a flag per course, all scaled; an unseen course has no flag set."""
    return [
        MedianImputer(columns=numeric),
        LevelFlags(column="course_name", output="course_flags"),
        PopulationScaler(columns=numeric, arrays=["course_flags"], output="features"),
    ]


# ---- classifier -------------------------------------------------------------------

#: A forest is grown by several fits side by side, one more for each so many rows times trees, up to ``MOST_FITS``;
#: one of trees that may be deeper than ``SHALLOW`` is then grown in the tasks instead.
ROWS_TIMES_TREES = 5_000_000
SHALLOW = 10
MOST_FITS = 8
ROWS_OF_A_TASK = 500_000  # rows a task of these fits reads at most, about
SEED_STEP = 1_000  # between the seeds of fits; the library counts up from a seed by partition


@dataclass(frozen=True)
class Classifier:
    model: PipelineModel
    labels: list[str]
    accuracy: float

    @property
    def forests(self) -> list[RandomForestClassificationModel | StoredForest]:
        return [s for s in self.model.stages if isinstance(s, (RandomForestClassificationModel, StoredForest))]

    @property
    def depth(self) -> int:
        first = self.forests[0]
        return first.value("depth") if isinstance(first, StoredForest) else first.getOrDefault("maxDepth")


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Weight rows/(classes x class rows), which gives every class the same total weight."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    totals = sizes.agg(F.sum("class_rows").alias("rows"), F.count(F.lit(1)).alias("classes"))
    per_class = F.col("class_rows") * totals.select("classes").scalar()
    weights = sizes.select(label, (totals.select("rows").scalar() / per_class).alias("weight"))
    # One row per status: the status lookup yields four at most.
    return df.join(F.broadcast(weights), label)


def train_classifier(rows: DataFrame, trees: int = 100, depth: int = 30, seed: int = SEED) -> Classifier:
    """Random forest for the status of a progress row, classes weighted equally, fitted on all labelled rows.

    Large forests of deep trees are grown in the tasks and kept as a table: the library holds all of a
    forest on the driver and sends it whole with every job.
    """
    found = rows.count()
    data = balanced(with_features(rows, COURSE_FEATURES), "overall_status")
    data = data.select("course_name", "overall_status", "weight", *COURSE_FEATURES)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        indexer = StringIndexer(
            inputCol="overall_status", outputCol="label", stringOrderType="alphabetAsc"
        ).fit(data)
        indexed = indexer.transform(data)
        prepared = Pipeline(stages=_course_stages(COURSE_FEATURES)).fit(indexed)
        ready = prepared.transform(indexed).select("label", "weight", "features")
        if depth > SHALLOW and found * trees > ROWS_TIMES_TREES:
            forests = [_stored(ready, len(indexer.labels), trees, depth, seed)]
        else:
            forests = _grown(ready, found, trees, depth, seed)
        votes = VotesOfForests(inputs=[f.getRawPredictionCol() for f in forests])
        model = PipelineModel([*prepared.stages, *forests, votes])
        accuracy = model.transform(indexed).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        return Classifier(model, list(indexer.labels), accuracy)
    finally:
        data.unpersist()


def _stored(ready: DataFrame, classes: int, trees: int, depth: int, seed: int) -> StoredForest:
    """A forest grown in the tasks over all rows, as tables in the shared folder."""
    weight = dict(ready.select("label", "weight").distinct().collect())  # one row per status
    rows = ready.select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x"))
    first = rows.first()
    cuts = forest.thresholds(rows, "x", len(first["x"]))
    growth = forest.Growth(cuts, np.array([weight[float(i)] for i in range(classes)]), depth, seed)
    spark = ready.sparkSession
    folder = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    blocks = forest.binned(rows, "x", "label", cuts)
    forest.grow(blocks, ready.count(), trees, growth, f"{folder}/nodes")
    forest.pack(spark.read.parquet(f"{folder}/nodes"), f"{folder}/trees")
    return StoredForest(features="features", output="votes", folder=folder, classes=classes, depth=depth)


def _grown(ready: DataFrame, n: int, trees: int, depth: int, seed: int) -> list[RandomForestClassificationModel]:
    """``trees`` trees over about ``n`` rows, as one forest or as several smaller ones grown at the same time.

    At every level the library makes and ships statistics of each open node in each partition, whether
    rows of it are there or not. With many deep trees that is nearly all of the work, and it grows with
    the partitions. So a large forest of shallow trees is grown by several fits, each over all rows in few partitions.
    """
    fits = max(1, min(MOST_FITS, trees, 1 + n * trees // ROWS_TIMES_TREES))
    if fits > 1:
        ready = ready.repartition(-(-n // ROWS_OF_A_TASK)).persist(StorageLevel.MEMORY_AND_DISK)

    def grow(at: int) -> RandomForestClassificationModel:
        return RandomForestClassifier(
            labelCol="label", featuresCol="features", weightCol="weight",
            rawPredictionCol=f"votes_{at}", probabilityCol="", predictionCol="",
            numTrees=trees // fits + (at < trees % fits), maxDepth=depth, seed=seed + SEED_STEP * at,
            # Deep trees: remember each row's node instead of sending whole trees to the
            # tasks at every level, and grow many nodes per pass over the data.
            cacheNodeIds=True, maxMemoryInMB=1024 if fits == 1 else 256,
        ).fit(ready)

    try:
        with ThreadPoolExecutor(max_workers=fits) as pool:
            return list(pool.map(inheritable_thread_target(ready.sparkSession)(grow), range(fits)))
    finally:
        if fits > 1:
            ready.unpersist()


def _label_at(labels: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in labels]), index.cast("int"))


def classify(classifier: Classifier, rows: DataFrame) -> DataFrame:
    """Append ``status`` and ``probabilities`` (status to probability, three decimals)."""
    scored = classifier.model.transform(with_features(rows, COURSE_FEATURES))
    names = F.array(*[F.lit(v) for v in classifier.labels])
    chances = F.transform(vector_to_array("probability"), lambda p: round_half_even(p, 3))
    return scored.select(
        *rows.columns,
        _label_at(classifier.labels, F.col("prediction")).alias("status"),
        F.map_from_arrays(names, chances).alias("probabilities"),
    )


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy("overall_status", "status").agg(F.count(F.lit(1)).alias("row_count"))


# ---- clustering -------------------------------------------------------------------

@dataclass(frozen=True)
class Clustering:
    model: PipelineModel
    names: list[str]  # by raw cluster number
    cost: float


def train_clustering(
    people: DataFrame,
    features: list[str] | str = PERSON_FEATURES,
    order_by: Column | str = "total_hours",
    k: int = CLUSTERS,
    restarts: int = RESTARTS,
    seed: int = SEED,
    max_iter: int = 300,
) -> Clustering:
    """k-means on standardised features, the best of several starts; ``features`` are columns or one array column."""
    columns, arrays = (features, []) if isinstance(features, list) else ([], [features])
    data = with_features(people, columns)
    model = Pipeline(
        stages=[
            *([MedianImputer(columns=columns)] if columns else []),
            PopulationScaler(columns=columns, arrays=arrays, output="scaled"),
            CentresOfStarts(features="scaled", output="cluster_raw", k=k, starts=restarts, seed=seed, rounds=max_iter, sample=CENTRE_SAMPLE),
        ]
    ).fit(data)
    means = (
        model.transform(data.withColumn("_order", F.col(order_by) if isinstance(order_by, str) else order_by))
        .groupBy("cluster_raw").agg(stable_avg("_order").alias("mean"))
        .orderBy(desc("mean"), "cluster_raw")
        .collect()  # k rows
    )
    names = [UNKNOWN_CLUSTER] * k
    for rank, row in enumerate(means):
        if rank < len(CLUSTER_NAMES):
            names[row["cluster_raw"]] = CLUSTER_NAMES[rank]
    return Clustering(model, names, model.stages[-1].value("cost"))


# The columns of the stored result.
CLUSTER_RESULT = [
    "intern_id", "full_name", "cluster_raw", "cluster_label", "total_hours", "distinct_activities",
    "avg_progress_pct", "avg_assignment_ratio", "avg_kc_pct", "avg_test_pct",
    "total_activity_entries", "courses_completed",
]


def assign_clusters(
    clustering: Clustering, people: DataFrame, features: list[str] | str = PERSON_FEATURES
) -> DataFrame:
    rows = with_features(people, features) if isinstance(features, list) else people
    scored = clustering.model.transform(rows)
    label = F.coalesce(_label_at(clustering.names, F.col("cluster_raw")), F.lit(UNKNOWN_CLUSTER))
    return scored.withColumn("cluster_label", label).drop("scaled")


def cluster_certificate(clustering: Clustering, people: DataFrame, features: list[str] | str = PERSON_FEATURES) -> DataFrame:
    """Per cluster: ``people``, and the largest gap between its centre and the mean of its members.

    Members are the rows whose nearest centre it is, so gaps of zero say that no row and no
    centre would move: the clustering is a fixed point of k-means. One aggregate.
    """
    rows = with_features(people, features) if isinstance(features, list) else people
    scored = clustering.model.transform(rows).select("cluster_raw", vector_to_array("scaled").alias("x"))
    centres = clustering.model.stages[-1].value("centres")
    centre = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres])
    at = scored.select("cluster_raw", F.posexplode("x").alias("at", "x"))
    means = at.groupBy("cluster_raw", "at").agg(stable_avg("x").alias("mean"), F.count(F.lit(1)).alias("people"))
    gap = F.abs(F.col("mean") - F.get(F.get(centre, F.col("cluster_raw")), F.col("at")))
    return means.groupBy("cluster_raw").agg(F.max("people").alias("people"), F.max(gap).alias("gap"))


def cluster_profiles(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster_label").agg(
        round_half_even(F.avg("total_hours"), 2).alias("total_hours"),
        round_half_even(F.avg("avg_progress_pct"), 2).alias("avg_progress_pct"),
        F.count(F.lit(1)).alias("people"),
    )


# ---- regression -------------------------------------------------------------------

@dataclass(frozen=True)
class Regression:
    model: PipelineModel
    r2: float
    mae: float


def _scored_rows(rows: DataFrame, drop_missing_target: bool) -> DataFrame:
    return rows.dropna(subset=["test_pct"]) if drop_missing_target else rows.fillna(0, ["test_pct"])


def train_regression(
    rows: DataFrame, alpha: float = 1.0, drop_missing_target: bool = False
) -> Regression:
    """Ridge regression of the test score on population-standardised features.

    One pass of cross products gives weights and R2, one more the mean absolute error.
    """
    data = with_features(_scored_rows(rows, drop_missing_target), SCORE_FEATURES)
    data = data.select("course_name", "test_pct", *SCORE_FEATURES).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ridge = Ridge(features="features", target="test_pct", output="predicted_test_pct", alpha=alpha)
        model = Pipeline(stages=[*_course_stages(SCORE_FEATURES), ridge]).fit(data)
        mae = model.transform(data).agg(stable_avg("abs(test_pct - predicted_test_pct)")).first()[0]
        return Regression(model, model.stages[-1].value("r2"), mae)
    finally:
        data.unpersist()


def predict_scores(regression: Regression, rows: DataFrame) -> DataFrame:
    scored = regression.model.transform(with_features(rows, SCORE_FEATURES))
    return scored.drop("course_flags", "features")


def regression_results(regression: Regression, rows: DataFrame) -> DataFrame:
    """Names, actual and predicted score; rows without a score count as 0, as in training."""
    return predict_scores(regression, rows.fillna(0, ["test_pct"])).select(
        "intern_id", "full_name", "course_name", "test_pct", "predicted_test_pct"
    )


def regression_report(regression: Regression, rows: DataFrame) -> DataFrame:
    """``row_count``, ``r2`` and ``mae`` of the predictions, computed from them in one aggregate."""
    scored = regression_results(regression, rows)
    y, off = F.col("test_pct"), F.col("test_pct") - F.col("predicted_test_pct")
    return scored.agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.lit(1.0) - F.sum(off * off) / (F.var_pop(y) * F.count(y))).alias("r2"),
        stable_avg("abs(test_pct - predicted_test_pct)").alias("mae"),
    )


# ---- projection -------------------------------------------------------------------

def project(people: DataFrame, features: list[str] | str = PERSON_FEATURES) -> DataFrame:
    """Append ``pca_x`` and ``pca_y``: principal components of the centred, unscaled features.

    ``features`` are columns or one array column. The cross products are one pass; their
    two main directions are found on the driver, whose matrix has the size of the features
    squared. The sign of a component is free; here its weight of greatest size is positive.
    """
    columns, arrays = (features, []) if isinstance(features, list) else ([], [features])
    data = with_features(people, columns)
    whole = data.select(joined(columns, arrays).alias("x"))
    first = whole.first()
    width = len(first["x"]) if first else len(columns)
    found = moments(whole, "x", width)
    _, directions = np.linalg.eigh(found.scatter)
    parts = {}
    for name, at in (("pca_x", -1), ("pca_y", -2)):
        w = directions[:, at] if width >= -at else np.zeros(width)
        w = w if w[np.abs(w).argmax()] >= 0 else -w
        parts[name] = dot(joined(columns, arrays), w.tolist()) - F.lit(float(w @ found.mean))
    return data.withColumns(parts)


def pca_results(people: DataFrame, assigned: DataFrame) -> DataFrame:
    names = assigned.select("intern_id", "cluster_label", "full_name")
    return project(people).select("intern_id", "pca_x", "pca_y").join(names, "intern_id", "left")


# ---- forest as a table ------------------------------------------------------------

def forest_nodes(spark: SparkSession, classifier: Classifier, folder: str) -> DataFrame:
    """The trees as rows: ``tree``, ``node``, ``feature`` (null for a leaf), ``threshold``, ``low``, ``high``, ``shares``.

    The library writes fitted models as such rows; they are read back from ``folder``. A stored forest has them.
    ``shares`` are a node's weights per class, as parts of their sum.
    """
    parts, before = [], 0
    for at, fitted in enumerate(classifier.forests):
        if isinstance(fitted, StoredForest):
            return fitted.nodes(spark)
        fitted.write().overwrite().save(f"{folder}/{at}")
        rows = spark.read.parquet(f"{folder}/{at}/data")
        parts.append(rows.select((F.col("treeID") + before).alias("treeID"), "nodeData.*"))
        before += fitted.getNumTrees
    rows = reduce(DataFrame.union, parts)
    inner = F.col("leftChild") >= 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.col("leftChild").alias("low"), F.col("rightChild").alias("high"),
        F.transform("impurityStats", lambda x: x / total).alias("shares"),
    )


#: Inner nodes, of some trees, that are sent to the tasks at once for the joins, at about 200 bytes each on the driver.
SENT_NODES = 200_000


def forest_shares(nodes: DataFrame, rows: DataFrame, key: str, features: str, depth: int, sent_nodes: int = SENT_NODES) -> DataFrame:
    """``key`` and ``by_class``, the mean shares of the leaves a row ends in, one per tree, by joins with the node table.

    A row stands at the root of every tree and goes down one level per join, ``depth`` at
    most. ``features`` is an array column. Nodes join by (tree, node); those of some trees, up to ``sent_nodes``
    inner ones, go to all tasks at a time, so that no row is shuffled on its way down. For larger trees the
    planner chooses the join.
    """
    sizes = nodes.groupBy("tree").agg(F.count("feature").alias("inner")).orderBy("tree").collect()  # a row per tree
    large = [r["tree"] for r in sizes if r["inner"] > sent_nodes]
    groups: list[list[int]] = []
    room = 0
    for r in sizes:
        if r["inner"] > sent_nodes:
            continue
        if not groups or r["inner"] > room:
            groups.append([])
            room = sent_nodes
        groups[-1].append(r["tree"])
        room -= r["inner"]
    found = [_leaf_shares(nodes, rows, key, features, depth, trees, True) for trees in groups]
    found += [_leaf_shares(nodes, rows, key, features, depth, large, False)] if large else []
    if len(found) > 1:
        # One after the other, so that the driver makes the nodes of one group ready at a time.
        ensure_checkpoint_dir(rows.sparkSession)
        found = [sums.checkpoint() for sums in found]
    sums = reduce(DataFrame.union, found).groupBy(key, "class").agg((F.sum("share") / len(sizes)).alias("share"))
    ordered = F.array_sort(F.collect_list(F.struct("class", "share")))  # one entry per class
    return sums.groupBy(key).agg(F.transform(ordered, lambda s: s["share"]).alias("by_class"))


def _leaf_shares(nodes: DataFrame, rows: DataFrame, key: str, features: str, depth: int, trees: list[int], send: bool) -> DataFrame:
    """``key``, ``class`` and the sum of the ``share`` of the leaves that a row ends in, over ``trees``."""
    some = nodes.where(F.col("tree").isin(trees))
    at = rows.select(key, F.col(features).alias("x"), F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree"), F.lit(0).alias("node"))
    inner = some.select("tree", "node", "feature", "threshold", "low", "high").where("feature is not null")
    leaf = some.where("feature is null").select("tree", "node", "shares")
    if send:
        inner, leaf = F.broadcast(inner), F.broadcast(leaf)
    going = F.when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("low")).otherwise(F.col("high"))
    for _ in range(depth):
        stepped = at.join(inner, ["tree", "node"], "left")
        at = stepped.select(key, "x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(going).alias("node"))
    leaves = at.select(key, "tree", "node").join(leaf, ["tree", "node"])
    each = leaves.select(key, F.posexplode("shares").alias("class", "share"))
    return each.groupBy(key, "class").agg(F.sum("share").alias("share"))


def forest_certificate(spark: SparkSession, classifier: Classifier, rows: DataFrame, folder: str) -> DataFrame:
    """Per true status: rows, rows whose shares by joins differ from the library's, rows whose shares do not add up to one."""
    ensure_checkpoint_dir(spark)
    # Each row becomes as many as there are trees, so a small table is spread over all cores first.
    tasks = max(rows.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    scored = classifier.model.transform(with_features(rows.repartition(tasks), COURSE_FEATURES)).select(
        F.monotonically_increasing_id().alias("row"), "overall_status", vector_to_array("features").alias("x"),
        vector_to_array("probability").alias("library"),
    ).checkpoint()
    depth = classifier.depth
    shares = forest_shares(forest_nodes(spark, classifier, folder), scored, "row", "x", depth)
    off = F.exists(F.zip_with("library", "by_class", lambda a, b: F.coalesce(F.abs(a - b) > 1e-9, F.lit(True))), lambda x: x)
    total = F.aggregate("by_class", F.lit(0.0), lambda a, x: a + x)
    return scored.join(shares, "row", "left").groupBy("overall_status").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.coalesce(off, F.lit(True))).alias("differing"),
        F.count_if(F.coalesce(F.abs(total - 1) > 1e-9, F.lit(True))).alias("unbalanced"),
    )
