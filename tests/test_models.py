"""Models against closed forms and properties."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.plans import features, models


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(0)
    centres = np.repeat([[40.0] * 9, [20.0] * 9, [2.0] * 9], [30, 30, 40], axis=0)
    x = np.abs(centres + rng.normal(size=(100, 9)))
    rows = [(f"p{i}", f"P {i}", *map(float, r)) for i, r in enumerate(x)]
    schema = "intern_id string, full_name string, " + ", ".join(f"{c} double" for c in models.PERSON_FEATURES)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def courses(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(90):
        x = [float(v) for v in rng.uniform(0, 100, len(models.SCORE_FEATURES))]
        name = ["Basic SQL", "Basic Python Programming", "Other's"][i % 3]
        y = 0.4 * x[0] + 0.2 * x[1] + 5 * (i % 3) + float(rng.normal())
        status = "Completed" if x[0] > 70 else "In Progress" if x[0] > 10 else "Not Started"
        rows.append((f"p{i}", f"P {i}", name, status, y, *x))
    schema = "intern_id string, full_name string, course_name string, overall_status string, test_pct double, " + ", ".join(
        f"{c} double" for c in models.SCORE_FEATURES
    )
    return spark.createDataFrame(rows, schema)


def test_ridge_equals_closed_form(courses):
    fit = models.train_regression(courses)
    pdf = courses.toPandas()
    levels = sorted(pdf["course_name"].unique())
    x = np.column_stack(
        [pdf[models.SCORE_FEATURES], *[(pdf["course_name"] == v).astype(float) for v in levels]]
    ).astype(float)
    y = pdf["test_pct"].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + np.eye(z.shape[1]), z.T @ (y - y.mean()))
    want = dict(zip(pdf["intern_id"], z @ w + y.mean()))
    got = {r["intern_id"]: r["predicted_test_pct"] for r in models.regression_results(fit, courses).collect()}
    assert got == pytest.approx(want, rel=1e-9)
    assert fit.mae == pytest.approx(np.mean(np.abs(y - np.array([want[i] for i in pdf["intern_id"]]))))


def test_missing_targets(courses):
    holes = courses.withColumn("test_pct", F.when(F.col("progress_pct") > 50, F.col("test_pct")))
    dropped = models.train_regression(holes, drop_missing_target=True)
    zeroed = models.train_regression(holes)
    assert dropped.mae < zeroed.mae


def test_projection_equals_svd(people):
    got = models.project(people).toPandas().set_index("intern_id").sort_index()
    x = people.toPandas().set_index("intern_id").sort_index()[models.PERSON_FEATURES].to_numpy()
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    for i, name in enumerate(("pca_x", "pca_y")):
        sign = np.sign(vt[i][np.abs(vt[i]).argmax()])
        assert np.allclose(got[name], sign * u[:, i] * s[i], atol=1e-8)


def test_clusters(people):
    fit = models.train_clustering(people, restarts=3)
    single = models.train_clustering(people, restarts=1)
    assert fit.cost <= single.cost + 1e-9
    assigned = models.assign_clusters(fit, people)
    sizes = {r["cluster_label"]: r["people"] for r in models.cluster_profiles(assigned).collect()}
    assert sizes == {"High Performer": 30, "Average Performer": 30, "At Risk": 40}
    means = {r["cluster_label"]: r["total_hours"] for r in models.cluster_profiles(assigned).collect()}
    assert means["High Performer"] > means["Average Performer"] > means["At Risk"]


def test_classifier(courses):
    fit = models.train_classifier(courses, trees=10, depth=8)
    assert fit.labels == sorted(fit.labels)
    scored = models.classify(fit, courses)
    rows = scored.collect()
    assert all(sum(r["probabilities"].values()) == pytest.approx(1, abs=0.01) for r in rows)
    hits = sum(r["status"] == r["overall_status"] for r in rows) / len(rows)
    assert fit.accuracy == pytest.approx(hits) and hits > 0.9
    table = models.confusion(scored).collect()
    assert sum(r["row_count"] for r in table) == len(rows)


def test_weights_balance_classes(courses):
    weighed = models.balanced(courses, "overall_status").groupBy("overall_status").agg(F.sum("weight").alias("w"))
    totals = [r["w"] for r in weighed.collect()]
    assert totals == pytest.approx([30.0] * 3)


def test_feature_helpers(spark):
    df = spark.createDataFrame([(1.0, "b"), (None, "a"), (4.0, "b")], "x double, c string")
    assert sorted(r["x"] for r in features.median_imputed(df, ["x"]).collect()) == [1.0, 2.5, 4.0]
    z = features.standardised(df.fillna(2.5).withColumn("k", F.lit(3.0)), ["x", "k"]).collect()
    assert sum(r["x"] ** 2 for r in z) == pytest.approx(3.0) and {r["k"] for r in z} == {0.0}
    assert [tuple(r) for r in features.label_codes(df, "c").orderBy("code").collect()] == [("a", 0), ("b", 1)]
    assert features.levels_of(df, "c") == ["a", "b"]


def test_forest_by_joins_equals_the_library(spark, courses, tmp_path):
    fit = models.train_classifier(courses, trees=7, depth=6)
    rows = models.forest_certificate(spark, fit, courses, str(tmp_path / "forest")).collect()
    assert sum(r["row_count"] for r in rows) == 90 and not any(r["differing"] or r["unbalanced"] for r in rows)


def test_a_large_forest_is_grown_by_several_fits(spark, courses, tmp_path, monkeypatch):
    """All trees are there, none twice, each fit reads few partitions, and rows get the mean of all trees' shares."""
    read = []
    fit_of = models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: read.append(df.rdd.getNumPartitions()) or fit_of(self, df))
    monkeypatch.setattr(models, "ROWS_TIMES_TREES", 300)
    fit = models.train_classifier(courses.repartition(6), trees=8, depth=6)
    assert read == [1, 1, 1] and sorted(f.getNumTrees for f in fit.forests) == [2, 3, 3]
    nodes = models.forest_nodes(spark, fit, str(tmp_path / "nodes"))
    trees = [tuple(sorted((r["node"], r["feature"] or -1, r["threshold"] or 0.0) for r in nodes.where(F.col("tree") == i).collect())) for i in range(8)]
    assert len(set(trees)) == 8 and nodes.select("tree").distinct().count() == 8
    rows = models.forest_certificate(spark, fit, courses, str(tmp_path / "forest")).collect()
    assert sum(r["row_count"] for r in rows) == 90 and not any(r["differing"] or r["unbalanced"] for r in rows)
    again = models.Classifier(_kept(fit.model, str(tmp_path / "m")), fit.labels, fit.accuracy)
    one, two = (sorted((r["intern_id"], r["status"], *r["probabilities"].items()) for r in models.classify(m, courses).collect()) for m in (fit, again))
    assert one == two


def _kept(model, place):
    from pyspark.ml import PipelineModel

    model.write().overwrite().save(place)
    return PipelineModel.load(place)


def test_rows_are_not_shuffled_on_their_way_down_a_forest(spark):
    """Two trees of three levels by hand; a forest too large to be sent gives the same shares."""
    inner = [(0, 0, 0, 0.5, 1, 2), (0, 2, 1, 0.5, 3, 4), (1, 0, 1, 0.2, 1, 2)]
    leaves = [(0, 1, [1.0, 0.0]), (0, 3, [0.5, 0.5]), (0, 4, [0.0, 1.0]), (1, 1, [1.0, 0.0]), (1, 2, [0.0, 1.0])]
    schema = "tree int, node int, feature int, threshold double, low int, high int, shares array<double>"
    nodes = spark.createDataFrame([(*n, [0.5, 0.5]) for n in inner] + [(t, n, None, None, -1, -1, x) for t, n, x in leaves], schema)
    rows = spark.createDataFrame([(1, [0.1, 0.1]), (2, [0.9, 0.3]), (3, [0.9, 0.9])], "row long, x array<double>")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = models.forest_shares(nodes, rows, "row", "x", 3)
        assert "SortMergeJoin" not in sent._jdf.queryExecution().executedPlan().toString()
        for shares in (sent, models.forest_shares(nodes, rows, "row", "x", 3, sent_nodes=0)):
            assert {r["row"]: r["by_class"] for r in shares.collect()} == {1: [1.0, 0.0], 2: [0.25, 0.75], 3: [0.0, 1.0]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_moments_keep_their_digits(spark):
    from cohortlake.operators.moments import moments

    rng = np.random.default_rng(2)
    x = 1e6 + rng.normal(size=(500, 3)) * [1, 1e-3, 5]
    df = spark.createDataFrame([(row.tolist(),) for row in x], "x array<double>").repartition(5)
    found = moments(df, "x", 3)
    centred = x - x.mean(axis=0)
    assert found.n == 500 and np.allclose(found.scatter, centred.T @ centred, rtol=1e-6, atol=1e-5)
    assert moments(df.limit(0), "x", 3).n == 0


def test_k_means_stops_where_nothing_moves(spark, people):
    fit = models.train_clustering(people, restarts=4)
    rows = models.cluster_certificate(fit, people).collect()
    assert sum(r["people"] for r in rows) == 100 and max(r["gap"] for r in rows) < 1e-9


def test_stages_are_saved_and_loaded(spark, courses, tmp_path):
    from pyspark.ml import PipelineModel

    fit = models.train_regression(courses)
    fit.model.write().overwrite().save(str(tmp_path / "m"))
    again = models.Regression(PipelineModel.load(str(tmp_path / "m")), fit.r2, fit.mae)
    one, two = (sorted(map(tuple, models.regression_results(m, courses).collect())) for m in (fit, again))
    assert one == two
    report = models.regression_report(fit, courses).first()
    assert report["r2"] == pytest.approx(fit.r2) and report["mae"] == pytest.approx(fit.mae)


def test_k_means_rounds_read_packed_rows(spark):
    """Sums of packed rows are those of the plain rows, and each task keeps few, large blocks."""
    from cohortlake.operators.moments import centre_sums, packed

    x = np.random.default_rng(3).normal(size=(700, 4))
    blocks = packed(spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(3), "x", 4)
    assert blocks.count() == 3
    centres = np.stack([x[:2], x[5:7]])
    sums, counts, cost = centre_sums(blocks, centres)
    for s in range(2):
        near = ((x[:, None] - centres[s]) ** 2).sum(axis=2).argmin(axis=1)
        assert counts[s].tolist() == [(near == c).sum() for c in range(2)]
        assert np.allclose(sums[s], [x[near == c].sum(axis=0) for c in range(2)])
        assert cost[s] == pytest.approx(((x - centres[s][near]) ** 2).sum())


@pytest.fixture(scope="module")
def noisy(spark):
    """600 rows whose status follows two features, with noise, so that trees are deep."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        x = [float(v) for v in rng.uniform(0, 100, len(models.COURSE_FEATURES))]
        noise = rng.uniform() < 0.2
        status = ["Completed", "In Progress", "Not Started"][int(rng.integers(3)) if noise else int(x[0] > 40) + int(x[1] > 70)]
        rows.append((f"p{i}", ["Basic SQL", "Other's"][i % 2], status, *x))
    schema = "intern_id string, course_name string, overall_status string, " + ", ".join(f"{c} double" for c in models.COURSE_FEATURES)
    return spark.createDataFrame(rows, schema).repartition(3, "intern_id")


@pytest.mark.parametrize("draws, at_once", [(250_000, 500_000_000), (100, 3_000)])
def test_a_deep_forest_is_grown_in_the_tasks(spark, noisy, tmp_path, monkeypatch, draws, at_once):
    """No library model is on the driver; upper levels by counts of all tasks or not; saved and loaded it says the same; again it is the same."""
    from pyspark.ml import PipelineModel

    from cohortlake.operators import forest

    monkeypatch.setattr(models, "ROWS_TIMES_TREES", 300)
    monkeypatch.setattr(models.RandomForestClassifier, "fit", None)
    monkeypatch.setattr(forest, "TASK_DRAWS", draws)
    monkeypatch.setattr(forest, "ROWS_AT_ONCE", at_once)
    monkeypatch.setattr(forest, "VOTE_ROWS", 150)
    monkeypatch.setattr(forest, "SENT_BYTES", 20_000)
    fit = models.train_classifier(noisy, trees=12, depth=14)
    scored = models.classify(fit, noisy)
    assert fit.accuracy > 0.9 and fit.accuracy == pytest.approx(sum(r["status"] == r["overall_status"] for r in scored.collect()) / 600)
    nodes = models.forest_nodes(spark, fit, str(tmp_path / "none"))
    assert nodes.select("tree").distinct().count() == 12 and nodes.count() == nodes.select("tree", "node").distinct().count()
    trees = nodes.groupBy("tree").agg(F.count_if(F.isnull("feature")).alias("leaves"), F.count_if(F.isnotnull("feature")).alias("inner")).collect()
    assert all(t["leaves"] == t["inner"] + 1 > 50 for t in trees)
    rows = models.forest_certificate(spark, fit, noisy, str(tmp_path / "forest")).collect()
    assert sum(r["row_count"] for r in rows) == 600 and not any(r["differing"] or r["unbalanced"] for r in rows)
    fit.model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert str(tmp_path / "m") in loaded.stages[-2].value("folder")
    again = models.Classifier(loaded, fit.labels, fit.accuracy)
    anew = models.train_classifier(noisy, trees=12, depth=14)
    said = [sorted((r["intern_id"], r["status"], *r["probabilities"].items()) for r in models.classify(m, noisy).collect()) for m in (fit, again, anew)]
    assert said[0] == said[1] == said[2]


def test_a_forest_goes_to_the_joins_in_pieces(spark, noisy, tmp_path, monkeypatch):
    """No broadcast holds more inner nodes than allowed, and the shares are those of the whole forest."""
    fit = models.train_classifier(noisy, trees=6, depth=8)
    nodes = models.forest_nodes(spark, fit, str(tmp_path / "nodes"))
    most = max(r["n"] for r in nodes.where("feature is not null").groupBy("tree").agg(F.count("*").alias("n")).collect())
    rows = fit.model.transform(noisy).select(F.col("intern_id").alias("row"), models.vector_to_array("features").alias("x"))
    whole = {r["row"]: r["by_class"] for r in models.forest_shares(nodes, rows, "row", "x", 8).collect()}
    pieces, shown = [], models.F.broadcast
    monkeypatch.setattr(models.F, "broadcast", lambda df: pieces.append(df.count()) or shown(df))
    found = {r["row"]: r["by_class"] for r in models.forest_shares(nodes, rows, "row", "x", 8, sent_nodes=2 * most).collect()}
    assert len(pieces) >= 6 and max(pieces) <= 2 * most + 2 and sum(pieces) == nodes.count()
    assert len(whole) == 600 and all(found[k] == pytest.approx(v, abs=1e-12) for k, v in whole.items())
