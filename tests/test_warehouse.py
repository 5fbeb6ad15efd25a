"""Bronze upserts, the stream, the refresh job, and invariants between the layers."""

from __future__ import annotations

import datetime
import os
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cohortlake import catalogue
from cohortlake.plans import quality, refresh
from cohortlake.plans.refresh import Databases
from cohortlake.plans.warehouse import REDUCED
from cohortlake.schemas import COLUMNS, GOLD_TABLES, SILVER_TABLES
from cohortlake.sources import bronze, registry, results
from cohortlake.streaming.bronze_stream import export_stream, start_bronze

from conftest import SAMPLE

EOD = "Date string, `First Name` string, `Last Name` string, Activity string, Hours string"


def eod(spark, *rows):
    return spark.createDataFrame(list(rows), EOD)


A = ("05/01/2026", "Ann", "Lee", "SQL Revision", "2.5")
B = ("06/01/2026", "Bo", "Li", "NumPy Practice", None)
C = ("bad", "Bo", "Li", None, "9")


def content(spark, database):
    return sorted(map(tuple, bronze.read_raw(spark, database, bronze.EOD_TABLE).collect()), key=str)


def test_first_load_keeps_copies_and_later_loads_add_new_rows(spark, database):
    bronze.write_bronze(spark, eod(spark, A, A, B), database, bronze.EOD_TABLE)
    assert content(spark, database) == sorted([A, A, B], key=str)
    bronze.write_bronze(spark, eod(spark, A, B, C, C), database, bronze.EOD_TABLE)
    bronze.write_bronze(spark, eod(spark, C, B), database, bronze.EOD_TABLE)
    assert content(spark, database) == sorted([A, A, B, C], key=str)
    order = [r[0] for r in spark.table(f"{database}.{bronze.EOD_TABLE}").select("ingest_seq").collect()]
    assert len(set(order)) == 4


def test_a_frequent_copy_is_stored_once(spark, database):
    bronze.write_bronze(spark, eod(spark, *[A] * 300, B), database, bronze.EOD_TABLE)
    bronze.write_bronze(spark, eod(spark, *[A] * 300, *[C] * 300, B), database, bronze.EOD_TABLE)
    assert len(content(spark, database)) == 302


def test_stream_equals_batches(spark, database, tmp_path):
    folder = str(tmp_path / "in")
    batches = [[A, B], [B, C], [C, A]]
    for i, rows in enumerate(batches):
        eod(spark, *rows).coalesce(1).write.parquet(f"{folder}/{i}")
    for _ in range(2):  # the second run finds nothing new
        stream = export_stream(spark, f"{folder}/*", bronze.EOD_TABLE, files_per_batch=1)
        query = start_bronze(stream, database, bronze.EOD_TABLE, str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        assert query.exception() is None
    assert content(spark, database) == sorted([A, B, C], key=str)


def test_exports_are_joined_by_name(spark, tmp_path):
    one, two = str(tmp_path / "raw.parquet"), str(tmp_path / "made.csv")
    eod(spark, A).write.parquet(one)
    eod(spark, B).select("Hours", "Activity", "`First Name`", "Date").write.option("header", True).csv(two)
    rows = registry.ingest_eod(spark, registry.Registry([one, two])).collect()
    assert {(r["First Name"], r["Last Name"], r["Activity"]) for r in rows} == {
        ("Ann", "Lee", "SQL Revision"), ("Bo", None, "NumPy Practice"),
    }


def test_invariants(spark):
    t = catalogue.sample(spark, SAMPLE, dense_ids=True)
    facts = t["fact_eod_log"].cache()
    n = t["eod_clean"].count()
    ids = facts.agg(F.min("log_id"), F.max("log_id"), F.countDistinct("log_id")).first()
    assert tuple(ids) == (0, n - 1, n)
    assert facts.filter(F.col("activity_id").isNotNull()).join(t["dim_activity"], "activity_id", "left_anti").count() == 0
    nameless = F.col("intern_id") == "e3b0c44298"
    assert facts.filter(~nameless).join(t["dim_intern"], "intern_id", "left_anti").count() == 0
    dated = facts.filter(F.col("date").isNotNull() & ~nameless).agg(F.sum("hours")).first()[0]
    assert t["gold_weekly_hours"].agg(F.sum("total_hours")).first()[0] == pytest.approx(dated)
    assert t["gold_intern_performance"].count() == t["dim_intern"].count()
    for name in COLUMNS:
        assert set(COLUMNS[name]) <= set(t[name].columns), name
    facts.unpersist()


def test_case_variants_collapse(spark):
    from cohortlake.operators.cleaning import clean_eod
    from cohortlake.plans import silver

    rows = [("SQL REVISION",), ("SQL Revision",), ("sql revision",), (None,), (" ",), ("x",)]
    dim = silver.dim_activity(clean_eod(spark.createDataFrame(rows, "Activity string")))
    assert sorted((r["activity_name"], r["activity_category"]) for r in dim.collect()) == [
        ("SQL Revision", "SQL"), ("x", "Other"),
    ]


def test_observed_counts(spark):
    clean = catalogue.sample(spark, SAMPLE)["eod_clean"]
    seen = Observation("cleaning")
    quality.observed_cleaning(clean, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == quality.cleaning_counts(clean).first().asDict()


def test_refresh(spark, tmp_path, database):
    """Files to models and back, twice: the second run adds no row."""
    t = catalogue.sample(spark, SAMPLE)
    folder = str(tmp_path)
    t["raw_eod_activities"].drop("ingest_seq").write.parquet(f"{folder}/eod.parquet")
    for key in ("python", "sql", "numpy_pandas", "pyspark"):
        rows = t["raw_lms"].filter(F.col("course_key") == key).drop("ingest_seq", "course_key")
        rows.write.parquet(f"{folder}/{key}.parquet")
    files = registry.Registry(
        [f"{folder}/eod.parquet"], {k: [f"{folder}/{k}.parquet"] for k in ("python", "sql", "numpy_pandas", "pyspark")}
    )
    dbs = Databases(database, database, database)
    counts = []
    for _ in range(2):
        refresh.ingest(spark, files, dbs)
        warehouse = refresh.build_warehouse(spark, dbs)
        report = quality.catalog_row_counts(spark, {"Bronze": database, "Silver": database, "Gold": database})
        counts.append(sorted(map(tuple, report.collect())))
    assert counts[0] == counts[1]
    assert all(n for *_, n in counts[0])
    assert set(warehouse) == {*SILVER_TABLES, *GOLD_TABLES, *REDUCED}
    assert warehouse["dim_course"].count() == 4
    lazy = catalogue.sample(spark, SAMPLE)["gold_weekly_hours"]
    assert sorted(map(tuple, warehouse["gold_weekly_hours"].collect())) == sorted(map(tuple, lazy.collect()))
    of_day = warehouse["fact_eod_log"].filter(F.col("date") == datetime.date(2024, 1, 10))
    plan = of_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan

    models = f"{folder}/models"
    assert results.load_all_results(spark, models) == {}
    trained = refresh.train(warehouse, models, trees=5, depth=5)
    stored = results.load_all_results(spark, models)
    assert set(stored) == set(results.RESULTS)
    people = warehouse["dim_intern"].count()
    assert stored["cluster_results"].count() == people == stored["pca_results"].count()
    again = refresh.load_models(spark, models)
    assert again.classifier.labels == trained.classifier.labels
    assert again.clustering.names == trained.clustering.names

    from cohortlake.plans.models import classify

    rows = spark.createDataFrame([("Basic SQL", 60.0), ("New course", 1.0)], "course_name string, progress_pct double")
    scored = classify(again.classifier, rows).collect()
    for row in scored:
        assert row["status"] in again.classifier.labels
        assert sum(row["probabilities"].values()) == pytest.approx(1.0, abs=0.01)
    assert os.path.exists(f"{models}/pca_results.parquet")


def test_missing_table_is_reported(spark, database):
    report = quality.catalog_row_counts(spark, {"Gold": database}, {"Gold": ["gold_weekly_hours"]})
    assert [tuple(r) for r in report.collect()] == [("Gold", "gold_weekly_hours", None)]


def test_folders_are_read_by_column_name(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "a.csv").write_text("Date,First Name,Last Name,Activity,Hours\n01/01/2026,Bob,Ray,SQL Revision,3.5\n")
    (folder / "b.csv").write_text("Hours,Activity,Last Name,First Name,Date\n2.5,SQL Revision,Lee,Ann,05/01/2026\n")
    (folder / "c.csv").write_text("Date,First Name,Other\n06/01/2026,Cy,x\n")
    rows = registry.ingest_eod(spark, registry.Registry([str(folder)]))
    got = sorted((r["Date"], r["First Name"], r["Hours"]) for r in rows.collect())
    assert [(d, n, None if h is None else float(h)) for d, n, h in got] == [
        ("01/01/2026", "Bob", 3.5), ("05/01/2026", "Ann", 2.5), ("06/01/2026", "Cy", None),
    ]
    both = str(tmp_path / "both.parquet")
    spark.createDataFrame([("01/01/2026", "Bob")], ["Date", "First Name"]).coalesce(1).write.parquet(both)
    spark.createDataFrame([("05/01/2026", "Ann", "2.5")], ["Date", "First Name", "Hours"]).coalesce(1).write.mode("append").parquet(both)
    rows = registry.ingest_eod(spark, registry.Registry([both])).collect()
    assert sorted((r["Date"], r["Hours"]) for r in rows) == [("01/01/2026", None), ("05/01/2026", "2.5")]


def test_sums_of_any_size_do_not_depend_on_order(spark):
    from pyspark.sql import functions as F

    from cohortlake.functions.numbers import stable_sum

    values = [0.1, 2.0**40, 0.2, 1e300, 3.7, None, -(2.0**40)] * 3
    for n in (1, 5):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(n)
        assert df.where("x < 1e20").agg(stable_sum(F.col("x"))).first()[0] == 12.0
        assert df.agg(stable_sum(F.col("x"))).first()[0] == pytest.approx(3e300)
    assert spark.createDataFrame([(None,)], "x double").agg(stable_sum(F.col("x"))).first()[0] is None


def lms_rows(spark, *rows):
    schema = "`User Name` string, `Course Name` string, `Start Date` string, `Mentor Name` string, `Progress (%)` string, `Overall Status` string, course_key string"
    return spark.createDataFrame(list(rows), schema)


P1 = ("Ann Lee", "x", "2026-01-05", "M One, M Two", "80%", "completed", "sql")
P2 = ("bo li", "x", "2026-01-06", "M Two", "40%", "in progress", "python")
P3 = ("ann lee", "x", "2026-02-05", "M One", "10%", "not started", "pyspark")
GOLD_WITHOUT_IDS = ["gold_weekly_hours", "gold_activity_summary", "gold_course_progress", "gold_intern_performance", "gold_mentor_workload"]


def gold_rows(warehouse):
    return {n: sorted(map(repr, map(tuple, warehouse[n].collect()))) for n in GOLD_WITHOUT_IDS}


def loaded(spark, dbs, eod_rows, progress_rows):
    bronze.write_bronze(spark, eod(spark, *eod_rows), dbs.bronze, bronze.EOD_TABLE)
    bronze.write_bronze(spark, lms_rows(spark, *progress_rows), dbs.bronze, bronze.LMS_TABLE)


def test_refresh_rewrites_what_a_load_touched(spark, database, monkeypatch):
    """Three loads, one of them after a run that broke off; then everything again gives the same."""
    from cohortlake.plans import layers

    dbs = Databases(database, database, database)
    march = ("01/03/2026", "Ann", "Lee", "SQL Revision", "1.5")
    renamed = ("02/03/2026", "BO", "LI", "SQL Revision", "2.0")
    loaded(spark, dbs, [A, A, march], [P1, P2])
    refresh.build_warehouse(spark, dbs)
    written = []
    write = layers.write_partitions

    def noted(df, db, name, whole):
        if layers.PARTITIONED.get(name) == [layers.PART]:
            written.append((name, whole, sorted(r[0] for r in df.select(layers.PART).distinct().collect())))
        write(df, db, name, whole)

    monkeypatch.setattr(layers, "write_partitions", noted)
    loaded(spark, dbs, [A, C, renamed], [P1, P3])
    monkeypatch.setattr(layers, "_gold_jobs", lambda *a: [lambda: 1 / 0])
    with pytest.raises(ZeroDivisionError):
        refresh.build_warehouse(spark, dbs)
    days = [w for w in written if w[0] == "eod_days"]
    assert days == [("eod_days", False, ["2026-03", "undated"])]
    assert [w for w in written if w[0] == "lms_people"] == [("lms_people", False, ["pyspark"])]
    monkeypatch.undo()
    after = gold_rows(refresh.build_warehouse(spark, dbs))
    names = {r["full_name"] for r in spark.table(f"{database}.gold_course_progress").collect()}
    assert names & {"BO LI", "Bo Li"} and "bo li" not in names
    assert after == gold_rows(refresh.build_warehouse(spark, dbs))
    assert after == gold_rows(refresh.build_warehouse(spark, dbs, everything=True))
    ids = sorted(r[0] for r in spark.table(f"{database}.fact_eod_log").select("log_id").collect())
    assert ids == list(range(5))


def test_a_load_that_broke_off_is_entered_by_the_next(spark, database, monkeypatch):
    bronze.write_bronze(spark, eod(spark, A), database, bronze.EOD_TABLE)
    calls = []

    def broken(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return entered(*args)

    entered = bronze.register
    monkeypatch.setattr(bronze, "register", broken)
    with pytest.raises(RuntimeError):
        bronze.write_bronze(spark, eod(spark, A, B), database, bronze.EOD_TABLE)
    monkeypatch.undo()
    bronze.write_bronze(spark, eod(spark, B, C), database, bronze.EOD_TABLE)
    assert content(spark, database) == sorted([A, B, C], key=str)
    lines = bronze.ledger(spark, database, bronze.EOD_TABLE).groupBy("load_no").agg(F.sum("n")).orderBy("load_no").collect()
    assert [tuple(r) for r in lines] == [(0, 1), (1, 1), (2, 1)]
    rows = bronze.numbered_rows(spark.table(f"{database}.{bronze.EOD_TABLE}"), spark, database, bronze.EOD_TABLE, "no")
    assert sorted(r["no"] for r in rows.collect()) == [0, 1, 2]


def test_stored_keys_are_not_shuffled(spark, database):
    bronze.write_bronze(spark, eod(spark, A, B), database, bronze.EOD_TABLE, buckets=4)
    known = spark.table(bronze.keys_table(database, bronze.EOD_TABLE)).select(bronze.KEY)
    batch = spark.table(f"{database}.{bronze.EOD_TABLE}").select(bronze.KEY)
    plan = batch.hint("merge").join(known.hint("merge"), bronze.KEY, "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1

def test_a_load_is_compared_by_one_shuffle_and_not_written_down(spark, database, monkeypatch):
    """No checkpoint holds raw rows; the rows of a batch are shuffled by their key alone, copies combined before, and once to be written."""
    bronze.write_bronze(spark, eod(spark, A, A, B), database, bronze.EOD_TABLE)
    kept, plans = [], []
    frame, writer = type(spark.range(1)), type(spark.range(1).write)
    checkpoint, save = frame.checkpoint, writer.saveAsTable
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a: kept.append(self.columns) or checkpoint(self, *a))
    monkeypatch.setattr(writer, "saveAsTable", lambda self, name, *a, **k: plans.append((name, self._df._jdf.queryExecution().executedPlan().toString())) or save(self, name, *a, **k))
    bronze.write_bronze(spark, eod(spark, A, *[C] * 5), database, bronze.EOD_TABLE)
    assert kept and not any("Hours" in columns for columns in kept)
    plan = next(p for name, p in plans if name == f"{database}.{bronze.EOD_TABLE}")
    moved = re.findall(r"Exchange (\w+)\(([^,]*)", plan)
    assert [how for how, _ in moved].count("hashpartitioning") <= 3 and all(by.startswith(("row_key", "bronze_part")) for how, by in moved if how == "hashpartitioning")
    assert "partial_first" in plan and content(spark, database) == sorted([A, A, B, C], key=str)


def test_only_the_tables_a_query_reads_are_written(spark, database, tmp_path):
    """A table asked for brings those it reads, no others; all tables hold the rows of a full refresh, copies included."""
    from cohortlake.plans import layers

    lms = spark.createDataFrame(
        [("Ann Lee", "50%", "3/4", "M One, M Two", "Completed", "sql", 1), ("Ann Lee", "50%", "3/4", "M One, M Two", "Completed", "sql", 2),
         ("ann lee", "9%", None, None, "paused", None, 3), (None, None, "1/0", "M Two", "Completed", "python", 4),
         ("Cy Roe", "70%", "2/4", "M Two", "Completed", "big_data", 5)],
        "`User Name` string, `Progress (%)` string, `Overall Test` string, `Mentor Name` string, `Overall Status` string, course_key string, ingest_seq long",
    )
    # Rows without a key may name a registered course: two keys then share one course id.
    lms = lms.withColumn("Course Name", F.when(F.col("course_key").isNull(), "Introduction to Data Engineering & Big Data"))
    logs = eod(spark, A, A, B, C).coalesce(1).withColumn("ingest_seq", F.monotonically_increasing_id())
    source = layers.FrameSource({bronze.EOD_TABLE: logs, bronze.LMS_TABLE: lms})
    lazy, full = f"{database}_lazy", f"{database}_full"
    try:
        for name in (lazy, full):
            spark.sql(f"CREATE DATABASE {name}")
        tables = layers.on_demand(spark, source, lazy, 0.5, 4.0)
        assert not spark.catalog.listTables(lazy)
        tables["gold_intern_performance"]
        assert {x.name for x in spark.catalog.listTables(lazy)} == {"gold_intern_performance", "dim_intern", "dim_course"}
        layers.refresh_layers(spark, source, full, full, {bronze.EOD_TABLE: None, bronze.LMS_TABLE: None}, 0.5, 4.0)
        for name, columns in COLUMNS.items():
            rows = [sorted(map(str, frame.select(*columns).collect())) for frame in (tables[name], spark.table(f"{full}.{name}"))]
            assert rows[0] == rows[1] and rows[0], name
    finally:
        for name in (lazy, full):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_arrivals_of_the_stream_are_written_by_many_tasks(spark, monkeypatch):
    """No arrival is drawn together in one task."""
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "coalesce", lambda self, n: 1 / 0)
    with pytest.raises(RuntimeError, match="reached"):
        monkeypatch.setattr(catalogue, "start_bronze", lambda *a: (_ for _ in ()).throw(RuntimeError("reached")))
        catalogue.queries()["r1_bronze_stream"](spark, SAMPLE)


@pytest.fixture
def small(spark):
    """Layers over a few rows: copies of a day, a weekend, unreadable dates, progress without a course."""
    from cohortlake.plans.warehouse import Warehouse

    logs = eod(
        spark, A, A, B, C, ("10/01/2026", "ANN", "Lee", "SQL Revision", "1.5"), ("10/01/2026", "Ann", "Lee", "NumPy Practice", "2"),
        ("bad", "Ann", "Lee", "SQL Revision", "0.75"),
    ).coalesce(1).withColumn("ingest_seq", F.monotonically_increasing_id()).repartition(2)
    lost = ("ann lee", None, None, None, "90%", "completed", None)
    progress = lms_rows(spark, P1, P1, P2, P3, lost).coalesce(1).withColumn("ingest_seq", F.monotonically_increasing_id()).repartition(2)
    return Warehouse.from_raw({bronze.EOD_TABLE: logs, bronze.LMS_TABLE: progress})


def test_hours_are_grouped_once_by_kind_of_day(small):
    from cohortlake.plans import features

    plan = features.domain_hours(small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*\bdate#", plan)
    people = {r["full_name"]: r for r in features.person_features(small).collect()}
    ann, bo = people["Ann Lee"], people["Bo Li"]
    assert (ann["total_hours"], ann["hours_sql"], ann["weekend_hours"], ann["distinct_activities"]) == (9.25, 7.25, 3.5, 2)
    assert (bo["total_hours"], bo["hours_numpy"], bo["weekend_hours"], bo["distinct_activities"]) == (9.0, 0.0, 0.0, 1)


def test_scores_are_grouped_by_person_not_by_course(small):
    from cohortlake.plans import gold

    per_person = gold.lms_by_intern(small)
    plan = per_person._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(intern_id#\d+, course_id#", plan)
    names = {r["intern_id"]: r["full_name"] for r in small["dim_intern"].collect()}
    found = {names[r["intern_id"]]: (r["lms_rows"], r["avg_progress_pct"], r["courses_completed"]) for r in per_person.collect()}
    assert found == {"Ann Lee": (3, 65.0, 3), "Bo Li": (1, 40.0, 0)}


def test_figures_of_a_person_come_from_their_rows_only(small):
    from cohortlake.functions.text import short_id
    from cohortlake.plans import dashboard

    def figures(name):
        return dashboard.kpis_of_intern(small, name)

    assert tuple(figures("Ann Lee").first()) == (1, 9.3, 5, 65.0, 3)
    assert tuple(figures("ann lee").first()) == tuple(figures("No One").first())  # the name as it is written
    key = small["dim_intern"].select(short_id(F.lit("Ann Lee"))).first()[0]
    # People, daily logs and progress rows are each filtered by the id.
    assert figures("Ann Lee")._jdf.queryExecution().optimizedPlan().toString().count(key) >= 3
