"""Operators against brute force, also where one key owns a third of the rows."""

from __future__ import annotations

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cohortlake.operators.cleaning import clean_eod, clean_lms, explode_mentors
from cohortlake.operators.dedup import keep_first, new_rows, new_rows_by_key, row_key
from cohortlake.operators.dense_id import with_dense_id, with_running_total
from cohortlake.operators.quantiles import box_stats, exact_medians, histogram
from cohortlake.operators.skew import join_one_per_key
from cohortlake.schemas import SEQ
from cohortlake.sources.bindings import lms_from_orders


def hot(n=3000, seed=1):
    """(key, seq, value): key 0 owns a third of the rows, and a third of the values are 0."""
    rng = random.Random(seed)
    return [
        (0 if i % 3 == 0 else rng.randrange(1, 50), i, 0.0 if i % 3 == 1 else rng.random())
        for i in range(n)
    ]


def test_keep_first(spark):
    rows = hot()
    df = spark.createDataFrame(rows, "k int, seq long, v double").repartition(5)
    got = {r["k"]: r["v"] for r in keep_first(df, ["k"], ["seq"], ["v"]).collect()}
    want = {}
    for k, _, v in rows:
        want.setdefault(k, v)
    assert got == want


def test_dense_id_with_gaps_and_prefix(spark):
    rows = [(s % 2, s * 7 + (10**9 if s > 50 else 0)) for s in range(100)]
    df = spark.createDataFrame(rows, "p int, s long").repartition(4)
    for bits in (2, 18):
        got = {(r["p"], r["s"]): r["id"] for r in with_dense_id(df, ["p", "s"], "id", bits).collect()}
        assert got == {row: i for i, row in enumerate(sorted(rows))}


def test_running_total(spark):
    rows = [(x / 7, x % 5) for x in range(200)]
    df = spark.createDataFrame(rows, "v double, n long").repartition(3)
    got = {r["v"]: r["before"] for r in with_running_total(df, ["v"], "n", "before").collect()}
    total = 0
    for v, n in sorted(rows):
        assert got[v] == total
        total += n


def test_medians_with_a_frequent_value(spark):
    rows = hot(1001) + [(1, -1, None)]
    df = spark.createDataFrame(rows, "k int, seq long, v double")
    got = {r["feature"]: r["median"] for r in exact_medians(df, ["k", "v"]).collect()}
    assert got == {
        "k": statistics.median(r[0] for r in rows),
        "v": statistics.median(r[2] for r in rows if r[2] is not None),
    }


def test_medians_make_their_columns_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(v):
        made.add(1)
        return v * 2

    df = spark.range(500).select(F.udf(counted, "double")(F.col("id").cast("double")).alias("v"))
    assert exact_medians(df, ["v"]).first()["median"] == 499.0
    assert made.value == 500


def test_lines_of_an_order_meet_before_sets_are_made(spark, tmp_path):
    """Plain rows are shuffled by order, not sets of one name; lines without an order belong to none."""
    tables = {
        "lineitem": ([(5, 7, "F", "R", 2.0), (5, 7, "O", "A", 3.0), (5, 8, "F", "N", 1.0), (None, 8, "F", "N", 9.0)],
                     "l_orderkey long, l_suppkey long, l_linestatus string, l_returnflag string, l_quantity double"),
        "supplier": ([(7, "S#7"), (8, "S#8")], "s_suppkey long, s_name string"),
        "orders": ([(5, 5, "F", datetime.datetime(1995, 1, 2), "2-HIGH"), (8, 5, "F", datetime.datetime(1995, 1, 2), "2-HIGH")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(5, "Customer#5")], "c_custkey long, c_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = lms_from_orders(spark, str(tmp_path))
    got = {r[SEQ]: (r["Mentor Name"], r["Overall Knowledge Check"], r["Completed Assignment"]) for r in found.collect()}
    assert got == {5: ("S#7, S#8", "6/150", "2/3"), 8: (None, "0/0", "0/0")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("partial_collect_set") < plan.rindex("Exchange hashpartitioning(l_orderkey")


def test_box_and_histogram(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4, 10)] + [("b", None)], "g string, v long")
    row = box_stats(df, "g", "v").collect()
    assert [tuple(r) for r in row] == [("a", 5, 1.0, 2.0, 3.0, 4.0, 10.0, -1.0, 7.0)]
    bins = {r["bin"]: r["entry_count"] for r in histogram(df, "v", 3).collect()}
    assert bins == {1: 3, 2: 1, 3: 1}
    flat = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert [tuple(r) for r in histogram(flat, "v").collect()] == [(1, 4)]


def test_new_rows(spark):
    target = spark.createDataFrame([(1, None)], "a int, b string")
    staging = spark.createDataFrame([(1, None), (1, None), (2, "a"), (3, "b"), (3, "b")], "a int, b string")
    want = [(2, "a"), (3, "b")]
    assert sorted(tuple(r) for r in new_rows(staging, target).collect()) == want
    keyed = target.withColumn("key", row_key(["a", "b"]))
    got = new_rows_by_key(staging, keyed, ["a", "b"], "key").select("a", "b").collect()
    assert sorted(tuple(r) for r in got) == want


def test_row_key_keeps_columns_apart(spark):
    rows = [("a", None), (None, "a"), ("", "a"), ("a", ""), ('a","b":"', "c"), ("a", 'b":"c')]
    df = spark.createDataFrame(rows, "a string, b string").select(row_key(["a", "b"]).alias("k"))
    assert df.distinct().count() == len(rows)


def test_mentors(spark):
    rows = [("U One", "a, b,,c "), ("U One", "a,a"), ("U Two", None), ("U Two", " , ")]
    raw = spark.createDataFrame(rows, "`User Name` string, `Mentor Name` string")
    got = explode_mentors(clean_lms(raw, "Course"))
    assert sorted(r["mentor_name"] for r in got.collect()) == ["a", "b", "c"]


def test_missing_columns_become_null(spark):
    raw = spark.createDataFrame([("Ann Lee",)], "`User Name` string")
    row = clean_lms(raw, "Course").first()
    assert (row["full_name"], row["course_name"], row["kc_pct"], row["progress_pct"]) == ("Ann Lee", "Course", None, 0)
    eod = spark.createDataFrame([("Ann", "Lee", 2.5), ("Ann", None, float("nan"))], "`First Name` string, `Last Name` string, Hours double")
    assert [(r["full_name"], r["hours"]) for r in clean_eod(eod).collect()] == [("Ann Lee", 2.5), ("Ann", None)]


def test_frequent_key_is_split_by_adaptive_execution(spark):
    """The helper's join is cut into pieces where a plain join with an aggregated side is not."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        many = spark.createDataFrame(hot(30000), "k int, seq long, v double").repartition(6)
        one = many.groupBy("k").agg(F.max("seq").alias("last"))

        def run(joined):
            assert len(joined.collect()) == 30000
            return "skewed" in joined._jdf.queryExecution().executedPlan().toString()

        assert run(join_one_per_key(many, one, "k"))
        assert not run(many.join(one, "k"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("parts", [1, 7])
def test_results_do_not_depend_on_partitioning(spark, parts):
    from cohortlake.plans import gold

    fact = spark.createDataFrame(
        [(f"p{i % 9 if i % 3 else 0}", None, f"a{i % 4}", i / 7) for i in range(900)],
        "intern_id string, date date, activity_id string, hours double",
    )
    got = gold.eod_by_intern({"fact_eod_log": fact.repartition(parts)})
    want = gold.eod_by_intern({"fact_eod_log": fact.coalesce(1)})
    assert sorted(got.collect()) == sorted(want.collect())
