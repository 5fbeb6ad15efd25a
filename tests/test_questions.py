"""Question checks, statements, read-only SQL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortlake.operators.topk import asc
from cohortlake.plans import dashboard, questions


def column(spark, rows, expression):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_deny_list(spark):
    rows = ["please DROP TABLE x", "Update  t", "a -- b", "x /* y", "Ignore Previous", "top interns in SQL", "updates", "a--b"]
    assert column(spark, rows, questions.allowed) == [False] * 5 + [True] * 3


def test_statement(spark):
    rows = [
        "```sql\nSELECT 1;\nSome words; more.\n```",
        "SELECT a;b\nFROM t;; \nOUT_OF_CONTEXT",
        " out_of_context because",
        "SELECT 1\n  OUT_OF_CONTEXT",
        "SELECT 'x;y'",
    ]
    assert column(spark, rows, questions.statement) == ["SELECT 1", "SELECT a;b\nFROM t", None, None, "SELECT 'x;y'"]


@pytest.fixture(scope="module")
def people(spark):
    rows = [("O'Brien", 1.5, [1, 2]), ("Ann", float("nan"), None)]
    return spark.createDataFrame(rows, "full_name string, score double, tags array<int>")


def test_named_argument_and_plain_cells(spark, people):
    views = {"people": people}
    rows = questions.run_sql(spark, "SELECT * FROM people WHERE full_name = :n;", views, {"n": "O'Brien"})
    assert [tuple(r) for r in rows.collect()] == [("O'Brien", 1.5, "[1, 2]")]
    rows = questions.run_sql(spark, "with p as (select * from people) select score from p where full_name = 'Ann'", views)
    assert rows.collect()[0][0] is None


@pytest.mark.parametrize(
    "sql",
    [
        "DROP TABLE people",
        "INSERT INTO people VALUES (1)",
        "WITH p AS (SELECT 1 AS a) INSERT INTO people SELECT * FROM p",
        "SELECT 1) UNION ALL (SELECT 2); DROP VIEW people",
    ],
)
def test_only_queries_run(spark, people, sql):
    people.createOrReplaceTempView("people")
    with pytest.raises(Exception):
        questions.run_sql(spark, sql)
    assert spark.table("people").count() == 2


def test_preview(spark):
    df = spark.range(13).select(F.col("id").alias("n"), F.when(F.col("id") > 0, F.lit("x")).alias("v"))
    lines = [r["line"] for r in questions.preview(df, [asc("n")]).orderBy("line_no").collect()]
    assert lines[:3] == ["n | v", "0 | None", "1 | x"] and lines[-1] == "... and 3 more rows." and len(lines) == 12
    assert questions.preview(df.limit(2), [asc("n")]).count() == 3


def test_course_terms(spark):
    names = ["Basic SQL", "Data Processing using NumPy & Pandas", "Introduction to Data Engineering & Big Data", "100% Go_"]
    df = spark.createDataFrame([(n,) for n in names], "course_name string")

    def about(term):
        return [r[0] for r in df.filter(questions.about_course(term)).collect()]

    assert about("sql") == names[:1] and about("Pandas") == names[1:2]
    assert about("big data") == names[2:3] and about("0%") == names[3:] and about("o_") == names[3:]


def test_week_split_by_months_is_merged(spark):
    weekly = spark.createDataFrame(
        [("A", 2026, 5, 1.0), ("A", 2026, 5, 2.0), ("B", 2026, 6, 4.0)],
        "full_name string, year long, week_number long, total_hours double",
    )
    rows = dashboard.batch_trend({"gold_weekly_hours": weekly}).collect()
    assert [tuple(r) for r in rows] == [("2026-W05", 3.0), ("2026-W06", 4.0)]
    top = dashboard.top_people({"gold_weekly_hours": weekly}, 1).collect()
    assert top[0]["full_name"] == "B"


def test_sql_reaches_neither_the_jvm_nor_files(spark, tmp_path):
    people = spark.createDataFrame([("Ann", 1.0)], "full_name string, score double")
    people.write.parquet(str(tmp_path / "p"))
    for sql in (
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT `java_method` /* x */ ('java.lang.System', 'getProperty', 'user.home')",
        "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
        f"SELECT * FROM parquet.`{tmp_path}/p`",
    ):
        columns, rows, error = questions.answered(spark, sql, {"people_of_test": people})
        assert (columns, rows) == ([], []) and error
    columns, rows, error = questions.answered(spark, "SELECT full_name FROM people_of_test", {"people_of_test": people})
    assert (columns, rows, error) == (["full_name"], [("Ann",)], None)
    assert not spark.catalog.tableExists("people_of_test")


def test_sql_is_judged_by_its_plan(spark, database):
    """Text that hides a call in literals or comments, stored tables, and subqueries over them."""
    people = spark.createDataFrame([("Ann", 1.0), ("Bo", 3.0)], "full_name string, score double")
    people.write.saveAsTable(f"{database}.secret")
    views, before = {"people": people}, dict(spark.sparkContext.getConf().getAll()) | {"f": spark.conf.get("spark.sql.runSQLOnFiles")}
    for sql in (
        "SELECT '/*' AS a, reflect('java.lang.System','getProperty','java.version') AS b, '*/' AS c",
        "SELECT reflect/*/**/*/('java.lang.System','getProperty','java.version')",
        "SELECT 1 WHERE (SELECT reflect('java.lang.System','getProperty','java.version')) > ''",
        f"SELECT * FROM {database}.secret",
        f"SELECT full_name FROM people WHERE score IN (SELECT score FROM {database}.secret)",
        f"WITH s AS (SELECT * FROM {database}.secret) SELECT 1 FROM people WHERE EXISTS (SELECT 1 FROM s)",
        "SELECT input_file_name() FROM people",
        "SELECT current_user()",
    ):
        with pytest.raises(Exception):
            questions.run_sql(spark, sql, views)
    sql = """WITH p AS (SELECT upper(full_name) AS n, score FROM people WHERE score > (SELECT avg(score) FROM people))
        SELECT n, count(*) AS c, sum(score) OVER (PARTITION BY n) AS s, 'reflect(' AS text FROM p, (VALUES (1), (2)) v(x) GROUP BY n, score"""
    assert [tuple(r) for r in questions.run_sql(spark, sql, views).collect()] == [("BO", 2, 3.0, "reflect(")]
    assert dict(spark.sparkContext.getConf().getAll()) | {"f": spark.conf.get("spark.sql.runSQLOnFiles")} == before
    assert not [t for t in spark.catalog.listTables("global_temp") if t.namespace == ["global_temp"]]
