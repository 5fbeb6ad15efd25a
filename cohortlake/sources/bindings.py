"""The sample tables seen as raw exports.

The sample data are orders and events, not learner logs. These views give every event
the form of a daily log row and every order the form of a progress row, so that all
jobs can run over whole tables. Spoiled cells (blank, misspelt, unreadable) are put in
by fixed rules on the row key; no row is left out by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lookups import ACTIVITY_CATEGORIES
from ..schemas import SEQ

# Outlier bounds that fit the sample values, which are not working hours.
SAMPLE_LOW, SAMPLE_HIGH = 2.0, 60.0


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _every(key: Column, n: int, at: int) -> Column:
    return (key % n) == at


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of files."""
    schema = _read(spark, folder, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(folder)


def eod_from_events(
    spark: SparkSession, folder: str, events: DataFrame | None = None
) -> DataFrame:
    """One daily log row per event."""
    events = _read(spark, folder, "events") if events is None else events
    people = _read(spark, folder, "customer").select("c_custkey", "c_name")
    k = F.col("event_id")
    first = F.split("c_name", "#")[0]
    last = F.split("c_name", "#")[1]
    names = [F.lit(n) for n in (*ACTIVITY_CATEGORIES, "Team Meeting")]
    activity = F.get(F.array(*names), (k % len(names)).cast("int"))
    day = F.col("ts")
    return (
        events.join(people, F.col("user_id") == F.col("c_custkey"), "left")
        .select(
            F.when(_every(k, 97, 5), "31/02/2024")
            .when(_every(k, 89, 3), F.date_format(day, "yyyy-MM-dd"))
            .when(_every(k, 83, 2), F.lit(None))
            .when(_every(k, 7, 1), F.date_format(day, "d/M/yyyy"))
            .otherwise(F.date_format(day, "dd/MM/yyyy"))
            .alias("Date"),
            F.when(_every(k, 211, 9), F.lit(None))
            .when(_every(k, 5, 2), F.concat(F.lit("  "), first, F.lit("\t")))
            .when(_every(k, 11, 4), F.upper(first))
            .otherwise(first)
            .alias("First Name"),
            F.when(_every(k, 211, 9), F.lit(None)).otherwise(last).alias("Last Name"),
            F.when(_every(k, 101, 8), F.lit(None))
            .when(_every(k, 103, 6), F.lit("  "))
            .when(_every(k, 17, 3), F.lower(activity))
            .when(_every(k, 6, 5), F.concat(F.lit(" "), activity, F.lit(" ")))
            .otherwise(activity)
            .alias("Activity"),
            F.when(_every(k, 79, 1), "abc")
            .when(_every(k, 73, 2), "1d")
            .when(_every(k, 71, 3), "NaN")
            .when(_every(k, 67, 4), F.lit(None))
            .when(_every(k, 61, 5), F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
            .otherwise(F.col("value").cast("string"))
            .alias("Hours"),
            k.alias(SEQ),
        )
    )


# Order priority of the sample to course key.
PRIORITY_COURSES = {
    "1-URGENT": "python",
    "2-HIGH": "sql",
    "3-MEDIUM": "numpy_pandas",
    "4-NOT SPECIFIED": "pyspark",
    "5-LOW": "big_data",
}


def lms_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One progress row per order; an order without line items has nothing out of nothing."""
    items = _read(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linestatus", "l_returnflag", "l_quantity"
    )
    suppliers = _read(spark, folder, "supplier").select("s_suppkey", "s_name")

    def having(column: str, value: str) -> Column:
        return F.sum((F.col(column) == value).cast("bigint"))

    # The mentors of a row are all suppliers of its lines. An order's few lines lie apart, so sets made of
    # them in the map tasks would hold one name each: the lines are brought together as plain rows first.
    per_order = (
        items.where(F.col("l_orderkey").isNotNull())
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            having("l_linestatus", "F").alias("done"),
            having("l_returnflag", "R").alias("passed"),
            having("l_returnflag", "A").alias("reviewed"),
            having("l_returnflag", "N").alias("pending"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.array_join(F.array_sort(F.collect_set("s_name")), ", ").alias("mentors"),
        )
    )
    orders = _read(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    people = _read(spark, folder, "customer").select("c_custkey", "c_name")
    rows = (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
        .fillna(0, ["n", "done", "passed", "reviewed", "pending", "quantity"])
    )
    k, n, status = F.col("o_orderkey"), F.col("n"), F.col("o_orderstatus")
    name = F.replace(F.col("c_name"), F.lit("#"), F.lit(" "))
    start, end = F.col("o_orderdate"), F.date_add("o_orderdate", 90)
    lines = F.greatest(n, F.lit(1))
    whole = F.floor(F.col("done") * 100 / lines)
    tenth = F.floor(F.col("done") * 1000 / lines) % 10
    key = F.lit(None).cast("string")
    for priority, course in PRIORITY_COURSES.items():
        key = F.when(F.col("o_orderpriority") == priority, course).otherwise(key)

    def out_of(part: str) -> Column:
        return F.concat_ws("/", F.col(part), n)

    return rows.select(
        F.when(_every(k, 199, 4), F.lit(None))
        .when(_every(k, 13, 6), F.upper(name))
        .when(_every(k, 10, 3), F.concat(F.lit(" "), name, F.lit(" ")))
        .otherwise(name)
        .alias("User Name"),
        F.lit(" Introduction to Data Engineering & Big Data ").alias("Course Name"),
        F.when(_every(k, 53, 1), "soon")
        .when(_every(k, 3, 1), F.date_format(start, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(start, "yyyy-MM-dd"))
        .alias("Start Date"),
        F.when(_every(k, 47, 1), F.lit(None))
        .when(_every(k, 4, 2), F.date_format(end, "M/d/yyyy"))
        .otherwise(F.date_format(end, "yyyy-MM-dd"))
        .alias("End Date"),
        F.when(_every(k, 19, 7), F.lit(None))
        .when(_every(k, 31, 2), F.concat(F.lit(","), F.lower("mentors"), F.lit(" , ")))
        .otherwise(F.col("mentors"))
        .alias("Mentor Name"),
        F.when(_every(k, 43, 1), "n/a")
        .when(_every(k, 41, 1), F.lit(None))
        .when(_every(k, 9, 4), F.concat(F.lit(" "), whole.cast("string"), F.lit(" %")))
        .otherwise(F.concat(whole.cast("string"), F.lit("."), tenth.cast("string"), F.lit("%")))
        .alias("Progress (%)"),
        F.when(_every(k, 37, 1), F.concat(F.col("done").cast("string"), F.lit(" / 0")))
        .when(_every(k, 29, 1), F.col("done").cast("string"))
        .otherwise(out_of("done"))
        .alias("Completed Assignment"),
        out_of("reviewed").alias("Reviewed / Submitted"),
        F.when(_every(k, 59, 1), "1.2.3/4")
        .when(_every(k, 23, 1), F.lit(None))
        .otherwise(F.concat_ws("/", F.col("quantity"), (n * 50)))
        .alias("Overall Knowledge Check"),
        F.when(status == "O", "-").otherwise(out_of("passed")).alias("Overall Test"),
        out_of("pending").alias("Reviewed / Total Assignments"),
        F.when(_every(k, 27, 1), "paused")
        .when(status == "F", " Completed ")
        .when(status == "P", "in progress")
        .when(status == "O", "NOT STARTED")
        .alias("Overall Status"),
        key.alias("course_key"),
        k.alias(SEQ),
    )


def questions_from_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """User turns as questions; fixed conversations get forbidden words appended."""
    turns = _read(spark, folder, "conversations").filter(F.col("role") == "user")
    seeded = F.when(
        _every(F.col("conv_id"), 7, 0), F.concat("text", F.lit(" DROP TABLE x"))
    ).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", seeded.alias("question"))


def answers_from_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Questions dressed as generated answers: fenced, with text after, or declined."""
    rows = questions_from_conversations(spark, folder)
    q, k = F.replace(F.col("question"), F.lit(";"), F.lit(",")), F.col("conv_id")
    answer = (
        F.when(_every(k, 4, 0), F.concat(F.lit("```sql\nSELECT '"), q, F.lit("';;  \nThis counts; all.\n```")))
        .when(_every(k, 4, 1), F.concat(F.lit("  out_of_context: "), q))
        .when(_every(k, 4, 2), F.concat(F.lit("SELECT 1;\nOUT_OF_CONTEXT "), q))
        .otherwise(q)
    )
    return rows.select("conv_id", "turn", answer.alias("answer"))
