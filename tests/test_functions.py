"""Edge rows of the cleaning expressions."""

from __future__ import annotations

import datetime
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlake.functions import dates, lookups, numbers, text

D = datetime.date


def values(spark, rows, expression, schema="x string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_ids(spark):
    got = values(spark, ["  John Doe ", "\tJohn Doe\n", "JOHN DOE", None, ""], text.short_id)
    assert got == ["94890005f3"] * 3 + ["e3b0c44298"] * 2


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" \t 　aBÉß'x", max_size=8), min_size=1, max_size=30))
def test_ids_equal_python(spark, names):
    want = [hashlib.sha256(n.strip().lower().encode()).hexdigest()[:10] for n in names]
    assert values(spark, names, text.short_id) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("3/3", (3.0, 3.0, 100.0)),
        ("443/470", (443.0, 470.0, 443 / 470 * 100)),
        ("12 / 0", (12.0, 0.0, None)),
        ("7", (7.0, None, None)),
        (" 2.5/ 5 ", (2.5, 5.0, 50.0)),
        *[(v, (None, None, None)) for v in ("-", "", "nan", None, "abc", "1.2.3/4", "inf", "-1/2")],
    ],
)
def test_fraction(spark, value, want):
    assert tuple(values(spark, [value], numbers.parse_fraction)[0]) == want


def test_eod_date(spark):
    rows = ["1/2/2026", "05/01/2026", "31/02/2026", "2026-02-01", "01/02/26", "nan", None, "001/2/2026"]
    assert values(spark, rows, dates.parse_eod_date) == [D(2026, 2, 1), D(2026, 1, 5)] + [None] * 6


def test_course_date(spark):
    rows = ["2026-01-05", "2026-1-5 10:20:30", "2026-01-05T10:20:30", "2026/1/5", "1/5/2026", "5/18/2001", "soon", "", None]
    day, moment = datetime.datetime(2026, 1, 5), datetime.datetime(2026, 1, 5, 10, 20, 30)
    want = [day, moment, moment, day, day, datetime.datetime(2001, 5, 18), None, None, None]
    assert values(spark, rows, dates.parse_course_date) == want


def test_hours_and_flag(spark):
    rows = ["0.5", "4.0", "0.49", "4.01", None, "abc", "nan", "1d", "1_000", "inf", " 2 ", "1e1", "1e999"]
    hours = values(spark, rows, numbers.parse_number)
    assert hours == [0.5, 4.0, 0.49, 4.01] + [None] * 6 + [2.0, 10.0, None]
    flags = values(spark, rows, lambda c: numbers.outlier_flag(numbers.parse_number(c), 0.5, 4.0))
    assert flags == [0, 0, 1, 1] + [0] * 7 + [1, 0]


def test_percent(spark):
    rows = ["87.9%", " 45 %", "100", None, "n/a", "-3.9%"]
    assert values(spark, rows, numbers.parse_percent) == [87, 45, 100, 0, 0, -3]


def test_status_and_category(spark):
    got = values(spark, [" COMPLETED ", "in progress", "Not Started", "paused", None], lookups.status)
    assert got == ["Completed", "In Progress", "Not Started", "Unknown", "Unknown"]
    got = values(spark, ["PL/SQL Concepts", "Pandas Practice", "pandas practice", None], lookups.activity_category)
    assert got == ["SQL", "NumPy/Pandas", "Other", "Other"]


def test_name_parts(spark):
    rows = ["Mary Ann  Lee", "Cher", " Bo  Li "]
    assert values(spark, rows, text.first_name) == ["Mary", "Cher", "Bo"]
    assert values(spark, rows, text.last_name) == ["Ann Lee", "", "Li"]


def test_calendar(spark):
    rows = [D(2025, 12, 29), D(2027, 1, 1)]
    assert values(spark, rows, dates.year, "x date") == [2025, 2027]
    assert values(spark, rows, dates.iso_week, "x date") == [1, 53]
    assert values(spark, rows, dates.day_name, "x date") == ["Monday", "Friday"]
    label = values(spark, [5], lambda c: dates.week_label(F.lit(2026), c), "x int")
    assert label == ["2026-W05"]


def test_rounding(spark):
    rows = [0.25, 1.005, 2.5, -0.25, None]
    assert values(spark, rows, lambda c: numbers.round_half_away(c, 1), "x double") == [0.3, 1.0, 2.5, -0.3, None]
    assert values(spark, rows, lambda c: numbers.round_half_even(c, 1), "x double") == [0.2, 1.0, 2.5, -0.2, None]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=200))
def test_sum_does_not_depend_on_order(spark, xs):
    import math

    def total(rows, parts):
        df = spark.createDataFrame([(x,) for x in rows], "x double").repartition(parts)
        return df.agg(numbers.stable_sum(F.col("x"))).first()[0]

    one, two = total(xs, 1), total(xs[::-1], 3)
    assert one == pytest.approx(math.fsum(xs), rel=1e-15, abs=1e-12)
    assert one == pytest.approx(two, rel=1e-15, abs=1e-15)


def test_sums_of_all_scales_are_exact(spark):
    """Against sums of fractions, in one pass and through stored parts; signs cancel, values of 1e-12 stand beside 1e14."""
    import random
    from fractions import Fraction

    rnd = random.Random(3)
    rows, want = [], {}
    for g in range(120):
        scale = rnd.choice([0, 10, -40, -60, -100, 40, 55, 61])
        xs = [rnd.choice([-1, 1]) * rnd.random() * 2.0 ** (scale - rnd.randrange(30)) for _ in range(rnd.randrange(20))]
        xs += [-x for x in xs[1:]] if rnd.random() < 0.3 else []
        xs += [1e14, 1e-12, 4e-10] if rnd.random() < 0.3 else []
        want[g] = float(sum(map(Fraction, xs), Fraction(0))) if xs else None
        rows += [(g, x) for x in xs] or [(g, None)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double")
    assert {r[0]: r[1] for r in df.groupBy("g").agg(numbers.stable_sum("x")).collect()} == want
    parts = df.groupBy("g", F.pmod(F.xxhash64("x"), F.lit(3)).alias("part")).agg(*numbers.sum_parts("x", "x"))
    assert {r[0]: r[1] for r in parts.groupBy("g").agg(numbers.summed_parts("x")).collect()} == want
    tiny = spark.createDataFrame([(4e-10,)] * 1000, "x double")
    assert tiny.agg(numbers.stable_sum("x")).first()[0] == float(1000 * Fraction(4e-10))
