"""Every query with a SQL statement gives the statement's rows."""

from __future__ import annotations

import datetime
import math
import os

import pytest

import __spark_entry__ as entry
from conftest import SAMPLE

duckdb = pytest.importorskip("duckdb")

QUERIES, STATEMENTS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in os.listdir(SAMPLE):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SAMPLE}/{file}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SAMPLE)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = db.execute(STATEMENTS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
