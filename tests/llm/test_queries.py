"""Queries over the sample tables against SQL, or against the whole result made another way."""

from __future__ import annotations

import math

import duckdb
import pytest

from cohortlake.llm import queries

SAMPLE = "/root/testdata/sf0.001"

QUERIES, SQL = queries.queries(), queries.oracle_sql()


def plain(v):
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{SAMPLE}/{table}.parquet'")
    df = QUERIES[name](spark, SAMPLE)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([plain(r[names.index(c)]) for c in df.columns]) for r in cursor.fetchall())
    assert sorted(repr([plain(v) for v in r]) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_topk"}))
def test_one_row_each(spark, name):
    source = {"op1_urls": "pages", "op2_embeddings": "embeddings"}.get(name, "documents")
    assert QUERIES[name](spark, SAMPLE).count() == spark.read.parquet(f"{SAMPLE}/{source}.parquet").count()
