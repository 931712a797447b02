"""Every labeling query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from takepick import file_queries, queries

SF = "/root/testdata/sf0.001"
MADE = {**queries.queries(), **file_queries.queries()}
SQL = {**queries.oracle_sql(), **file_queries.oracle_sql()}


def test_every_query_has_sql():
    assert set(MADE) == set(SQL)


@pytest.mark.parametrize("name", sorted(MADE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    df = MADE[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
