"""Every query of the subpackage that has an SQL twin gives the twin's rows."""

import glob
import os

import duckdb
import pytest

from lexforge.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f).removesuffix('.parquet')} AS SELECT * FROM '{f}'")
    got, want = queries.queries()[name](spark, DATA), con.sql(queries.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
