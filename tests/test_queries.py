"""Every registered query with an SQL twin gives the twin's rows."""

import glob
import os

import duckdb
import pytest

from lexforge.plans import registry

DATA = "/root/testdata/sf0.001"


def plain(rows):
    return sorted((tuple(round(float(x), 6) if isinstance(x, float) or type(x).__name__ == "Decimal" else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f).removesuffix('.parquet')} AS SELECT * FROM '{f}'")
    got, want = registry.queries()[name](spark, DATA), con.sql(registry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert plain(tuple(r[c] for c in columns) for r in got.collect()) == plain(tuple(r[i] for i in at) for r in want.fetchall())


def test_other_queries_run(spark):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, DATA).count() > 0
