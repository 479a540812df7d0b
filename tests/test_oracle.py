"""Every registered query against its DuckDB oracle on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from comptoir.fixtures import DRIVER_TABLES
from comptoir.suite import collect
from tools.check import rows_key

SF = os.environ.get("COMPTOIR_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLE = collect()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_key(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_key(cols, cur.fetchall())


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.count() >= 0 and out.columns == ["classe", "n_rows"]
