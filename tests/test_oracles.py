"""Every registered query against its DuckDB oracle at sf0.001 (row count,
column names, values rounded to 6 decimals); queries without an oracle must
run and return rows."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import QUERIES
from tessera.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    oracle = E.oracle_sql().get(name)
    if oracle is None:
        assert len(got) > 0
        return
    cur = duck.execute(oracle)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(got, df.columns) == _rows(want, cols)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "avg_days_up_user", "avg_times_up_user", "n_user_items"]
    assert df.count() > 0
