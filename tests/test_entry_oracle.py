"""Driver contract: entry() smoke run, and every registered query against its
DuckDB oracle on the smallest supplied tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from basketry.plans.catalog import REGISTRY
from basketry.plans.views import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple("" if x is None else x for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["day", "gmv", "n_orders", "gmv_7d", "orders_7d", "aov_7d"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_against_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert rows is not None
        return
    cur = con.execute(sql)
    dcols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, rows) == _rows(dcols, cur.fetchall())
