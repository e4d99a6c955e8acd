"""The driver contract, and every query key against its DuckDB oracle on
the smallest driver tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from weir.sources.tables import TABLES, table_path
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "country", "category", "events_total", "purchases", "revenue",
                          "unique_users", "revenue_7d"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_key_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, cur.fetchall())
