"""The driver contract: every registered query against its DuckDB twin
(sf0.001 here; the driver runs sf0.01), the flagship entry, and the
streaming month load."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from tripmart.plans import registry

from .conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle_but_the_estimate():
    # (queries of the optional subpackage are tested beside it)
    assert set(registry.queries()) - set(E.oracle_sql()) == {"column_profile_approx"}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["payment_type", "yoy_revenue"] and len(rows) > 0


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, con, key):
    df = E.queries()[key](spark, SF001)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(cols, rows) == _canon(dcols, drows)
