"""Every registered query vs its DuckDB oracle at sf0.001 (the driver's gate)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return f"D{v}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _library(names) -> set[str]:
    """Without the queries of the optional training-data package, which has its own tests."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert _library(E.queries()) == _library(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(_library(E.oracle_sql())))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(names, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["order_status", "order_count", "total_revenue"]
    assert sum(r["order_count"] for r in rows) == 6000
    assert os.path.exists(SF_SMALL)
