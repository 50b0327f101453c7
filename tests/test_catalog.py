"""Every registered query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from cardmill.plans import catalog


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in os.listdir(small):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{small}/{t}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, small, duck, name):
    df = catalog.QUERIES[name](spark, small)
    cursor = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    assert sorted(names) == sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in rows), key=repr)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_rows_only(spark, small, name):
    assert catalog.QUERIES[name](spark, small).count() > 0
