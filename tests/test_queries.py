"""Every query with SQL gives what DuckDB gives, at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from loomwork import queries as core

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def normal(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(normal, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, name):
    df = entry.queries()[name](spark, DATA)
    rows = df.collect()
    if name in core.ORACLE:
        db = duckdb.connect()
        for f in os.listdir(DATA):
            db.sql(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
        got = db.sql(core.ORACLE[name])
        columns = [c[0] for c in got.description]
        assert sorted(columns) == sorted(df.columns)
        want = sorted((tuple(normal(x) for x in r) for r in got.fetchall()), key=str)
        assert sorted((tuple(normal(r[c]) for c in columns) for r in rows), key=str) == want
    else:
        assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
