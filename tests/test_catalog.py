"""Every query runs; those with SQL give its rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from millrace import catalog

TABLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    if not TABLES.is_dir():
        pytest.skip("no test tables")
    con = duckdb.connect()
    for p in TABLES.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


def plain(rows, names):
    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return repr(float(v)) if isinstance(v, float) else str(v)

    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, str(TABLES))
    rows = df.collect()
    if name not in catalog.SQL:
        assert rows
        return
    cursor = duck.execute(catalog.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(rows, df.columns) == plain(cursor.fetchall(), names)
