"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_TINY
from daybook.plans import catalog

TABLES = ["events", "lineitem", "orders"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (4, int(v))
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return (1, float(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (6, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_TINY, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_TINY)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(catalog.ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            if isinstance(x[1], float) and isinstance(y[1], float):
                assert math.isclose(x[1], y[1], rel_tol=1e-9, abs_tol=1e-9), (name, a, b)
            else:
                assert x == y, (name, a, b)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["dt_year", "dt_month", "dt_day"]
