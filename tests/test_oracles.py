"""Every query that has an oracle against DuckDB at the smallest scale, and the rest for rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from starfold.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(x):
    if x is None or (not isinstance(x, (list, str)) and pd.isna(x)):
        return None
    if isinstance(x, bool) or type(x).__name__.startswith("bool"):
        return bool(x)
    return round(float(x), 9) if isinstance(x, (int, float)) or hasattr(x, "dtype") else x


def rows(frame):
    return sorted((tuple(plain(x) for x in r) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    a, b = rows(ours), rows(theirs)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-6, abs_tol=2e-5)) for p, q in zip(x, y)), (x, y)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).limit(5).count() > 0
