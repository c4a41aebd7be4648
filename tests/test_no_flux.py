"""Points of no flux, whose magnitude is infinite in SQL, and magnitudes on the edge of a bin."""

from __future__ import annotations

import datetime
import glob
import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from starfold.plans.catalogue import ORACLES, QUERIES
from starfold.plans.roles import series

NAMES = ["aov_small", "bls", "ce_small", "chunked_features", "detrend", "dmdt", "event_stream", "fpw", "ls_small", "nest_lightcurves", "pair_time_features", "prepare_bands", "prepare_curves", "stats_basic", "waiting_features", "windowed_counts"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Curves of 70 events; some hold one without flux, first, last or in between."""
    rng, path = random.Random(3), str(tmp_path_factory.mktemp("no_flux"))
    begin = datetime.datetime(2024, 1, 1)
    rows = []
    for user in range(6):
        for i in range(70):
            value = 0.0 if (user, i) in {(1, 0), (2, 69), (3, 30)} else round(rng.uniform(0.5, 200), 2)
            rows.append((len(rows), begin + datetime.timedelta(seconds=i * 40_000 + rng.randrange(30_000)), user, ["view", "click"][i % 2], value, f'{{"k": {i}}}'))
    con = duckdb.connect()
    con.execute("create table events (event_id bigint, ts timestamp, user_id bigint, event_type varchar, value double, props varchar)")
    con.executemany("insert into events values (?, ?, ?, ?, ?, ?)", rows)
    con.execute(f"copy events to '{path}/events.parquet'")
    return path


def plain(x):
    return "NULL" if x is None else "NaN" if isinstance(x, float) and math.isnan(x) else x


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, folder, name):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    ours = QUERIES[name](spark, folder)
    theirs = con.execute(f"select {', '.join(ours.columns)} from ({ORACLES[name]})").fetchall()
    a, b = (sorted((tuple(map(plain, r)) for r in rows), key=str) for rows in (map(tuple, ours.collect()), theirs))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-6, abs_tol=2e-5)) for p, q in zip(x, y)), (x, y)


def test_magnitudes_to_the_last_bit(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"copy (select range as event_id, timestamp '2024-01-01' as ts, 1::bigint as user_id, 'a' as event_type, range / 100.0::double as value, '{{\"k\": 1}}' as props from range(0, 50000)) to '{tmp_path}/events.parquet'")
    theirs = dict(con.execute(f"select event_id, -2.5 * log10(value) + 31.4 from '{tmp_path}/events.parquet'").fetchall())
    ours = {r["event_id"]: r["m"] for r in series(spark, str(tmp_path)).select("event_id", F.col("m")).collect()}
    assert ours == theirs
