"""Of a curve's points of one time the stream keeps the one that its SQL keeps."""

from __future__ import annotations

import duckdb

from starfold.plans.catalogue import ORACLES, QUERIES


def test_equal_times(spark, tmp_path):
    con = duckdb.connect()
    # two events of each user and half day: the later event has the smaller magnitude, or the larger one
    con.execute(f"""copy (select range as event_id, timestamp '2024-01-01' + to_hours((12 * (range // 6))::int) as ts, range % 3 as user_id, 'view' as event_type,
 case when range % 2 = 0 then 10.0 + range else 500.0 - range end::double as value, '{{"k": 1}}' as props from range(0, 120)) to '{tmp_path}/events.parquet'""")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    theirs = sorted(con.execute(ORACLES["event_stream"]).fetchall())
    assert len(theirs) == 60
    assert sorted(map(tuple, QUERIES["event_stream"](spark, str(tmp_path)).collect())) == theirs
