"""State of the thinning stream: it ends for curves that are over, and the result stays that of the batch operator."""

from __future__ import annotations

import pytest

from starfold.operators import clean
from starfold.streaming import events

SCHEMA = "id string, t double, m double"


def run(spark, folder, batches, **options):
    """One micro-batch for each table; (rows, state rows after each batch, rows dropped as late)."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        points = events.read_points(spark, f"{folder}/in", SCHEMA)
        query = events.thinned_stream(points, 0.5, **options).writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).format("parquet").start(f"{folder}/out")
        query.awaitTermination()
        found = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        yield found[-1]["numRowsTotal"] if found else 0, sum(x.get("numRowsDroppedByWatermark", 0) for x in found)


def test_state_ends_for_idle_curves(spark, tmp_path):
    first = [("a", 10.0, 1.0), ("a", 10.2, 1.0), ("b", 10.1, 1.0), ("b", 11.0, 1.0)]
    second = [("c", 40.0, 1.0), ("c", 40.1, 1.0), ("c", 40.6, 1.0)]
    third = [("a", 80.0, 1.0), ("a", 80.4, 1.0), ("c", 20.0, 1.0)]
    seen = list(run(spark, tmp_path / "expires", [first, second, third], idle_days=5.0))
    assert seen[0][0] == 2 and seen[-1][0] == 1 and seen[-1][1] == 1
    out = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/expires/out")
    timely = [x for x in first + second + third if x[:2] != ("c", 20.0)]
    expected = clean.thin(spark.createDataFrame(timely, SCHEMA), 0.5, tie=["m"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, expected.select("id", "t", "m").collect()))


def test_state_stays_without_expiry(spark, tmp_path):
    seen = list(run(spark, tmp_path / "stays", [[("a", 1.0, 1.0)], [("b", 400.0, 1.0)]]))
    assert [n for n, _ in seen] == [1, 2]


def test_expiry_below_the_cadence_is_refused(spark, tmp_path):
    points = events.read_points(spark, str(tmp_path), SCHEMA)
    with pytest.raises(ValueError):
        events.thinned_stream(points, 0.5, idle_days=0.1)
