"""Streams of photometry: the batch operators' stateful counterparts on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from starfold.operators.clean import thinned_rows


def read_points(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 10) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(points: DataFrame, late: str = "7 days", width: str = "1 day") -> DataFrame:
    """Counts and mean magnitudes of bands by event-time window; later points than ``late`` are left out."""
    return points.withWatermark("ts", late).groupBy(F.window("ts", width), "band").agg(F.count(F.lit(1)).alias("n"), F.avg("m").alias("mean_m"))


def thinned_stream(points: DataFrame, cadence_days: float, idle_days: float | None = None, late_days: float = 0.0, tie: Sequence[str] = ()) -> DataFrame:
    """Greedy thinning of (id, t, m), t in days since 1970: the state of a curve is the time of the last point that stayed.

    Points of one micro-batch are put in time order, those of one time in the order of the columns ``tie``, then of m.  A point that comes in a later one but is not after the last point that stayed is
    left out, as are points without a time: nothing that was given out is taken back.

    With ``idle_days``, of the cadence or more, the state of a curve ends when the stream's time, ``late_days`` behind the latest point, has gone
    that far beyond the curve's last point, so that curves that are over cost nothing.  A point of such a curve that comes after all begins anew; as it lies
    more than the cadence later, the result is the same.  Points behind the stream's time are left out; the query's progress counts them (rows
    dropped by watermark).
    """
    if idle_days is not None and idle_days < cadence_days:
        raise ValueError("a curve may be given up after the cadence, not before")
    expires = idle_days is not None
    milli = 86_400_000.0

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        # one frame: batches of a key may come in any order
        held = list(frames)
        if held:
            frame = pd.concat(held)[["id", "t", "m", *tie]]
            frame = frame.sort_values(["t", *tie, "m"], kind="stable")
            t = frame["t"].to_numpy(dtype=float)
            rows = thinned_rows(t, cadence_days, last)
            last = float(t[rows[-1]]) if rows else last
            yield frame[["id", "t", "m"]].iloc[rows]
        if last is not None:
            state.update((last,))
            if expires:
                state.setTimeoutTimestamp(max(int((last + idle_days) * milli), state.getCurrentWatermarkMs() + 1))

    rows = points.select("id", "t", "m", *tie).filter(F.abs("t") < float("inf"))
    kind = dict(points.dtypes)["id"]
    timeout = GroupStateTimeout.NoTimeout
    if expires:
        rows = rows.withColumn("ts", F.timestamp_millis((F.col("t") * milli).cast("long"))).withWatermark("ts", f"{int(late_days * 86_400)} seconds")
        timeout = GroupStateTimeout.EventTimeTimeout
    return rows.groupBy("id").applyInPandasWithState(keep, f"id {kind}, t double, m double", "last double", "append", timeout)
