"""Photometry cleaning: flags, bands, time limits, cadence thinning, minimum counts."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.functions.photometry import flag_sum, magnitude, magnitude_error


def unflagged(points: DataFrame, flag: str = "catflags") -> DataFrame:
    return points.filter(F.col(flag) == 0)


def with_flags(points: DataFrame, columns: Iterable[str], out: str = "pixel_flags") -> DataFrame:
    return points.withColumn(out, flag_sum(*[F.col(c) for c in columns]))


def positive_flux(points: DataFrame, flux: str = "flux", error: str = "flux_err") -> DataFrame:
    return points.filter((F.col(flux) > 0) & (F.col(error) > 0))


def in_bands(points: DataFrame, bands: Iterable[str] | None, band: str = "band") -> DataFrame:
    """No bands given: all."""
    return points.filter(F.col(band).isin(*bands)) if bands else points


def up_to(points: DataFrame, limit: float | None, t: str = "t") -> DataFrame:
    """Points (not whole curves) up to a time, which has to be positive."""
    return points if limit is None else points.filter((F.col(t) > 0) & (F.col(t) <= limit))


def with_magnitudes(points: DataFrame, flux: str = "flux", error: str = "flux_err") -> DataFrame:
    return points.withColumns({"m": magnitude(F.col(flux)), "e": magnitude_error(F.col(flux), F.col(error))})


def distinct_exposures(points: DataFrame, exposure: str, *required: str) -> DataFrame:
    """Drops points that lack a required value, then repeated exposures (which of them stays isn't fixed unless they are equal)."""
    return points.na.drop(subset=[*required]).dropDuplicates([exposure])


def thinned(points: Column, cadence_days: float) -> Column:
    """Greedy thinning of a sorted array of structs with field ``t``: a point stays if it is ``cadence_days`` or more after the last
    point that stayed.  Points without a finite time go.

    Only the times go to Python, in Arrow batches; the places of those that stay come back, and each point is copied once.
    """

    @F.arrow_udf("array<int>")
    def places(times: pa.Array) -> pa.Array:
        flat = times.flatten().to_numpy(zero_copy_only=False)
        sizes = pa.compute.fill_null(pa.compute.list_value_length(times), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        out = []
        for lo, n in zip(first.tolist(), sizes.tolist()):
            t = flat[lo : lo + n]
            timed = np.flatnonzero(np.isfinite(t))
            out.append(timed[thinned_rows(t[timed], cadence_days)].tolist())
        return pa.array(out, pa.list_(pa.int32()))

    times = F.transform(points, lambda p: F.coalesce(p["t"].cast("double"), F.lit(float("nan"))))
    kept = F.transform(places(times), lambda i: F.get(points, i))
    return F.when(points.isNotNull(), kept)


def thinned_rows(t: np.ndarray, cadence_days: float, last: float | None = None) -> list[int]:
    """Places of the sorted times that stay, after a point at ``last`` that stayed; each step jumps to the next one by bisection."""
    rows, at = [], 0
    if last is not None:
        at = after(t, 0, last, cadence_days)
    while at < len(t):
        rows.append(at)
        at = after(t, at + 1, t[at], cadence_days)
    return rows


def after(t: np.ndarray, lo: int, last: float, cadence_days: float) -> int:
    """First place from ``lo`` on whose time less ``last`` is the cadence or more; the bisection's rounding is put right by steps."""
    at = max(lo, int(np.searchsorted(t, last + cadence_days)))
    while at > lo and t[at - 1] - last >= cadence_days:
        at -= 1
    while at < len(t) and t[at] - last < cadence_days:
        at += 1
    return at


def thin(points: DataFrame, cadence_days: float, by: list[str] | None = None, tie: list[str] | None = None) -> DataFrame:
    """Greedy thinning of long photometry; one shuffle by curve.  Points without a time go."""
    by, tie = by or ["id"], tie or []

    def keep(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["t", *tie], kind="stable")
        return frame.iloc[thinned_rows(frame["t"].to_numpy(dtype=float), cadence_days)]

    return points.filter(F.abs("t") < float("inf")).groupBy(*by).applyInPandas(keep, points.schema)


def thin_many(points: DataFrame, cadence_days: float, columns: list[str], least: int = 1) -> DataFrame:
    """:func:`thin` of (id, t, *columns) with ``columns`` as ties, of curves of which ``least`` points or more stay.

    Curves go to Python in blocks and as times alone, not a frame each: for tables of many short curves.
    """
    last = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"__{i}") for i, c in enumerate(columns)]  # missing values come last
    rows = F.sort_array(F.collect_list(F.struct("t", *last, *columns)))
    whole = points.filter(F.abs("t") < float("inf")).groupBy("id").agg(rows.alias("rows"))
    kept = whole.select("id", thinned(F.col("rows"), cadence_days).alias("rows")).filter(F.size("rows") >= least)
    return kept.select("id", F.explode("rows").alias("row")).select("id", *[f"row.{c}" for c in ("t", *columns)])


def with_minimum(points: DataFrame, n: int, by: list[str] | None = None) -> DataFrame:
    """Points of curves that have ``n`` points or more."""
    return points.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*(by or ["id"])))).filter(F.col("__n") >= n).drop("__n")
