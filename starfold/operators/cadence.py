"""Features of sampling and of correlated variability: waiting times, all pairwise times, a damped random walk, a fast period.

What follows from neighbouring points is expressions over one shuffle by curve.  Pairwise times, the random walk and the period
need a whole curve at a time: one grouped pass gives all of them, O(n log n) in the points of a curve.

Defined results: points that lack a finite time, magnitude or error, or whose error isn't positive, are left out; a curve without points has no
row; what a curve is too short for is NULL.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.functions.photometry import null_nan
from starfold.operators import periods

# Waiting times (minutes) of the cumulative probabilities.
WAITS = (1, 10, 20, 30, 40, 50, 100, 500, 1000, 5000, 10000, 50000, 100000, 500000, 1000000, 5000000, 10000000)
MINUTES = 24 * 60.0
#: Bins of the histogram of pairwise times, and finer ones in which times are counted first.
TIME_BINS, FINER = 50, 50
#: A damped random walk at magnitude 19 and its change with the magnitude: log10 of the variance rate (mag^2 a day), log10 of the time scale (days).
WALK = {"rate": -4.10, "rate_slope": 0.14, "scale": 2.92, "scale_slope": -0.07}


def waiting_features(points: DataFrame, by: str = "id", tie: list[str] | None = None, faint: bool = False) -> DataFrame:
    """(``by``, cad_probs_{minutes}, {avg,med,std}_double_to_single_step) of (``by``, t, m, e).

    ``cad_probs_x`` is the percentile rank of x minutes among the times between neighbouring points, as a share: values equal to x count by
    their mean rank.  With ``faint`` points of no flux count too (see :func:`periods.usable`).  A double step is the time to the point after the next one, over the time to the next; equal times give none.
    """
    order = Window.partitionBy(by).orderBy("t", *(tie or ["m", "e"]))
    rows = periods.usable(points.withColumnRenamed(by, "id"), *[c for c in tie or [] if c not in ("t", "m", "e")], faint=faint)
    if by != "id":
        rows = rows.withColumnRenamed("id", by)
    rows = rows.withColumns({"dt": F.lead("t").over(order) - F.col("t"), "dt2": F.lead("t", 2).over(order) - F.col("t")})
    n, dt, step = F.count("dt"), F.col("dt"), F.when(F.col("dt") > 0, F.col("dt2") / F.col("dt"))
    found = []
    for minutes in WAITS:
        below, upto = F.count_if(dt < minutes / MINUTES), F.count_if(dt <= minutes / MINUTES)
        found.append(F.try_divide(below + upto + (below < upto).cast("int"), 2 * n).alias(f"cad_probs_{minutes}"))
    steps = [F.avg(step).alias("avg_double_to_single_step"), F.percentile(step, F.lit(0.5)).alias("med_double_to_single_step"), F.stddev_pop(step).alias("std_double_to_single_step")]
    return rows.groupBy(by).agg(*found, *steps)


def pair_times(t: np.ndarray, bins: int = TIME_BINS, finer: int = FINER) -> np.ndarray:
    """Counts of the differences of all pairs of times in ``bins`` bins up to the whole time range.

    Times are first counted in ``bins * finer`` cells; the differences of cells are an autocorrelation, done by Fourier transform.
    """
    cells = bins * finer
    span = t.max() - t.min()
    at = np.minimum(((t - t.min()) / span * cells).astype(np.int64), cells - 1) if span > 0 else np.zeros(len(t), dtype=np.int64)
    count = np.bincount(at, minlength=cells)
    wave = np.fft.rfft(count, 2 * cells)
    pairs = np.rint(np.fft.irfft(wave * np.conj(wave), 2 * cells)[:cells]).astype(np.int64)
    # a cell with itself: each pair was counted twice, and each point with itself
    pairs[0] -= len(t)
    pairs[0] //= 2
    return pairs.reshape(bins, finer).sum(axis=1)


def ranked_peaks(x: np.ndarray) -> list[int]:
    """Bins above both neighbours (at an edge, above the one), largest first; of equal bins side by side the first stands for all."""
    if not len(x):
        return []
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    value = x[first]
    over = np.ones(len(value), dtype=bool)
    over[1:] &= value[1:] > value[:-1]
    over[:-1] &= value[:-1] > value[1:]
    peaks = first[over]
    return peaks[np.argsort(-x[peaks], kind="stable")].tolist()


PAIR_FEATURES = ["all_times_nhist_numpeaks", "all_times_nhist_peak_val", *[f"all_times_nhist_peak_{a}_to_{b}" for b in (2, 3, 4) for a in range(1, b)], *[f"all_times_nhist_peak{k}_bin" for k in range(1, 5)]]


def pair_features(t: np.ndarray) -> list[float]:
    """Number of peaks, height of the highest, ratios and bins of the four highest, of the histogram scaled to an integral of 1."""
    count = pair_times(t)
    span = t.max() - t.min()
    if len(t) < 2 or not span > 0:
        return [math.nan] * len(PAIR_FEATURES)
    peaks = ranked_peaks(count)
    height = count / count.sum() * TIME_BINS / span
    ratio = lambda a, b: height[peaks[a - 1]] / height[peaks[b - 1]] if len(peaks) >= b and height[peaks[b - 1]] else math.nan
    bins = [float(peaks[k]) if len(peaks) > k else math.nan for k in range(4)]
    return [float(len(peaks)), height[peaks[0]], *[ratio(a, b) for b in (2, 3, 4) for a in range(1, b)], *bins]


def walk_statistics(t: np.ndarray, m: np.ndarray, e: np.ndarray, variance: float, scale: float) -> tuple[float, float]:
    """(chi square of the magnitudes about their best mean under a damped random walk, trace of the inverse covariance).

    The covariance is ``variance * exp(-|dt| / scale)`` plus the errors' squares.  The walk is Markovian, so a filter in time order whitens
    the points one by one; a second one backwards gives what the others say about each point, and so the trace.
    """
    n = len(t)
    # plain numbers and lists: the loops take one value at a time
    decay, noise, m, variance = np.exp(-np.diff(t) / scale).tolist(), (e**2).tolist(), m.tolist(), float(variance)
    ahead, back, white, ones = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    level, base, p = 0.0, 0.0, variance
    for i in range(n):
        if i:
            a = decay[i - 1]
            level, base, p = a * level, a * base, a * a * p + variance * (1 - a * a)
        ahead[i] = p
        s = p + noise[i]
        root = math.sqrt(s)
        dy, d1 = m[i] - level, 1.0 - base
        white[i], ones[i] = dy / root, d1 / root
        gain = p / s
        level, base, p = level + gain * dy, base + gain * d1, p * (1 - gain)
    p = variance
    for i in range(n - 1, -1, -1):
        if i < n - 1:
            a = decay[i]
            p = a * a * p + variance * (1 - a * a)
        back[i] = p
        p *= noise[i] / (p + noise[i])
    ahead, back, white, ones, noise = map(np.array, (ahead, back, white, ones, noise))
    mean = (ones @ white) / (ones @ ones)
    rest = white - mean * ones
    others = 1 / (1 / ahead + 1 / back - 1 / variance)
    return float(rest @ rest), float((1 / (others + noise)).sum())


def walk_features(t: np.ndarray, m: np.ndarray, e: np.ndarray) -> tuple[float, float]:
    """log10 of the reduced chi square under the walk; and log10 of what a variable without correlation would have there, over
    the reduced chi square of a constant."""
    nu = len(t) - 1
    if nu < 1:
        return math.nan, math.nan
    w = 1 / e**2
    y = m - (w @ m) / w.sum()
    plain = float(w @ (y * y)) / nu
    off = float(np.median(m)) - 19
    rate, scale = 10 ** (WALK["rate"] + WALK["rate_slope"] * off), 10 ** (WALK["scale"] + WALK["scale_slope"] * off)
    chi, trace = walk_statistics(t, m, e, 0.5 * rate * scale, scale)
    null = float(np.var(m)) * trace / nu
    log = lambda x: math.log10(x) if x > 0 and math.isfinite(x) else math.nan
    return log(chi / nu), log(null / plain) if plain > 0 else math.nan


def fast_period(t: np.ndarray, m: np.ndarray, e: np.ndarray, samples: int = 5, finer: int = 40) -> float:
    """Period of the strongest sinusoid between twice the mean spacing and the time range: a coarse grid by fast sums, then a fine one about its peak."""
    span = t.max() - t.min()
    if len(t) < 4 or not span > 0 or not np.ptp(m) > 0:
        return math.nan
    step = 1 / (samples * span)
    coarse = 1 / span + step * np.arange(max(1, math.floor((len(t) / (2 * span) - 1 / span) / step) + 1))
    power = periods.lomb_scargle(t, m, e, coarse)
    if not np.isfinite(power).any():
        return math.nan
    near = coarse[int(np.nanargmax(power))] + step * np.linspace(-1, 1, 2 * finer + 1)
    near = near[(near >= coarse[0]) & (near <= coarse[-1] + step / 2)]
    power = periods.lomb_scargle(t, m, e, near)
    return float(1 / near[int(np.nanargmax(power))]) if np.isfinite(power).any() else math.nan


def pair_time_features(points: DataFrame, tasks: int | None = None) -> DataFrame:
    """(id, histogram of pairwise times) of (id, t): every point with a finite time counts, whatever its magnitude."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[frame["id"].iloc[0], *pair_features(frame["t"].to_numpy(dtype=float))]], columns=["id", *PAIR_FEATURES])

    timed = points.select("id", F.col("t").cast("double").alias("t")).filter(F.abs("t") < float("inf"))
    found = periods.by_curve(timed, tasks).applyInPandas(work, f"id {periods.kind_of(points)}, " + ", ".join(f"{c} double" for c in PAIR_FEATURES))
    return found.withColumns({c: null_nan(F.col(c)) for c in PAIR_FEATURES})


WALK_FEATURES = ["qso_log_chi2_qsonu", "qso_log_chi2nuNULL_chi2nu", "period_fast"]
CURVE_FEATURES = [*PAIR_FEATURES, *WALK_FEATURES]


def curve_features(points: DataFrame, tasks: int | None = None, pairs: bool = True) -> DataFrame:
    """(id, histogram of pairwise times, damped random walk, fast period) of (id, t, m, e); the histogram only with ``pairs``."""
    names = CURVE_FEATURES if pairs else WALK_FEATURES

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["t", "m", "e"])
        t, m, e = (frame[c].to_numpy(dtype=float) for c in ("t", "m", "e"))
        row = [*(pair_features(t) if pairs else []), *walk_features(t, m, e), fast_period(t, m, e)]
        return pd.DataFrame([[frame["id"].iloc[0], *row]], columns=["id", *names])

    kind = dict(points.dtypes)["id"]
    found = periods.by_curve(periods.usable(points), tasks).applyInPandas(work, f"id {kind}, " + ", ".join(f"{c} double" for c in names))
    return found.withColumns({c: null_nan(F.col(c)) for c in names})


def sampling_features(points: DataFrame, tasks: int | None = None) -> DataFrame:
    """All features of this module, one row for each curve of (id, t, m, e)."""
    return waiting_features(points).join(curve_features(points, tasks), "id")
