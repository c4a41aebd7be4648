"""Robust statistics of light curves: one shuffle by curve, windows and one aggregation on the same partitioning."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: With fewer points every statistic is NULL.
MIN_POINTS = 4


def basic_stats(points: DataFrame, by: str = "id", tie: list[str] | None = None) -> DataFrame:
    """Twenty statistics of (``by``, t, m, e); sequential ones in time order, ties in the order of ``tie``."""
    own = Window.partitionBy(by)
    order = own.orderBy("t", *(tie or ["m", "e"]))
    w = 1 / (F.col("e") * F.col("e"))
    first = points.withColumns({"w": w, "n": F.count(F.lit(1)).over(own), "wmean": F.sum(w * F.col("m")).over(own) / F.sum(w).over(own), "median": F.percentile("m", F.lit(0.5)).over(own)})
    dev = F.col("m") - F.col("wmean")
    second = first.withColumns({"dev": dev, "d": F.sqrt(F.col("n") / (F.col("n") - 1)) * dev / F.col("e")})
    third = second.withColumns({"p": F.col("d") * F.lead("d").over(order), "dt": F.lead("t").over(order) - F.col("t"), "dm": F.lead("m").over(order) - F.col("m")})
    n, high, low = F.col("n"), F.col("high"), F.col("low")
    q = [0.05, 0.1, 0.15, 0.2, 0.25, 0.75, 0.8, 0.85, 0.9, 0.95]
    sums = third.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("median").alias("median"),
        F.first("wmean").alias("wmean"),
        F.sum("w").alias("sw"),
        F.sum(F.col("w") * F.col("dev") * F.col("dev")).alias("swd"),
        F.sum(F.abs(F.col("m") - F.col("median")) / F.col("e")).alias("sabs"),
        F.max(F.col("m") - F.col("e")).alias("high"),
        F.min(F.col("m") + F.col("e")).alias("low"),
        F.sum(F.col("dev") * F.col("dev") - F.col("e") * F.col("e")).alias("sx"),
        F.percentile(F.abs(F.col("m") - F.col("median")), F.lit(0.5)).alias("mad"),
        F.percentile("m", F.array(*map(F.lit, q))).alias("q"),
        F.sum(F.pow(F.col("dev") / F.col("e"), 3)).alias("s3"),
        F.sum(F.pow(F.col("dev") / F.col("e"), 4)).alias("s4"),
        F.sum(F.when(F.col("dt") > 0, F.col("dm") * F.col("dm") / (F.col("dt") * F.col("dt")))).alias("sv"),
        F.sum(F.when(F.col("dt") > 0, 1 / (F.col("dt") * F.col("dt")))).alias("st"),
        F.sum("p").alias("sp"),
        F.sum(F.signum("p") * F.sqrt(F.abs("p"))).alias("sj"),
        F.sum(F.abs("d")).alias("sd"),
        F.sum(F.col("d") * F.col("d")).alias("sdd"),
    )
    found = {
        "median": F.col("median"),
        "wmean": F.col("wmean"),
        "chi2red": F.col("swd") / (n - 1),
        "roms": F.col("sabs") / (n - 1),
        "wstd": F.sqrt(F.col("swd") / F.col("sw")),
        "norm_peak_to_peak_amp": (high - low) / (high + low),
        "norm_excess_var": F.col("sx") / (n * F.col("wmean") * F.col("wmean")),
        "median_abs_dev": F.col("mad"),
        "iqr": F.col("q")[5] - F.col("q")[4],
        "i60r": F.col("q")[6] - F.col("q")[3],
        "i70r": F.col("q")[7] - F.col("q")[2],
        "i80r": F.col("q")[8] - F.col("q")[1],
        "i90r": F.col("q")[9] - F.col("q")[0],
        "skew": n / ((n - 1) * (n - 2)) * F.col("s3"),
        "smallkurt": n * (n + 1) / ((n - 1) * (n - 2) * (n - 3)) * F.col("s4") - 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3)),
        "inv_vonneumannratio": F.try_divide(F.col("st") * F.col("swd") / F.col("sw"), F.col("sv")),
        "welch_i": F.col("sp"),
        "stetson_j": F.col("sj"),
        "stetson_k": F.try_divide(F.col("sd") / n, F.sqrt(F.col("sdd") / n)),
    }
    enough = n >= MIN_POINTS
    return sums.select(by, F.when(enough, n).alias("n"), *[F.when(enough, x).alias(k) for k, x in found.items()])


def simple_features(points: DataFrame, by: str = "id", tie: list[str] | None = None) -> DataFrame:
    """Widely used features of (``by``, t, m, e) that need no fit: cadence, location, spread, flux percentiles and slopes.

    Flux percentiles are of 10 ** (-0.4 m).  Features of pairs of points are NULL for a single point; equal times give no slope.
    """
    own = Window.partitionBy(by)
    order = own.orderBy("t", *(tie or ["m", "e"]))
    p = F.percentile("m", F.lit(0.5)).over(own)
    rows = points.withColumns({"dt": F.lead("t").over(order) - F.col("t"), "dm": F.lead("m").over(order) - F.col("m"), "median": p, "mean": F.avg("m").over(own), "std": F.stddev_pop("m").over(own), "span": F.max("m").over(own) - F.min("m").over(own)})
    w = 1 / (F.col("e") * F.col("e"))
    levels = [0.05, 0.1, 0.175, 0.25, 0.325, 0.4, 0.5, 0.6, 0.675, 0.75, 0.825, 0.9, 0.95]
    flux = F.pow(F.lit(10.0), -0.4 * F.col("m"))
    share = lambda x: F.avg(x.cast("int"))
    sums = rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_epochs"),
        (F.max("t") - F.min("t")).alias("total_time"),
        F.avg("dt").alias("cads_avg"),
        F.percentile("dt", F.lit(0.5)).alias("cads_med"),
        F.stddev_pop("dt").alias("cads_std"),
        F.avg("t").alias("avgt"),
        F.avg("m").alias("mean"),
        F.avg("e").alias("avg_err"),
        F.percentile("e", F.lit(0.5)).alias("med_err"),
        F.stddev_pop("e").alias("std_err"),
        F.stddev_pop("m").alias("std"),
        (F.sum(F.col("m") * w) / F.sum(w)).alias("weighted_average"),
        F.min("m").alias("minimum"),
        F.max("m").alias("maximum"),
        F.first("median").alias("median"),
        F.skewness("m").alias("skew"),
        F.percentile(F.abs(F.col("m") - F.col("median")), F.lit(0.5)).alias("median_absolute_deviation"),
        share(F.abs(F.col("m") - F.col("mean")) > F.col("std")).alias("percent_beyond_1_std"),
        share(F.abs(F.col("m") - F.col("median")) < 0.2 * F.col("span") / 2).alias("percent_close_to_median"),
        F.max(F.when(F.col("dt") > 0, F.abs(F.col("dm") / F.col("dt")))).alias("max_slope"),
        F.percentile(flux, F.array(*map(F.lit, levels))).alias("q"),
        F.pow(F.lit(10.0), -0.4 * F.first("median")).alias("f"),
        F.min(flux).alias("f_lo"),
        F.max(flux).alias("f_hi"),
    )
    q = dict(zip(levels, (F.col("q")[i] for i in range(len(levels)))))
    wide = q[0.95] - q[0.05]
    mid = {20: (0.4, 0.6), 35: (0.325, 0.675), 50: (0.25, 0.75), 65: (0.175, 0.825), 80: (0.1, 0.9)}
    more = {f"flux_percentile_ratio_mid{k}": F.try_divide(q[hi] - q[lo], wide) for k, (lo, hi) in mid.items()}
    more |= {"percent_difference_flux_percentile": F.try_divide(wide, F.col("f")), "percent_amplitude": F.greatest(F.abs(F.col("f_hi") - F.col("f")), F.abs(F.col("f_lo") - F.col("f"))) / F.col("f"), "amplitude": (F.col("maximum") - F.col("minimum")) / 2}
    return sums.select(*[c for c in sums.columns if c not in ("q", "f", "f_lo", "f_hi")], *[x.alias(c) for c, x in more.items()])


def anderson_darling(x: np.ndarray) -> float:
    """Normality statistic with estimated mean and standard deviation."""
    n = len(x)
    s = x.std(ddof=1) if n > 1 else 0.0
    if n < MIN_POINTS or not s > 0:
        return math.nan
    z = (np.sort(x) - x.mean()) / (s * math.sqrt(2))
    tail = lambda v: np.array([math.log(max(0.5 * math.erfc(u), 1e-300)) for u in v])
    i = np.arange(1, n + 1)
    return float(-n - ((2 * i - 1) / n * (tail(-z) + tail(z)[::-1])).sum())


# Coefficients of Royston's approximation to the weights of the W statistic.
_W_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
_W_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)


def shapiro_wilk(x: np.ndarray) -> float:
    """The W statistic by Royston's approximation."""
    n = len(x)
    if n < MIN_POINTS:
        return math.nan
    x = np.sort(x)
    total = ((x - x.mean()) ** 2).sum()
    if not total > 0:
        return math.nan
    normal = NormalDist()
    m = np.array([normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    size, u = (m * m).sum(), 1 / math.sqrt(n)
    last = np.polyval(_W_LAST[::-1], u) + m[-1] / math.sqrt(size)
    a = m.copy()
    if n > 5:
        second = np.polyval(_W_NEXT[::-1], u) + m[-2] / math.sqrt(size)
        scale = (size - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)
        a = m / math.sqrt(scale)
        a[1], a[-2] = -second, second
    else:
        scale = (size - 2 * m[-1] ** 2) / (1 - 2 * last**2)
        a = m / math.sqrt(scale)
    a[0], a[-1] = -last, last
    return float((a @ x) ** 2 / total)


def normality(points: DataFrame, by: str = "id") -> DataFrame:
    """Anderson-Darling and Shapiro-Wilk statistics of m / e."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        x = (frame["m"] / frame["e"]).to_numpy(dtype=float)
        return pd.DataFrame({by: [frame[by].iloc[0]], "ad": [anderson_darling(x)], "sw": [shapiro_wilk(x)]})

    return points.select(by, "m", "e").groupBy(by).applyInPandas(work, f"`{by}` {dict(points.dtypes)[by]}, ad double, sw double")
