"""Sampling features against slow versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from starfold.operators import cadence, periods


def curve(seed, n=60, span=40.0):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.uniform(0, span, n))
    e = rng.uniform(0.02, 0.2, n)
    return t, 18 + np.sin(2 * np.pi * t / 3.3) + e * rng.normal(size=n), e


@pytest.mark.parametrize("n", [2, 3, 10, 70])
def test_pair_times_count_every_pair(n):
    t = curve(n, n)[0]
    cell = np.minimum(((t - t.min()) / np.ptp(t) * 2500).astype(int), 2499)
    slow = np.zeros(50, dtype=int)
    for i in range(n):
        for j in range(i):
            slow[(cell[i] - cell[j]) // 50] += 1
    assert (cadence.pair_times(t) == slow).all() and slow.sum() == n * (n - 1) // 2


def peaks_slow(x):
    """Each bin looks left and right past its equals; the first of equals stands for all."""
    found = []
    for i in range(len(x)):
        if i and x[i - 1] == x[i]:
            continue
        j = i
        while j + 1 < len(x) and x[j + 1] == x[i]:
            j += 1
        if (i == 0 or x[i - 1] < x[i]) and (j == len(x) - 1 or x[j + 1] < x[i]):
            found.append(i)
    return sorted(found, key=lambda i: (-x[i], i))


def test_peaks():
    rng = random.Random(0)
    for _ in range(400):
        x = np.array([rng.randint(0, 4) for _ in range(rng.randint(0, 12))])
        assert cadence.ranked_peaks(x) == peaks_slow(x.tolist())


@pytest.mark.parametrize(("variance", "scale"), [(0.3, 2.0), (0.01, 500.0), (5.0, 0.05)])
def test_walk_equals_dense_matrices(variance, scale):
    t, m, e = curve(3)
    t[5] = t[4]
    cov = variance * np.exp(-np.abs(t[:, None] - t) / scale) + np.diag(e**2)
    inverse, one = np.linalg.inv(cov), np.ones(len(t))
    mean = one @ inverse @ m / (one @ inverse @ one)
    chi, trace = cadence.walk_statistics(t, m, e, variance, scale)
    assert math.isclose(chi, (m - mean) @ inverse @ (m - mean), rel_tol=1e-9) and math.isclose(trace, np.trace(inverse), rel_tol=1e-9)


def test_walk_tells_a_walk_from_noise():
    rng = np.random.default_rng(1)
    t = np.sort(rng.uniform(0, 2000, 150))
    x = np.zeros(150)
    for i in range(1, 150):
        a = math.exp(-(t[i] - t[i - 1]) / 800)
        x[i] = a * x[i - 1] + math.sqrt(0.04 * (1 - a * a)) * rng.normal()
    e = np.full(150, 0.02)
    walk, noise = cadence.walk_features(t, 19 + x + e * rng.normal(size=150), e), cadence.walk_features(t, 19 + 0.2 * rng.normal(size=150), e)
    assert walk[0] < 0.3 and noise[0] > walk[0] + 0.5


def test_fast_period_finds_an_injected_one():
    for seed, period in ((1, 3.3), (2, 7.7), (3, 2.1)):
        rng = np.random.default_rng(seed)
        t = np.sort(rng.uniform(0, 60, 90))
        m = 17 + np.sin(2 * np.pi * t / period) + 0.05 * rng.normal(size=90)
        e = np.full(90, 0.05)
        found = cadence.fast_period(t, m, e)
        fine = np.linspace(1 / 60, 90 / 120, 200_000)
        power = periods.lomb_scargle(t, m, e, fine)
        assert math.isclose(found, 1 / fine[np.argmax(power)], rel_tol=2e-3) and math.isclose(found, period, rel_tol=0.02)
    assert math.isnan(cadence.fast_period(t[:3], m[:3], e[:3])) and math.isnan(cadence.fast_period(t, m * 0, e))


def test_tables(spark):
    nan = float("nan")
    t, m, e = curve(5, 30)
    rows = [("a", float(x), float(y), float(z)) for x, y, z in zip(t, m, e)] + [("a", nan, 1.0, 0.1), ("a", 1.0, None, 0.1), ("a", 1.0, 1.0, 0.0)]
    rows += [("b", 1.0, 17.0, 0.1), ("c", 1.0, 17.0, 0.1), ("c", 1.0, 18.0, 0.1), ("d", None, 1.0, 0.1)]
    found = {r.id: r for r in cadence.sampling_features(spark.createDataFrame(rows, "id string, t double, m double, e double"), tasks=3).collect()}
    assert set(found) == {"a", "b", "c"}
    dt = np.diff(t)
    a = found["a"]
    steps = (t[2:] - t[:-2]) / dt[:-1]
    assert math.isclose(a.avg_double_to_single_step, steps.mean()) and math.isclose(a.med_double_to_single_step, np.median(steps)) and math.isclose(a.std_double_to_single_step, steps.std())
    assert math.isclose(a.cad_probs_1000, (dt < 1000 / 1440).mean()) and a.cad_probs_10000000 == 1.0
    assert math.isclose(a.all_times_nhist_numpeaks, len(peaks_slow(cadence.pair_times(t).tolist())))
    assert found["b"].cad_probs_1 is None and found["b"].period_fast is None and found["b"].qso_log_chi2_qsonu is None and found["b"].all_times_nhist_peak_val is None
    assert found["c"].avg_double_to_single_step is None and found["c"].cad_probs_1 == 1.0 and found["c"].all_times_nhist_numpeaks is None
