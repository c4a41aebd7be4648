"""Kernels and operators without a SQL oracle against slow versions, and their defined results on bad input."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold.operators import acquisition, agreement, clean, curation, curves, modelling, periods, predictions, stats
from starfold.streaming import events

NAMES = list(periods.KERNELS)
POINTS = "id long, t double, m double, e double"


def curve(n=80, period=3.7, seed=0):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.uniform(0, 60, n))
    return t, 10 + np.sin(2 * np.pi * t / period) + 0.4 * np.cos(4 * np.pi * t / period) + rng.normal(0, 0.05, n), rng.uniform(0.03, 0.08, n)


def test_kernels_leave_bad_points_out(spark):
    nan, inf = float("nan"), float("inf")
    t, m, e = curve()
    good = [(1, *map(float, x)) for x in zip(t, m, e)]
    bad = [(1, None, 1.0, 0.1), (1, 2.0, None, 0.1), (1, 2.0, 1.0, None), (1, nan, 1.0, 0.1), (1, 2.0, nan, 0.1), (1, 2.0, 1.0, nan), (1, inf, 1.0, 0.1), (1, 2.0, 1.0, 0.0), (1, 2.0, 1.0, -1.0), (2, None, None, None)]
    freqs = np.linspace(0.1, 1.0, 40)
    found = [sorted(map(tuple, periods.periodograms(spark.createDataFrame(rows, POINTS), freqs, NAMES).collect())) for rows in (good, good + bad)]
    assert found[0] == found[1] and len(found[0]) == 40


@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_kernels_on_few_points_and_empty_grids(n):
    t, m, e = curve(n)
    for name in NAMES:
        assert len(periods.KERNELS[name](t, m, e, np.zeros(0))) == 0
        assert len(periods.KERNELS[name](t, m, e, np.array([0.1, 0.3, 0.7]))) == 3
        assert len(periods.KERNELS[name](t, np.full(n, 5.0), e, np.array([0.1, 0.3]))) == 2
    assert len(curves.frequency_grid(0.0)) == 0


def test_search_pads_and_drops_what_can_not_be_judged(spark):
    rows = [(1, 1.0, 10.0, 0.1), (2, None, 1.0, 0.1)]
    points = spark.createDataFrame(rows, POINTS)
    assert periods.search(points, np.linspace(0.1, 1, 30), NAMES, 3).filter("period is not null and algorithm = 'AOV'").count() == 0
    padded = periods.search(points, np.linspace(0.1, 1, 30), ["LS", "AOV"], 3, padded=True).collect()
    assert sorted((r["algorithm"], r["rank"]) for r in padded) == [(a, k) for a in ("AOV", "LS") for k in (1, 2, 3)] and all(r["period"] is None for r in padded)


def test_harmonics_equal_one_fit_at_a_time():
    t, m, e = curve(50)
    freqs = np.linspace(0.05, 1.2, 25)
    price = math.log(len(t))
    flat = periods.harmonic_fit(t, m, e, 1.0, 0)[0] + price
    slow = np.array([[flat - periods.harmonic_fit(t, m, e, f, k)[0] - price * (1 + 2 * k) for k in (1, 2, 3)] for f in freqs])
    assert np.allclose(periods.harmonic_gains(t, m, e, freqs), slow, rtol=1e-6, atol=1e-6)
    assert np.allclose(periods.multi_harmonic(t, m, e, freqs), slow.max(axis=1), rtol=1e-6, atol=1e-6)


def test_box_equals_trial_of_all_boxes():
    t, m, e = curve(40)
    w = 1 / e**2
    w /= w.sum()
    y = w * (m - w @ m)
    for f in (0.2, 0.27, 0.9):
        best, cell = 0.0, periods.phase_bins(t, np.array([f]), 50)[0]
        for first in range(50):
            for width in range(1, 26):
                inside = (cell - first) % 50 < width
                r, s = w[inside].sum(), y[inside].sum()
                if 1e-12 < r < 1 - 1e-12:
                    best = max(best, s * s / (r * (1 - r)))
        assert math.isclose(periods.box_least_squares(t, m, e, np.array([f]))[0], math.sqrt(best), rel_tol=1e-9)


def test_harmonic_features_take_band_means_off(spark):
    t, m, e = curve(60)
    rows = [(1, "gr"[i % 2], float(x), float(y + 2 * (i % 2)), float(z)) for i, (x, y, z) in enumerate(zip(t, m, e))]
    points = spark.createDataFrame(rows, "id long, band string, t double, m double, e double")
    at = spark.createDataFrame([(1, 3.7), (2, 1.0), (3, None)], "id long, period double")
    plain, banded = (periods.harmonic_features(points, at, by_band=b).collect() for b in (False, True))
    assert len(plain) == len(banded) == 1 and banded[0]["gain_2"] > plain[0]["gain_2"] and banded[0]["best"] >= 2 and banded[0]["gain_0"] == 0


def test_fourier_recovers_a_harmonic_curve(spark):
    t = np.sort(np.random.default_rng(3).uniform(0, 40, 120))
    x = 2 * np.pi * (t - t.min()) / 2.5
    m = 12 + 0.01 * (t - t.min()) + 0.8 * np.cos(x) + 0.3 * np.sin(2 * x)
    points = spark.createDataFrame([(1, float(a), float(b), 0.01) for a, b in zip(t, m)], POINTS)
    r = periods.fourier(points, spark.createDataFrame([(1, 2.5)], "id long, period double")).first()
    assert math.isclose(r["f1_amp"], 0.8, rel_tol=1e-6) and math.isclose(r["f1_relamp1"], 0.375, rel_tol=1e-6) and abs(r["f1_relamp2"]) < 1e-6 and math.isclose(r["f1_b"], 0.01, rel_tol=1e-4)


@pytest.mark.parametrize("cadence", [0.0, 0.3, 5.0])
def test_thinning_equals_a_loop(spark, cadence):
    rng = random.Random(4)
    rows = [(i % 3, round(rng.uniform(0, 20), 2) if rng.random() > 0.05 else None, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t double, m double")
    expected = []
    for k in range(3):
        last = None
        for i, t, m in sorted((r for r in rows if r[0] == k and r[1] is not None), key=lambda r: (r[1], r[2])):
            if last is None or t - last >= cadence:
                expected.append((i, t, m))
                last = t
    assert sorted(map(tuple, clean.thin(df, cadence, tie=["m"]).collect())) == sorted(expected)
    nested = df.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("t", "m"))).alias("d"))
    flat = nested.select("id", F.inline(clean.thinned(F.col("d"), cadence)))
    assert sorted(map(tuple, flat.collect())) == sorted(expected)


def test_stream_thinning_equals_batches_and_leaves_late_points_out(spark, tmp_path):
    rows = [(k, float(i) / 7, float(i)) for k in range(3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t double, m double")
    df.filter("t < 4").coalesce(1).write.parquet(f"{tmp_path}/in")
    run = lambda: events.thinned_stream(events.read_points(spark, f"{tmp_path}/in", "id long, t double, m double"), 0.5).writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).format("parquet").start(f"{tmp_path}/out").awaitTermination()
    run()
    df.filter("t >= 4").union(spark.createDataFrame([(0, 0.01, -1.0)], df.schema)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    found = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, clean.thin(df, 0.5).collect()))


def test_dmdt_counts_every_pair(spark):
    rng = random.Random(5)
    rows = [(i % 2, rng.uniform(0, 30), rng.gauss(0, 1)) for i in range(60)] + [(5, 1.0, 2.0), (6, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, t double, m double")
    expected = {}
    for k in (0, 1):
        own = sorted((t, m) for i, t, m in rows if i == k)
        for a in range(len(own)):
            for b in range(a + 1, len(own)):
                cell = [int(periods.np.searchsorted(edges, x, side="right")) - 1 for x, edges in ((own[b][1] - own[a][1], curves.DM_EDGES), (own[b][0] - own[a][0], curves.DT_EDGES))]
                expected[(k, *cell)] = expected.get((k, *cell), 0) + 1
    assert {(r["id"], r["dm_bin"], r["dt_bin"]): r["n"] for r in curves.dmdt_counts(df).collect()} == expected
    image = {r["id"]: np.array(r["dmdt"]) for r in curves.dmdt_images(df).collect()}
    assert image[5].shape == (26, 26) and not image[5].any() and math.isclose((image[0] ** 2).sum(), 1, abs_tol=1e-5)


def test_merged_zones(spark):
    zones = spark.createDataFrame([("RA53", 1.0, 2.0), ("RA53", 5.0, 6.0), ("RA95", 3.0, 4.0)], "field string, lo double, hi double")
    assert sorted(map(tuple, periods.merged_zones(zones).collect())) == [(1.0, 2.0), (3.0, 4.0), (5.0, 6.0)]


def test_families_and_consensus_by_hand(spark):
    base = 1 / 2.2
    alias = 1 / (base + 24 / 23.9345)
    rows = [(1, "LS", 1, 2.2, 9.0), (1, "CE", 1, alias, 8.0), (1, "AOV", 1, 2.2, 7.0), (1, "AOV", 2, 0.3137, 1.0)]
    table = spark.createDataFrame(rows, "id long, algorithm string, rank int, period double, significance double")
    edges = {(r["a"], r["b"]) for r in agreement.sidereal_edges(table).collect()}
    # nodes are numbered by (algorithm, rank): AOV 1, AOV 2, CE 1, LS 1
    assert {(1, 3), (3, 4), (1, 4)} <= edges
    r = agreement.sidereal_families(table).first()
    assert (r["family_n_algos"], r["family_n_members"], r["family_n_total"], r["family_best_period"], r["family_best_algo"]) == (3, 3, 4, 2.2, "LS") and r["family_rank_score"] == 3.0
    # by hand: 2.2 is the first choice of two algorithms, so each votes 1 for it
    votes = spark.createDataFrame([(1, "LS", 1, 5.0), (1, "LS", 2, 9.1), (1, "CE", 1, 5.05), (1, "AOV", 1, 1.7), (2, "LS", 1, 5.0), (2, "CE", 1, 13.0)], "id long, algorithm string, rank int, period double")
    found = {r["id"]: r["best_consensus_period"] for r in agreement.consensus(votes, ["LS", "CE", "AOV"]).collect()}
    assert found[1] == 5.0 and (found[2] is None or math.isnan(found[2]))


def test_labels_that_lose_too_many_rows(spark):
    features = spark.createDataFrame([(i, 1.0) for i in range(8)], "id long, x double")
    labels = spark.createDataFrame([(i, 1) for i in range(10)], "id long, y int")
    assert curation.features_with_labels(features, labels, most_lost=0.2).count() == 8
    with pytest.raises(ValueError):
        curation.features_with_labels(features, labels, most_lost=0.1)


def test_imputation_by_all_strategies(spark):
    nan = float("nan")
    rows = [(1, 1.0, None, 5.0, 1.0, 2.0), (2, None, 4.0, nan, None, 2.1), (3, 3.0, 6.0, 7.0, 3.0, 9.0), (4, 2.0, 5.0, 6.0, 4.0, None), (5, 2.0, None, 1.0, 5.0, 8.0)]
    table = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double")
    found = {r["id"]: r for r in modelling.impute(table, {"a": "zero", "b": "median", "c": "mean", "d": "regress", "e": "regress"}, k=1).collect()}
    assert (found[2]["a"], found[1]["b"], found[5]["b"], found[2]["c"], found[2]["d"]) == (0.0, 5.0, 5.0, 4.75, 1.0) and found[4]["e"] == 9.0
    assert sorted(r["id"] for r in modelling.impute(table, {"a": "none"}).collect()) == [1, 3, 4, 5]


def test_source_list_of_other_shapes_and_missing_columns(spark):
    nested = spark.createDataFrame([(7, ([10.0, 20.0],))], "_id long, radec_geojson struct<coordinates: array<double>>")
    assert tuple(acquisition.source_list(nested).first()) == (7, 10.0, 20.0)
    with pytest.raises(ValueError):
        acquisition.source_list(nested.select("_id"))
    with pytest.raises(ValueError):
        acquisition.match_input(nested.select("_id"), nested)


def test_trees_tell_classes_apart_on_held_out_rows(spark):
    rng = random.Random(6)
    rows = [(i, rng.gauss(i % 2, 0.6), rng.gauss(0, 1), i % 2) for i in range(400)]
    table = spark.createDataFrame(rows, "id long, a double, b double, y int")
    part = modelling.split_of(F.col("id"), test=0.3) == "test"
    model, importances, chosen = modelling.train_trees(table.filter(~part), ["a", "b"], stages=({"maxDepth": (2, 3)},), most=8, folds=2)
    auc = modelling.roc_auc(modelling.score(table.filter(part), model, ["a", "b"], "p")).first()["auc"]
    assert auc > 0.8 and importances[0][0] == "a" and chosen["maxDepth"] in (2, 3)


def test_selection_counts_rows_chosen_before(spark):
    rows = [(i, 1.0 if i < 6 else 0.0, 1.0 if i >= 3 else 0.0) for i in range(10)]
    table = spark.createDataFrame(rows, "id long, a double, b double")
    found = {r["id"] for r in predictions.sample_counting_selected(table, ["a", "b"], 4, 0.5).collect()}
    assert len(found & set(range(6))) >= 4 and len([i for i in found if i >= 3]) == 4
    everything = predictions.sample_counting_selected(table, ["a", "b"], 40, 0.5)
    assert everything.count() == 10


def test_normality_statistics_of_known_samples():
    """Values by their defining sums (Anderson-Darling) and of a published example (Shapiro-Wilk: 11 weights of men, W = 0.79)."""
    from statistics import NormalDist

    x = np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], dtype=float)
    assert abs(stats.shapiro_wilk(x) - 0.79) < 0.005
    z = np.sort((x - x.mean()) / x.std(ddof=1))
    n, phi = len(x), [NormalDist().cdf(v) for v in z]
    slow = -n - sum((2 * i + 1) / n * (math.log(phi[i]) + math.log(1 - phi[n - 1 - i])) for i in range(n))
    assert math.isclose(stats.anderson_darling(x), slow, rel_tol=1e-9)


def test_simple_features_of_odd_curves(spark):
    rows = [(1, 5.0, 17.0, 0.1), (2, 1.0, 17.0, 0.1), (2, 1.0, 18.0, 0.1)] + [(3, 0.5 * i, 17.0, 0.1) for i in range(50)]
    found = {r["id"]: r for r in stats.simple_features(spark.createDataFrame(rows, POINTS)).collect()}
    assert found[1]["max_slope"] is None and found[1]["cads_avg"] is None and found[2]["max_slope"] is None and found[2]["amplitude"] == 0.5
    assert found[3]["std"] == 0 and found[3]["total_time"] == 24.5 and abs(found[3]["weighted_average"] - 17) < 1e-9 and found[3]["flux_percentile_ratio_mid50"] is None
