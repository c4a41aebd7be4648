from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold.functions.photometry import band_number, magnitude, magnitude_error
from starfold.functions.spherical import iau_name
from starfold.operators import agreement, clean, curves, modelling, periods, spatial, stats
from starfold.sources import survey, tables


def points(spark, rows):
    return spark.createDataFrame(rows, "id long, t double, m double, e double")


@pytest.mark.parametrize("t, kept", [([0, 0.001, 0.002, 0.025, 0.05], [0, 0.025, 0.05]), ([0, 0.001, 5], [0, 5]), ([0, 1, 2], [0, 1, 2]), ([1.0], [1.0])])
def test_thinning_keeps_points_by_the_last_that_stayed(spark, t, kept):
    x = points(spark, [(1, float(v), 17.0, 0.1) for v in t])
    cadence = 30 * 60 / 86400
    if t == [0, 0.001, 0.002, 0.025, 0.05]:
        kept = [0, 0.025, 0.05]
    assert sorted(r.t for r in clean.thin(x, cadence).collect()) == kept
    nested = curves.nest(x, ["id"], ["t", "m", "e"]).select(clean.thinned(F.col("data"), cadence).alias("d")).first().d
    assert [p.t for p in nested] == kept


def test_constant_curve_has_no_scatter(spark):
    r = stats.basic_stats(points(spark, [(1, 0.5 * k, 17.0, 0.1) for k in range(50)])).first()
    assert (r.n, r["median"]) == (50, 17.0) and abs(r.wmean - 17) < 1e-12 and abs(r.chi2red) < 1e-9 and abs(r.wstd) < 1e-9


def test_three_points_give_nulls(spark):
    r = stats.basic_stats(points(spark, [(1, float(k), 17.0 + k, 0.1) for k in range(3)])).first().asDict()
    assert all(v is None for k, v in r.items() if k != "id")


def test_normality_statistics_tell_normal_from_skewed():
    rng = np.random.default_rng(1)
    normal, skewed = rng.normal(size=200), rng.exponential(size=200)
    assert stats.shapiro_wilk(normal) > 0.98 > stats.shapiro_wilk(skewed)
    assert stats.anderson_darling(normal) < 0.8 < stats.anderson_darling(skewed)


@pytest.mark.parametrize("name", ["LS", "CE", "AOV", "FPW", "MHF"])
def test_search_recovers_an_injected_period(spark, name):
    rng = np.random.default_rng(3)
    t = np.sort(rng.uniform(0, 200, 800))
    m = np.sin(2 * np.pi * t / 5) + 11 + rng.normal(0, 0.02, 800)
    x = points(spark, [(1, float(a), float(b), 0.02) for a, b in zip(t, m)])
    p = periods.search(x, np.linspace(0.1, 1.0, 500), [name], 1).first().period
    assert min(abs(p / q - 1) for q in (5, 2.5, 10)) < 0.05


def test_box_search_finds_a_transit():
    t = np.linspace(0, 100, 2000)
    m = np.where((t / 4) % 1 < 0.05, 0.5, 0.0) + np.random.default_rng(2).normal(0, 0.01, 2000)
    freqs = np.linspace(0.05, 1, 400)
    p = 1 / freqs[np.argmax(periods.box_least_squares(t, m, np.full(2000, 0.01), freqs))]
    assert min(abs(p / q - 1) for q in (4, 2, 8)) < 0.05


def test_algorithm_names():
    assert [periods.algorithm(n) for n in ("ELS_periodogram", "ECE", "AOV")] == ["LS", "CE", "AOV"]
    with pytest.raises(ValueError):
        periods.algorithm("XYZ")


def test_peaks_are_not_neighbours():
    freqs = np.linspace(0.1, 5, 1000)
    power = 10 * np.exp(-(((freqs - 1) / 0.004) ** 2)) + 8 * np.exp(-(((freqs - 3) / 0.004) ** 2))
    found = [p for p, _ in periods.top_peaks(power, freqs, "LS", 4)]
    assert any(abs(p - 1) < 0.01 for p in found) and any(abs(p - 1 / 3) < 0.01 for p in found)
    assert sum(abs(p - 1) < 0.02 for p in found) <= 2


def test_harmonics_of_a_fit(spark):
    t = np.linspace(0, 50, 400)
    m = 10 + 2 * np.cos(2 * np.pi * t / 5) + 0.5 * np.sin(4 * np.pi * t / 5)
    x = points(spark, [(1, float(a), float(b), 0.01) for a, b in zip(t, m)])
    r = periods.fourier(x, spark.createDataFrame([(1, 5.0)], "id long, period double")).first()
    assert abs(r.f1_amp - 2) < 1e-3 and abs(r.f1_relamp1 - 0.25) < 1e-3 and r.f1_power > 0.999


def test_window_function_of_a_nightly_survey():
    t = np.concatenate([d + np.arange(0, 0.25, 1 / 48) for d in range(40)])
    freqs = np.linspace(0.1, 3, 3000)
    w = periods.window_power(t, freqs)
    assert w.max() == 1 and w[np.argmin(abs(freqs - 1))] > 0.5


@pytest.mark.parametrize("a, b, hit", [(5, 5, True), (5, 5.02, True), (5, 10, True), (10, 5, True), (5, 15, True), (15, 5, True), (5, 7, False), (float("nan"), 5, False), (0, 5, False), (-5, 5, False)])
def test_period_match(spark, a, b, hit):
    x = spark.createDataFrame([(float(a), float(b))], "a double, b double")
    assert x.select(agreement.period_match(F.col("a"), F.col("b"))).first()[0] is hit


def periods_table(spark, **lists):
    return spark.createDataFrame([(1, a, k, float(p), 1.0 / k) for a, ps in lists.items() for k, p in enumerate(ps, 1)], "id long, algorithm string, rank int, period double, significance double")


@pytest.mark.parametrize(
    "lists, score, strict, pairs",
    [
        ({"LS": [5, 2.5, 1], "CE": [5, 2.5, 1], "AOV": [5, 2.5, 1]}, 1, 1, 3),
        ({"LS": [1, 1.1, 1.2], "CE": [50, 51, 52], "AOV": [200, 201, 202]}, 0, 0, 0),
        ({"LS": [5, 3], "CE": [10, 7]}, 1, 1, 1),
        ({"LS": [0.001, 0.002], "CE": [0.001, 0.002]}, 0, 0, 0),
        ({"LS": [5, 2.5]}, 0, 0, 0),
        ({"LS": [5, float("nan")], "CE": [5, float("nan")]}, 1, 1, 1),
    ],
)
def test_agreement_scenarios(spark, lists, score, strict, pairs):
    r = agreement.agreement(periods_table(spark, **lists), list(lists))
    r = r.first()
    assert r is None and pairs == 0 or (r.agree_score, r.agree_strict, r.n_agree_pairs) == (score, strict, pairs)


def test_consensus(spark):
    x = periods_table(spark, LS=[5, 10, 1], CE=[5, 10, 2], AOV=[5, 3, 7])
    assert abs(agreement.consensus(x, ["LS", "CE", "AOV"]).first().best_consensus_period / 5 - 1) < 0.05


def test_dmdt_has_unit_length_or_is_zero(spark):
    x = points(spark, [(1, float(k), 17 + (k % 3) * 0.4, 0.1) for k in range(10)] + [(2, 0.0, 17.0, 0.1)])
    found = {r.id: np.array(r.dmdt) for r in curves.dmdt_images(x).collect()}
    assert found[1].shape == (26, 26) and abs(np.linalg.norm(found[1]) - 1) < 1e-5 and not found[2].any()


def test_neighbours_with_missing_periods(spark):
    x = spark.createDataFrame([(1, 95.0, -28.0, 1.0), (2, 95.001, -28.0, None), (3, 95.002, -28.0, 1.0)], "id long, ra double, dec double, period double")
    found = {r.id: r.fraction for r in spatial.neighbour_fraction(x, 5 / 60).collect()}
    assert found == {1: 0.5, 2: 0.0, 3: 0.5}


def test_spatial_join_across_the_meridian_and_the_pole(spark):
    a = spark.createDataFrame([(1, 359.999, 0.0), (2, 10.0, 89.99), (3, 100.0, 20.0)], "id long, ra double, dec double")
    b = spark.createDataFrame([(11, 0.001, 0.0), (12, 190.0, 89.99), (13, 100.0, 21.0)], "rid long, ra double, dec double")
    assert sorted((r.id, r.rid) for r in spatial.within(a, b, 0.05).collect()) == [(1, 11), (2, 12)]


def test_survey_golden_rows(spark, tmp_path):
    flags = "pixelFlags_bad boolean, pixelFlags_cr boolean, pixelFlags_edge boolean, pixelFlags_saturated boolean, pixelFlags_suspect boolean"
    obj = [(579574500513809549, 6.299577852095733, -72.65306479894076, True), (579574500513809560, 6.2976843024706275, -72.65539119051866, True), (579574569233285963, 6.291714462729156, -72.65071261317519, True), (579574500513809614, 6.299677852095733, -72.65296479894076, False)]
    visit = [(2024113000109, 60645.05975877311), (2024120600027, 60651.05833247099), (2024120600053, 60651.07542607068)]
    f = (False,) * 5
    forced = [
        (579574569233285963, 2024120600053, "g", 301.9809875488281, 209.0, *f),
        (579574569233285963, 2024120600027, "r", 604.708984375, 251.61500549316406, *f),
        (579574569233285963, 2024113000109, "r", -469.27099609375, 282.5690002441406, *f),
        (579574500513809560, 2024120600027, "r", 279.75299072265625, 248.8820037841797, *f),
        (579574500513809560, 2024120600053, "g", 814.885986328125, 210.5500030517578, *f),
        (579574500513809560, 2024113000109, "r", 455.89599609375, 288.19500732421875, *f),
        (579574500513809549, 2024120600027, "r", 1219.18994140625, 250.33200073242188, *f),
        (579574500513809549, 2024120600053, "g", 729.5900268554688, 210.42100524902344, *f),
        (579574500513809549, 2024113000109, "r", -121.57099914550781, 285.89801025390625, *f),
    ]
    for name, rows, schema in (("object", obj, survey.OBJECT), ("visit", visit, survey.VISIT), ("forced_source", forced, "objectId long, visit long, band string, psfFlux double, psfFluxErr double, " + flags)):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    s = survey.Survey.read(spark, str(tmp_path))
    ids = s.cone(6.296, -72.653, 60 / 3600)
    assert ids.count() == 3 and s.cone(100, 0, 0.1).count() == 0
    x = clean.with_magnitudes(s.photometry(ids)).withColumn("filter", band_number(F.col("band")))
    assert x.count() == 7 and x.select("id", "band").distinct().count() == 6
    r = x.filter("id = 579574569233285963 and band = 'g'").first()
    assert abs(r.m - 25.200051) < 1e-6 and abs(r.e - 0.751434) < 1e-6 and r.filter == 1
    assert s.photometry(ids, ["i"]).count() == 0


def test_magnitudes_at_known_fluxes(spark):
    x = spark.createDataFrame([(1.0, 0.1), (1e6, 5e4), (-3.0, 1.0)], "f double, d double").select(magnitude(F.col("f")).alias("m"), magnitude_error(F.col("f"), F.col("d")).alias("e")).collect()
    assert abs(x[0].m - 31.4) < 1e-12 and abs(x[1].m - 16.4) < 1e-12 and x[2].m is None and abs(x[1].e - 0.0542868) < 1e-6


def test_names_keep_the_sign_of_small_declinations(spark):
    x = spark.createDataFrame([(0.0, -0.5), (400.0, 0.0)], "ra double, dec double").select(iau_name(F.col("ra"), F.col("dec")).alias("n")).collect()
    assert x[0].n == "ZTFJ000000.00-003000.0" and x[1].n is None


def test_tables_round_trip(spark, tmp_path):
    x = spark.createDataFrame([(1, 2.0, "a"), (2, 3.0, "b")], "id long, v double, field string")
    tables.save_table(x, f"{tmp_path}/t.parquet", {"version": 1}, by=["field"])
    assert tables.load_table(spark, f"{tmp_path}/t.parquet").count() == 2 and tables.read_metadata(spark, f"{tmp_path}/t.parquet") == {"version": 1}
    tables.save_table(x, f"{tmp_path}/t.csv")
    assert tables.load_table(spark, f"{tmp_path}/t.csv").count() == 2
    with pytest.raises(ValueError):
        tables.load_table(spark, "x.h5")
    (tmp_path / "ids.csv").write_text("objectId\n579574500513809549\n")
    assert tables.object_ids(spark, f"{tmp_path}/ids.csv").first().objectId == 579574500513809549
    assert tables.with_known_names(spark.createDataFrame([(1.0, 2.0, 3)], "RA double, Dec double, obj_id int")).columns == ["ra", "dec", "id"]
    (tmp_path / "job.out").write_text("runtime_seconds: 20.0\nn_sources_start: 40\n")
    assert tables.job_seconds(spark, f"{tmp_path}/job.out").first().seconds_per_source == 0.5


def test_nearest_donors_are_found_among_all_rows(spark):
    reference = spark.range(25_000).select("id", F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    rows = spark.createDataFrame([(-k, None, 800.0 * k) for k in range(1, 30)] + [(-30, 1.0, float("nan")), (-30, 2.0, float("nan")), (-31, None, None)], "id long, x double, y double")
    found = modelling.impute_nearest(rows, ["x", "y"], reference).collect()
    assert len(found) == 32 and all(r.x == 800 * -r.id for r in found if r.id > -30)
    assert sorted(r.y for r in found if r.id == -30) == [2.0, 2.0] and all(r.x is None and r.y is None for r in found if r.id == -31)


def test_window_function_adds_up_parts_of_a_field(spark):
    rng = np.random.default_rng(3)
    rows = [(f, float(t)) for f in ("a", None) for t in rng.uniform(5, 90, 300)] + [("b", 1.0)] * 9
    grid = np.linspace(0.05, 1.0, 40)
    visits = spark.createDataFrame(rows, "field string, t double").repartition(6)
    found = periods.window_function(visits, grid)
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().toString()
    got = {(r.field, r.k): r.w for r in found.collect()}
    assert len(got) == 80
    for field in ("a", None):
        t = np.array([x for f, x in rows if f == field])
        x = 2 * np.pi * grid[:, None] * (t - t.min())
        design = [np.linalg.lstsq(np.stack([np.cos(v), np.sin(v)], axis=1), np.ones(len(t)), rcond=None)[0] @ np.array([np.cos(v).sum(), np.sin(v).sum()]) for v in x]
        assert np.allclose([got[field, k] for k in range(40)], np.array(design) / max(design))


def test_network_trains(spark):
    x = spark.createDataFrame([(k, float(k % 7), float(k % 5), int(k % 7 > 3)) for k in range(120)], "id long, a double, b double, y int")
    model = modelling.train_network(x, ["a", "b"], hidden=[4])
    s = modelling.score(x, model, ["a", "b"], "p")
    assert modelling.roc_auc(s).first().auc > 0.9


def test_feature_table_finds_the_period(spark):
    from starfold.plans.features import feature_table

    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(np.sin(2 * np.pi * a / 5) + 11 + rng.normal(0, 0.02)), 0.02) for i in (1, 2) for a in np.sort(rng.uniform(0, 100, 200))]
    found = feature_table(points(spark, rows + [(3, 1.0, 10.0, 0.1)]), max_freq=1.0, top=2).collect()
    assert sorted(r.id for r in found) == [1, 2]
    assert all(min(abs(r.period_1_LS / q - 1) for q in (5, 2.5, 10)) < 0.05 and r.n_total_pairs == 3 and len(r.dmdt) == 26 for r in found)
