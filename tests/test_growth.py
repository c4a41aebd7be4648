"""Steps whose tasks must not grow with the table: plans and results of operators by curve and by source."""

from __future__ import annotations

import math
import random
import re

import numpy as np

from starfold.operators import agreement, cadence, curves, periods, predictions

NAMES = ["LS", "CE", "AOV"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def found(spark):
    rng = random.Random(5)
    rows = [(i, a, r, rng.choice([0.004, 0.5, 1.0, 1.01, 2.0, 3.0, 0.997, None, float("nan"), rng.uniform(0.01, 9)]), rng.uniform(1, 9)) for i in range(40) for a in NAMES for r in (1, 2, 3)]
    rows += [(99, "CE", 1, None, None), (98, "other", 1, 2.0, 1.0)]
    return spark.createDataFrame(rows, "id long, algorithm string, rank int, period double, significance double"), rows


def test_consensus_by_blocks_of_curves(spark):
    df, rows = found(spark)
    out = agreement.consensus(df, NAMES)
    assert "FlatMapGroupsInPandas" not in plan(out)
    ours = {r["id"]: r["best_consensus_period"] for r in out.collect()}
    assert set(ours) == {r[0] for r in rows}
    for i, p in ours.items():
        own = sorted((NAMES.index(a), r, q) for j, a, r, q, _ in rows if j == i and a in NAMES and q is not None and q >= agreement.SHORTEST)
        want = agreement.consensus_of(own)
        assert p is None if math.isnan(want) else p == want


def test_families_by_blocks_of_curves(spark):
    df, rows = found(spark)
    out = agreement.sidereal_families(df)
    assert "FlatMapGroupsInPandas" not in plan(out)
    ours = {r["id"]: r for r in out.collect()}
    assert set(ours) == {r[0] for r in rows}
    for i, r in ours.items():
        assert r["family_n_total"] == sum(1 for j, _, _, q, _ in rows if j == i and q is not None and q > 0)
    assert tuple(ours[99])[1:] == (0, 0.0, 0, 0, None, "")
    assert ours[98]["family_best_period"] == 2.0 and ours[98]["family_best_algo"] == "other"


def test_agreement_sends_no_side_to_all_tasks(spark):
    df, _ = found(spark)
    for out in (agreement.agreement(df, NAMES), agreement.simple_agreement(df, NAMES), agreement.sidereal_edges(df)):
        p = plan(out)
        assert "Broadcast" not in p
        # one stated number of tasks, which adaptive execution leaves as it is
        assert set(re.findall(r"hashpartitioning\(id[^)]*\), (\w+)", p)) == {"REPARTITION_BY_NUM"}


def test_merged_models_of_few_sources_are_dealt(spark):
    a = spark.createDataFrame([(o, s, 0.1 * s) for o in (0, 1, None) for s in range(50)], "obj_id long, survey_id long, vnv_dnn double")
    b = spark.createDataFrame([(o, s, 0.2 * s) for o in (1, 2, None) for s in range(25, 75)], "obj_id long, survey_id long, vnv_xgb double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = predictions.merge_models(a, b)
        joins = [line for line in plan(out).splitlines() if "Join" in line]
        assert joins and all("__share" in line for line in joins)
        ours = {(r["obj_id"], r["survey_id"]): r["vnv"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {(1, s): 0.1 * s if s < 25 else 0.2 * s if s >= 50 else 0.15 * s for s in range(75)}
    assert set(ours) == set(want) and all(math.isclose(ours[k], v, abs_tol=1e-12) for k, v in want.items())


def test_searched_fourier_is_one_pass(spark):
    rng = random.Random(7)
    rows = [(i, rng.uniform(0, 30), rng.gauss(20, 1), 0.1) for i in range(3) for _ in range(40)] + [(9, 1.0, 20.0, 0.1)]
    x = spark.createDataFrame(rows, "id long, t double, m double, e double")
    freqs = np.linspace(0.05, 5, 400)
    one = periods.searched_fourier(x, freqs)
    assert plan(one).count("FlatMapGroupsInPandas") == 1 and "Join" not in plan(one)
    two = periods.fourier(x, periods.search(x, freqs, ["LS"], 1).select("id", "period"))
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    without = cadence.curve_features(x, pairs=False)
    assert without.columns == ["id", *cadence.WALK_FEATURES]
    assert sorted(map(str, without.collect())) == sorted(map(str, cadence.curve_features(x).select(without.columns).collect()))


def test_images_by_blocks_of_curves(spark):
    rng = random.Random(9)
    rows = [(i, rng.uniform(0, 300), rng.gauss(20, 1)) for i in range(30) for _ in range(12)] + [(98, 1.0, None), (99, 1.0, 20.0)]
    out = curves.dmdt_images(spark.createDataFrame(rows, "id long, t double, m double"))
    assert "FlatMapGroupsInPandas" not in plan(out) and "Join" not in plan(out)
    ours = {r["id"]: np.array(r["dmdt"]) for r in out.collect()}
    assert set(ours) == {r[0] for r in rows} and not ours[98].any() and not ours[99].any()
    for i in range(30):
        own = np.array(sorted(r[1:] for r in rows if r[0] == i))
        n = curves.dmdt_histogram(own[:, 0], own[:, 1])
        assert np.array_equal(ours[i], (n / np.sqrt((n * n).sum())).astype(np.float32))
