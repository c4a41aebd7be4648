"""Thinning of many curves in blocks, once for all that follows."""

from __future__ import annotations

import random

from starfold.operators import clean
from starfold.plans import features


def test_equals_thinning_by_curve(spark):
    rng = random.Random(4)
    pick = lambda: rng.choice([None, rng.uniform(15, 20), 18.0])
    rows = [(i, rng.choice([None, float("nan"), 1.0, 1.4, rng.uniform(0, 9), rng.uniform(0, 9)]), pick(), pick()) for i in range(40) for _ in range(i)]
    points = spark.createDataFrame(rows, "id long, t double, m double, e double")
    for least in (1, 5):
        ours = clean.thin_many(points, 0.5, ["m", "e"], least)
        want = clean.with_minimum(clean.thin(points, 0.5, tie=["m", "e"]), least)
        assert ours.schema == want.schema
        assert 0 < ours.count() and sorted(map(str, ours.collect())) == sorted(map(str, want.collect()))


def test_feature_table_keeps_the_thinned_points(spark):
    rng = random.Random(1)
    rows = [(c, 20 * i / 60 + rng.random() / 10, 18 + rng.random(), 0.1) for c in range(3) for i in range(60)]
    table = features.feature_table(spark.createDataFrame(rows, "id long, t double, m double, e double"), max_freq=2.0, least=10)
    table.collect()
    # the search is kept too, and stands on the kept points: nothing thins by itself
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert table.count() == 3 and plan.count("InMemoryRelation [id") >= 3
    outside = [x for x in plan.splitlines() if "groups" in x.lower() or "FlatMapGroupsInPandas" in x]
    assert not any("keep(" in x for x in outside)
