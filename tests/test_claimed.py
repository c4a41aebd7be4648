"""Objects that several sources claim: the pairs are counted where they are made, and none goes through a shuffle."""

from __future__ import annotations

import random

import pytest

from starfold.operators import curation, spatial
from starfold.plans.catalogue import QUERIES


def places(rng, n):
    """Crowded places, some at a pole, about 0 degrees, far from all, or equally far from two."""
    kinds = [lambda: (rng.uniform(0, 360), rng.uniform(-90, 90)), lambda: (rng.uniform(0, 360), rng.uniform(84, 90)), lambda: (rng.choice([0.0, 359.9, 0.1]), rng.uniform(-3, 3)), lambda: (float(rng.randrange(100, 104)), float(rng.randrange(10, 13)))]
    return [(i, *rng.choice(kinds)()) for i in range(n)]


@pytest.mark.parametrize("n, radius", [(40, 6.0), (300, 6.0), (300, 0.5)])
def test_equals_the_window_over_pairs(spark, n, radius):
    rng = random.Random(n)
    left = spark.createDataFrame(places(rng, n), "id long, ra double, dec double")
    right = spark.createDataFrame(places(rng, 400), "rid long, ra double, dec double")
    ours = spatial.claimed(left, right, radius).select("id", "rid", "claims").collect()
    want = curation.resolve_matches(spatial.within(left, right, radius, deal="right").withColumnRenamed("id", "source")).select("source", "rid", "claims").collect()
    assert want and sorted(map(tuple, ours)) == sorted(map(tuple, want))


def test_query_has_no_window(spark):
    plan = QUERIES["ambiguous_match"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan
