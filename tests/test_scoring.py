"""Many models in one pass against one model at a time."""

from __future__ import annotations

import random

import numpy as np
import pytest

from starfold.operators import modelling, network, scoring

SCHEMA = "id long, a double, b double, c double, dmdt array<array<double>>, y int"


def table(spark):
    rng = random.Random(0)
    rows = [(i, rng.random(), rng.random(), rng.random(), [[rng.random() for _ in range(14)] for _ in range(14)], 0) for i in range(150)]
    rows = [(i, a, b, c, d, int(a + 0.3 * b > 0.6)) for i, a, b, c, d, _ in rows]
    return spark.createDataFrame(rows + [(900, None, 0.5, 0.5, rows[0][4], 0), (901, 0.5, float("nan"), 0.5, None, 0), (902, None, None, None, None, 0)], SCHEMA)


def test_all_models_equal_one_at_a_time(spark, tmp_path):
    t = table(spark)
    trees, _, _ = modelling.train_trees(t.filter("id < 900"), ["a", "b"], stages=(), most=6)
    trees.write().save(f"{tmp_path}/trees")
    net = network.Network(["b", "c"], (14, 14), hidden=(6, 4), channels=(2, 2, 3, 3), last=4)
    linear = scoring.Linear(["c", "a"], [2.0, -1.0], 0.25, center=[0.5, 0.5], scale=[0.3, 0.2])
    models = {"trees": scoring.Trees.load(spark, f"{tmp_path}/trees", ["a", "b"]), "net": net, "linear": linear, "picture": network.Network([], (14, 14), channels=(2, 2, 2, 2), last=3)}
    many = scoring.score_many(t, models)
    assert many.columns == [*t.columns, *models]
    assert many._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    found = {r.id: r for r in many.collect()}
    for r in modelling.score(t.filter("id < 900"), trees, ["a", "b"], "p").collect():
        assert found[r.id].trees == r.p
    for r in network.score(t, net, "p").collect():
        assert found[r.id].net == r.p
    for r in t.filter("id < 900").collect():
        assert found[r.id].linear == round(1 / (1 + np.exp(-((r.c - 0.5) / 0.3 * 2 - (r.a - 0.5) / 0.2 + 0.25))), 2)
    assert found[900].trees is None and found[900].net is not None and found[900].linear is None and found[900].picture is not None
    assert found[901].trees is None and found[901].net is None and found[901].linear is not None
    assert all(found[902][m] is None for m in models)


def test_limits(spark, monkeypatch):
    t = table(spark).drop("dmdt")
    assert scoring.score_many(t, {}) is t
    monkeypatch.setattr(scoring, "MODEL_BYTES", 10)
    with pytest.raises(ValueError):
        scoring.score_many(t, {"m": scoring.Linear(["a"], [1.0])})


def test_weighted_trees_and_their_measures(spark):
    t = table(spark).filter("id < 900")
    model, importances, _ = modelling.train_trees(t, ["a", "b"], stages=(), most=5, class_weights=(1.0, 4.0))
    plain, _, _ = modelling.train_trees(t, ["a", "b"], stages=(), most=5)
    share = lambda m: modelling.score(t, m, ["a", "b"], "p").agg({"p": "avg"}).first()[0]
    assert share(model) >= share(plain) and [f for f, _ in importances][0] == "a"
    measures = modelling.held_out_measures(t, ["a", "b"], model).first()
    assert measures.auc > 0.9 and 0 <= measures.f1 <= 1
