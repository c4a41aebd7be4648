"""The two-branch network: gradients by finite differences, sums over partitions, training and scoring."""

from __future__ import annotations

import copy
import math

import numpy as np
import pytest

from starfold.operators import modelling, network


def jittered(net, seed):
    rng = np.random.default_rng(seed)
    net.weights = {k: v + 0.1 * rng.normal(size=v.shape) for k, v in net.weights.items()}
    return net


@pytest.mark.parametrize("dropping", [None, 5])
@pytest.mark.parametrize(("features", "image"), [(["a", "b", "c"], (14, 15)), ([], (14, 14)), (["a", "b"], None)])
def test_gradients_equal_finite_differences(features, image, dropping):
    rng = np.random.default_rng(0)
    net = jittered(network.Network(features, image, hidden=(7, 5), channels=(2, 3, 2, 3), last=4), 1)
    x, pictures = rng.normal(size=(5, len(features))), rng.normal(size=(5, *(image or (0, 0))))
    y, w = rng.integers(0, 2, 5).astype(float), rng.uniform(0.5, 2, 5)
    drawn = lambda: None if dropping is None else np.random.default_rng(dropping)
    loss, found = net.gradient(x, pictures, y, w, drawn())
    assert set(found) == set(net.weights) and loss > 0
    flat, grad = net.flat(net.weights), net.flat(found)
    for i in rng.choice(len(flat), 80, replace=False):
        ends = []
        for sign in (1, -1):
            other = copy.copy(net)
            moved = flat.copy()
            moved[i] += sign * 1e-6
            other.weights = net.shaped(moved)
            ends.append(other.gradient(x, pictures, y, w, drawn())[0])
        assert math.isclose((ends[0] - ends[1]) / 2e-6, grad[i], rel_tol=1e-4, abs_tol=1e-6)


def test_convolution_by_loops():
    rng = np.random.default_rng(2)
    x, kernel = rng.normal(size=(2, 5, 6, 3)), rng.normal(size=(3, 3, 3))
    found = network.correlate(x, kernel)
    slow = np.array([[[[sum(x[n, i + a, j + b, c] * kernel[a, b, c] for a in range(3) for b in range(3)) for c in range(3)] for j in range(4)] for i in range(3)] for n in range(2)])
    assert np.allclose(found, slow)


def rows(spark, n=160):
    """Class 1 has bright upper halves and a shifted feature; the image alone, or the feature alone, tells most of them."""
    rng = np.random.default_rng(3)
    data = []
    for i in range(n):
        y = i % 2
        image = rng.normal(size=(14, 14)) * 0.2
        image[:7] += 0.5 * y
        data.append((i, float(rng.normal() + y), float(rng.normal()), image.tolist(), y))
    return spark.createDataFrame(data, "id long, a double, b double, dmdt array<array<double>>, y int")


SMALL = {"image_size": (14, 14), "hidden": (8, 6), "channels": (3, 3, 4, 4), "last": 5}


def test_sums_do_not_depend_on_partitions(spark):
    table = rows(spark, 60)
    net = jittered(network.Network(["a", "b"], (14, 14), hidden=(8, 6), channels=(3, 3, 4, 4), last=5), 4)
    full = network.complete(table, net, "dmdt").selectExpr("__x", "__image", "double(y) as __y", "1.0D + y as __w")
    local = full.toPandas()
    loss, grad = net.gradient(np.array(local["__x"].tolist()), np.array(local["__image"].tolist()).reshape(-1, 14, 14), local["__y"].to_numpy(), local["__w"].to_numpy())
    for parts in (1, 3, network.SUMS + 5):
        found = network.step_sums(full.repartition(parts), net)
        assert math.isclose(found[0], local["__w"].sum()) and math.isclose(found[1], loss) and np.allclose(found[2], net.flat(grad))


def test_training_on_both_branches(spark):
    table = rows(spark)
    net = network.train(table, ["a", "b"], steps=24, rate=0.02, batches=2, tasks=2, **SMALL)
    assert net.history[-1][1] < 0.6 * math.log(2) or min(h[2] for h in net.history) < 0.5 * math.log(2)
    scored = network.score(table, net, "p", digits=None)
    assert scored.columns == [*table.columns, "p"]
    auc = modelling.roc_auc(scored).first()[0]
    assert auc > 0.9


def test_missing_values_and_empty_tables(spark):
    net = network.Network(["a", "b"], (14, 14), hidden=(8, 6), channels=(3, 3, 4, 4), last=5)
    image = [[0.0] * 14] * 14
    nan = float("nan")
    data = [(1, 1.0, 2.0, image, 1), (2, None, 2.0, image, 0), (3, 1.0, nan, image, 0), (4, 1.0, 2.0, None, 0), (5, 1.0, 2.0, image[:3], 0), (6, 1.0, 2.0, image, None)]
    table = spark.createDataFrame(data, "id long, a double, b double, dmdt array<array<double>>, y int")
    found = {r.id: r.p for r in network.score(table, net, "p").collect()}
    assert {i for i, p in found.items() if p is not None} == {1, 6} and found[1] == round(found[1], 2)
    trained = network.train(table.filter("id = 2"), ["a", "b"], steps=2, **SMALL)
    assert all((trained.weights[k] == net.weights[k]).all() for k in net.weights)
    with pytest.raises(ValueError):
        network.Network([], None)
