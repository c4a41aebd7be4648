"""Distributed selection against sorting."""

from __future__ import annotations

import random

import numpy as np
import pytest

from starfold.operators import modelling, quantiles

SHARES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]


def columns(n):
    rng = random.Random(n)
    nan = float("nan")
    make = {
        "normal": lambda: rng.gauss(0, 1),
        "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300),
        "near": lambda: 1.0 + rng.randint(0, 9) * 2.0**-52,
        "ties": lambda: float(rng.randint(-1, 1)),
        "gaps": lambda: rng.choice([None, nan, 2.5, -0.0, float("inf"), float("-inf")]),
    }
    return {c: [f() for _ in range(n)] for c, f in make.items()}


def test_keys_have_the_order_of_doubles():
    x = np.array([float("-inf"), -1e300, -2.0, -1.0, -1e-310, 0.0, 1e-310, 1.0, 1.0 + 2**-52, 2.0, 1e300, float("inf")])
    k = quantiles.ordered(x)
    assert (np.diff(k) > 0).all() and (quantiles.values_of(k) == x).all()


@pytest.mark.parametrize("fetched", [0, 30, 100_000])
def test_quantiles_equal_sorting(spark, monkeypatch, fetched):
    monkeypatch.setattr(quantiles, "FETCHED", fetched)
    data = columns(501)
    table = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(3)
    found = quantiles.of_columns(table, list(data), SHARES)
    for c, values in data.items():
        own = np.array([v for v in values if v is not None and v == v])
        low, high = (np.quantile(own, SHARES, method=m) for m in ("lower", "higher"))
        exact = [a if a == b else b if np.isinf(a) or np.isinf(b) else None for a, b in zip(low, high)]
        for got, a, b, same in zip(found[c], low, high, exact):
            assert got == same or a <= got <= b
        if c != "gaps":
            assert np.allclose(found[c], np.quantile(own, SHARES), rtol=1e-12)


def test_feature_stats_and_empty_columns(spark):
    table = spark.createDataFrame([(1.0, None), (2.0, float("nan")), (4.0, None)], "a double, b double")
    r = modelling.feature_stats(table, ["a", "b"]).first()
    assert (r.a_median, r.a_min, r.a_max) == (2.0, 1.0, 4.0) and r.b_median is None
    assert quantiles.of_columns(table.limit(0), ["a"], [0.5]) == {"a": [None]}
    assert modelling.feature_stats(table.limit(0), ["a"]).first().a_median is None
