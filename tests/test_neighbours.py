"""The index of donors against comparing every row with every donor."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold.operators import neighbours

NAN = float("nan")


def table(spark, n, seed, missing=0.15):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, NAN]) if rng.random() < missing else float(rng.randint(0, 12)) if seed % 2 else rng.gauss(0, 3)
    rows = [(i, value(), value(), value()) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, x double, y double, z double")


def brute(rows, donors, k):
    clean = lambda r: np.array([NAN if v is None else v for v in r[1:]], dtype=float)
    known = [(d[0], clean(d)) for d in donors]
    out = {}
    for r in rows:
        row = clean(r)
        for j in np.flatnonzero(np.isnan(row)):
            near = []
            for i, d in known:
                both = ~np.isnan(d) & ~np.isnan(row)
                if both.any() and not np.isnan(d[j]):
                    near.append((float((np.where(both, d - row, 0.0) ** 2).sum() * 3 / both.sum()), i, d[j]))
            best = sorted(near)[:k]
            row_value = np.mean([v for _, _, v in best]) if best else None
            out[r[0], int(j)] = row_value
    return out


@pytest.mark.parametrize(("seed", "cell", "visitors"), [(1, 10, 20_000), (2, 25, 3), (3, 1000, 20_000)])
def test_imputation_equals_brute_force(spark, monkeypatch, seed, cell, visitors):
    monkeypatch.setattr(neighbours, "VISITORS", visitors)
    rows, t = table(spark, 60, seed, 0.3)
    donors, reference = table(spark, 200, seed + 10)
    found = {r.id: (r.x, r.y, r.z) for r in neighbours.impute_nearest(t, ["x", "y", "z"], reference, 4, cell).collect()}
    expected = brute(rows, donors, 4)
    for (i, j), value in expected.items():
        got = found[i][j]
        assert (got is None) == (value is None) and (value is None or abs(got - value) < 1e-9)
    for r in rows:
        for j, v in enumerate(r[1:]):
            assert v is None or v != v or found[r[0]][j] == v


def test_far_fewer_pairs_than_all(spark):
    rng = np.random.default_rng(0)
    points = rng.uniform(0, 100, (6000, 3))
    reference = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, x double, y double, z double")
    rows = reference.filter("id < 300").withColumns({"z": F.lit(None).cast("double"), "__row": F.col("id").cast("string")}).select("__row", "x", "y", "z")
    index = neighbours.Index(reference, ["x", "y", "z"], 60)
    size = {r["__cell"]: r["count"] for r in index.donors.groupBy("__cell").count().collect()}
    first = index.first_visits(rows, 5)
    best = index.nearest(first, 5)
    worst = {r["__row"]: sorted(x.distance for x in best.filter(F.col("__row") == r["__row"]).collect())[4] for r in rows.limit(3).collect()}
    bounds = spark.createDataFrame([(k, [0.0, 0.0, v]) for k, v in worst.items()], "__row string, __bounds array<double>")
    visited = index.further_visits(rows.join(bounds, "__row"), 5)
    pairs = sum(size[r["__cell"]] for r in visited.collect())
    assert max(size.values()) <= 200 and pairs < 0.1 * 3 * 6000


def test_odd_tables(spark):
    schema = "id long, x double, y double"
    none = spark.createDataFrame([], schema)
    t = spark.createDataFrame([(1, None, 2.0), (2, None, None), (3, 1.0, 2.0)], schema)
    assert {r.id: r.x for r in neighbours.impute_nearest(t, ["x", "y"], none).collect()} == {1: None, 2: None, 3: 1.0}
    assert neighbours.impute_nearest(none, ["x", "y"], t).count() == 0
    same = spark.createDataFrame([(i, float(i), 2.0) for i in range(10, 20)] + [(1, None, 2.0)], schema)
    # all donors are equally far: the least ids count
    assert {r.id: r.x for r in neighbours.impute_nearest(t, ["x", "y"], same, 3).collect()} == {1: 11.0, 2: None, 3: 1.0}


def looked_up(monkeypatch):
    """The rows that an index is asked for, as they come."""
    seen, plain = [], neighbours.Index.best

    def best(self, rows, k):
        seen.append(rows.collect())
        return plain(self, rows, k)

    monkeypatch.setattr(neighbours.Index, "best", best)
    return seen


def test_rows_with_the_same_features_are_looked_up_once(spark, monkeypatch):
    seen = looked_up(monkeypatch)
    schema = "id long, x double, y double"
    rows = [(i, None, float(i % 3)) for i in range(90)] + [(i, float(i), float(i % 3)) for i in range(90, 120)]
    found = {r.id: r.x for r in neighbours.impute_nearest(spark.createDataFrame(rows, schema), ["x", "y"], spark.createDataFrame(rows, schema), 2).collect()}
    assert len(seen[0]) == 3
    assert found == {i: 91.5 + i % 3 if i < 90 else float(i) for i in range(120)}


def test_only_rows_that_lack_the_feature_are_looked_up(spark, monkeypatch):
    from starfold.plans import catalogue

    seen = looked_up(monkeypatch)
    assert catalogue.QUERIES["impute_knn"](spark, "/root/testdata/sf0.001").count()
    assert seen[0] and all(r["x"] is None for r in seen[0])
