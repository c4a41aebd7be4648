"""Nearest donors under distances that leave missing features out, by an exact index instead of all pairs.

Donors that lack the same features form a pattern; between a row and a pattern the shared features, and so the scaling, are fixed.  A pattern's donors are cut into
cells by splits at medians (of a bounded sample; they only decide how well the index prunes) and every cell has the exact bounds of its donors.

* First a row visits the nearest cells that hold enough donors; the k-th best distance found there bounds the rest.
* Then it visits every other cell whose bounds lie no farther.  No donor that could be among the best is missed.

The cells' bounds are the one thing that goes to all tasks; there are at most ``CELLS`` of them, cells growing with the table.  A cell that very many rows visit is
copied, so that no task gets more than ``VISITORS`` of them at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.functions.photometry import null_nan

#: Donors of a cell, about; cells at most; rows of the sample that splits come from; rows that visit one copy of a cell.
CELL, CELLS, SAMPLE, VISITORS = 2_000, 50_000, 100_000, 20_000


@dataclass
class Splits:
    """For each pattern of present features a binary tree of splits as nested tuples (feature, value, left, right); leaves are cell numbers."""

    trees: dict[int, tuple | int]
    cells: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row; patterns that the sample didn't have share one cell each, numbered from ``cells`` on."""
        pattern = patterns(x)
        out = np.empty(len(x), dtype=np.int64)
        for p in np.unique(pattern):
            at = np.flatnonzero(pattern == p)
            waiting = [(self.trees.get(int(p), self.cells + int(p)), at)]
            while waiting:
                node, rows = waiting.pop()
                if isinstance(node, int):
                    out[rows] = node
                    continue
                feature, value, left, right = node
                low = x[rows, feature] < value
                waiting += (left, rows[low]), (right, rows[~low])
        return out


def patterns(x: np.ndarray) -> np.ndarray:
    return (~np.isnan(x)).astype(np.int64) @ (1 << np.arange(x.shape[1], dtype=np.int64))


def splits_of(sample: np.ndarray, total: int, cell: int) -> Splits:
    """Median splits along the widest feature until a cell has about ``cell`` of all ``total`` donors."""
    least = max(1, int(cell * len(sample) / max(total, 1)))
    count = [0]

    def cut(rows: np.ndarray, present: list[int]) -> tuple | int:
        if len(rows) > 2 * least:
            spread = np.ptp(rows[:, present], axis=0)
            feature = present[int(np.argmax(spread))]
            value = float(np.median(rows[:, feature]))
            low = rows[:, feature] < value
            if low.any() and spread.max() > 0:
                return feature, value, cut(rows[low], present), cut(rows[~low], present)
        count[0] += 1
        return count[0] - 1

    trees = {}
    pattern = patterns(sample)
    for p in np.unique(pattern):
        trees[int(p)] = cut(sample[pattern == p], [j for j in range(sample.shape[1]) if p >> j & 1])
    return Splits(trees, count[0])


@dataclass
class Cells:
    """Number, bounds and donors of each feature of every cell, one row each."""

    number: np.ndarray
    low: np.ndarray
    high: np.ndarray
    donors: np.ndarray

    def distances(self, row: np.ndarray) -> np.ndarray:
        """The least squared distance that a donor of each cell can have; infinite where nothing is shared."""
        off = np.maximum(np.maximum(self.low - row, row - self.high), 0)
        shared = (~np.isnan(off)).sum(axis=1)
        return np.where(shared > 0, np.nansum(off**2, axis=1) * len(row) / np.maximum(shared, 1), np.inf)


def best_in(row: np.ndarray, y: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, float, int]]:
    """(feature, distance, donor's index) of the ``k`` nearest donors for each feature that the row lacks."""
    both = ~np.isnan(y) & ~np.isnan(row)
    shared = both.sum(axis=1)
    distance = np.where(shared > 0, (np.where(both, y - row, 0.0) ** 2).sum(axis=1) * len(row) / np.maximum(shared, 1), np.inf)
    out = []
    for j in np.flatnonzero(np.isnan(row)):
        able = np.flatnonzero(~np.isnan(y[:, j]) & np.isfinite(distance))
        if len(able) > k:
            # all that are no farther than the k-th, for ties
            able = able[distance[able] <= np.partition(distance[able], k - 1)[k - 1]]
        out += [(int(j), float(distance[b]), int(b)) for b in able[np.lexsort((ids[able], distance[able]))][:k]]
    return out


class Index:
    """Donors (id and features, any of them missing) in cells."""

    def __init__(self, donors: DataFrame, features: Sequence[str], cell: int = CELL):
        self.own, self.spark = list(features), donors.sparkSession
        own, plain = self.own, donors.select("id", *[null_nan(F.col(c).cast("double")).alias(c) for c in features])
        plain = plain.filter(F.coalesce(*own).isNotNull())
        total = plain.count()
        share = max(1, total // SAMPLE)
        sample = plain.filter(F.pmod(F.xxhash64("id", *own), F.lit(share)) == 0).select(*own).limit(2 * SAMPLE).toPandas()
        splits = splits_of(sample.to_numpy(dtype=float).reshape(-1, len(own)), total, max(cell, total // CELLS))

        @F.arrow_udf("bigint")
        def place(x: pa.Array) -> pa.Array:
            return pa.array(splits.of(matrix(x, len(own))))

        filled = F.array(*[F.coalesce(F.col(c), F.lit(float("nan"))) for c in own])
        self.donors = plain.withColumn("__cell", place(filled))
        facts = [f(c).alias(f"{name}{j}") for j, c in enumerate(own) for name, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]
        rows = self.donors.groupBy("__cell").agg(*facts).toPandas()
        of = lambda name: np.column_stack([rows[f"{name}{j}"].to_numpy(dtype=float) for j in range(len(own))])
        self.cells = Cells(rows["__cell"].to_numpy(), of("lo"), of("hi"), of("n"))

    def first_visits(self, rows: DataFrame, k: int) -> DataFrame:
        """(__row, features, __cell): the nearest cells that hold ``k`` donors of each missing feature together."""

        def wanted(row: np.ndarray, bounds: np.ndarray | None) -> np.ndarray:
            cells = sent.value
            distance = cells.distances(row)
            order = np.argsort(distance, kind="stable")
            order = order[np.isfinite(distance[order])]
            out = np.zeros(len(distance), dtype=bool)
            for j in np.flatnonzero(np.isnan(row)):
                held = np.cumsum(cells.donors[order, j])
                out[order[: int(np.searchsorted(held, k)) + 1]] = True
            return out

        sent = self.spark.sparkContext.broadcast(self.cells)
        return self.visits(rows, wanted, sent)

    def further_visits(self, rows: DataFrame, k: int) -> DataFrame:
        """The same for all other cells that may hold a donor as near as the ``k``-th of the first visits (``__bounds``: one for each feature)."""

        def wanted(row: np.ndarray, bounds: np.ndarray) -> np.ndarray:
            cells = sent.value
            distance = cells.distances(row)
            out = np.zeros(len(distance), dtype=bool)
            for j in np.flatnonzero(np.isnan(row)):
                out |= (distance <= bounds[j] * (1 + 1e-9)) & np.isfinite(distance) & (cells.donors[:, j] > 0)
            return out

        sent = self.spark.sparkContext.broadcast(self.cells)
        return self.visits(rows, wanted, sent)

    def visits(self, rows: DataFrame, wanted, sent) -> DataFrame:
        n = len(self.own)

        @F.arrow_udf("array<bigint>")
        def to(x: pa.Array, bounds: pa.Array) -> pa.Array:
            found = [sent.value.number[wanted(row, b)] for row, b in zip(matrix(x, n), matrix(bounds, n))]
            return pa.array([f.tolist() for f in found], pa.list_(pa.int64()))

        filled = lambda c: F.coalesce(F.col(c), F.lit(float("nan")))
        bounds = F.col("__bounds") if "__bounds" in rows.columns else F.array_repeat(F.lit(float("inf")), n)
        cells = F.explode(to(F.array(*map(filled, self.own)), bounds)).alias("__cell")
        return rows.select("__row", *self.own, cells)

    def nearest(self, visits: DataFrame, k: int) -> DataFrame:
        """(__row, j, distance, donor, value): the best of each visited cell."""
        own, kind = self.own, dict(self.donors.dtypes)["id"]
        busy = visits.groupBy("__cell").count().filter(F.col("count") > VISITORS).select("__cell", F.ceil(F.col("count") / VISITORS).cast("int").alias("copies"))
        # at most one row for each cell
        busy = F.broadcast(self.spark.createDataFrame([tuple(r) for r in busy.collect()], "__cell long, copies int"))
        copies = F.coalesce("copies", F.lit(1))
        left = visits.join(busy, "__cell", "left").withColumn("__copy", F.pmod(F.xxhash64("__row"), copies).cast("int"))
        right = self.donors.join(busy, "__cell", "left").withColumn("__copy", F.explode(F.sequence(F.lit(0), copies - 1)))

        def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            found: list[tuple] = []
            x, y, ids = left[own].to_numpy(dtype=float), right[own].to_numpy(dtype=float), right["id"].to_numpy()
            if len(y):
                for key, row in zip(left["__row"], x):
                    found += [(key, j, d, ids[b], y[b, j]) for j, d, b in best_in(row, y, ids, k)]
            return pd.DataFrame(found, columns=["__row", "j", "distance", "donor", "value"])

        groups = left.select("__row", *own, "__cell", "__copy").groupBy("__cell", "__copy").cogroup(right.select("id", *own, "__cell", "__copy").groupBy("__cell", "__copy"))
        return groups.applyInPandas(lambda a, b: work(a, b), f"__row string, j int, distance double, donor {kind}, value double")

    def best(self, rows: DataFrame, k: int) -> DataFrame:
        """(__row, j, distance, donor, value): the ``k`` nearest donors of each feature that a row (``__row`` and features) lacks; ties go to
        the least donor, then the least value."""
        order = Window.partitionBy("__row", "j").orderBy("distance", "donor", "value")
        top = lambda found: found.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k)
        first = top(self.nearest(self.first_visits(rows, k), k))
        worst = first.groupBy("__row", "j").agg(F.max(F.when(F.col("__r") == k, F.col("distance"))).alias("u"))
        bounds = worst.groupBy("__row").agg(*[F.max(F.when(F.col("j") == j, F.col("u"))).alias(f"u{j}") for j in range(len(self.own))])
        infinite = float("inf")
        bounded = rows.join(bounds, "__row", "left").withColumn("__bounds", F.array(*[F.coalesce(f"u{j}", F.lit(infinite)) for j in range(len(self.own))]))
        seen = self.first_visits(rows, k).select("__row", "__cell")
        more = self.further_visits(bounded, k).join(seen, ["__row", "__cell"], "left_anti").select("__row", *self.own, "__cell")
        fields = ["__row", "j", "distance", "donor", "value"]
        return top(first.select(*fields).union(self.nearest(more, k))).select(*fields)


def matrix(x: pa.Array, n: int) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), n)


def impute_nearest(table: DataFrame, features: Sequence[str], reference: DataFrame, k: int = 5, cell: int = CELL) -> DataFrame:
    """Fills missing values with the mean of the ``k`` nearest reference rows that have them; ties go to the least id.

    Distances use the features that both rows have, scaled up to all; a value of which no donor shares a feature stays missing.
    """
    own = list(features)
    plain = table.select("id", *[null_nan(F.col(c).cast("double")).alias(c) for c in own])
    lacks = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in own])
    # rows with the same features get the same values and are looked up once, whatever their ids; the values of rows that lack nothing are there
    keyed = plain.withColumn("__row", F.to_json(F.struct(*own)))
    rows = keyed.filter(lacks).dropDuplicates(["__row"]).select("__row", *own)
    best = Index(reference, own, cell).best(rows, k)
    values = best.groupBy("__row").agg(*[F.avg(F.when(F.col("j") == j, F.col("value"))).alias(f"__{j}") for j in range(len(own))])
    return keyed.join(values, "__row", "left").select("id", *[F.coalesce(F.col(c), F.col(f"__{j}")).alias(c) for j, c in enumerate(own)])
