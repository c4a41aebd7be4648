"""Scoring with many models in one pass over a table, as with one model for each class.

Every model has its own list of features.  The table's features are gathered once; a task gets them as Arrow batches and evaluates all
models on them, so the number of scans and of columns that travel doesn't grow with the models.  Models go to the tasks by broadcast after their size was
checked.

Defined results: a row that lacks a feature of a model (NULL or NaN), or the image where it takes one, has NULL for this model alone; without models
the table stays as it is.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.photometry import null_nan
from starfold.operators.network import Network

#: Bytes of all models that are sent to the tasks.
MODEL_BYTES = 256 << 20


@dataclass
class Linear:
    """Logistic regression on features that are shifted and scaled first."""

    features: list[str]
    weights: list[float]
    intercept: float = 0.0
    center: list[float] | None = None
    scale: list[float] | None = None

    def predict(self, x: np.ndarray, image: np.ndarray | None = None) -> np.ndarray:
        if self.center is not None:
            x = x - np.array(self.center)
        if self.scale is not None:
            x = x / np.array(self.scale)
        return 1 / (1 + np.exp(-(x @ np.array(self.weights) + self.intercept)))


@dataclass
class Trees:
    """Boosted trees as arrays: for each tree the feature and threshold of its nodes, their children and values; all rows go down at once."""

    features: list[str]
    feature: list[np.ndarray]
    threshold: list[np.ndarray]
    children: list[np.ndarray]
    value: list[np.ndarray]
    weight: list[float]

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: list[str]) -> Trees:
        """A saved model of boosted trees with continuous features.  It comes to the driver, as any model that is sent to the tasks."""
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").toPandas()
        kinds = spark.read.parquet(f"{path}/treesMetadata")
        number, _, weight = kinds.columns
        weights = {r[0]: r[1] for r in kinds.select(number, weight).collect()}
        out = cls(features, [], [], [], [], [])
        for tree, part in nodes.groupby("treeID"):
            if any(s["numCategories"] > 0 for s in part["split"]):
                raise ValueError("categorical splits aren't supported")
            inner = part["leftChild"].to_numpy() >= 0
            out.feature.append(np.where(inner, [s["featureIndex"] for s in part["split"]], -1))
            out.threshold.append(np.array([s["leftCategoriesOrThreshold"][0] if len(s["leftCategoriesOrThreshold"]) else np.nan for s in part["split"]]))
            out.children.append(part[["leftChild", "rightChild"]].to_numpy())
            out.value.append(part["prediction"].to_numpy())
            out.weight.append(weights[tree])
        return out

    def predict(self, x: np.ndarray, image: np.ndarray | None = None) -> np.ndarray:
        margin = np.zeros(len(x))
        for feature, threshold, children, value, weight in zip(self.feature, self.threshold, self.children, self.value, self.weight):
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                inner = np.flatnonzero(feature[node] >= 0)
                if not len(inner):
                    break
                at = node[inner]
                node[inner] = children[at, (x[inner, feature[at]] > threshold[at]).astype(np.int64)]
            margin += weight * value[node]
        return 1 / (1 + np.exp(-2 * margin))


Model = Linear | Trees | Network


def score_many(table: DataFrame, models: dict[str, Model], image: str = "dmdt", digits: int | None = 2) -> DataFrame:
    """Adds a column for each model: the probability of class 1, rounded half to even to ``digits``."""
    if not models:
        return table
    size = len(pickle.dumps(models))
    if size > MODEL_BYTES:
        raise ValueError(f"the models have {size} bytes; at most {MODEL_BYTES} may be sent to the tasks")
    names = list(models)
    columns = list(dict.fromkeys(c for m in models.values() for c in m.features))
    place = {c: k for k, c in enumerate(columns)}
    shapes = {m.image for m in models.values() if isinstance(m, Network) and m.image}
    if len(shapes) > 1:
        raise ValueError("all networks take the same image")
    shape = next(iter(shapes), None)
    sent = table.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("array<double>")
    def work(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for features, flat in parts:
            n = len(features)
            x = np.full((n, 0), 0.0) if not place else features.flatten().to_numpy(zero_copy_only=False).reshape(n, len(place))
            has = flat.is_valid().to_numpy(zero_copy_only=False) if shape else np.zeros(n, dtype=bool)
            pictures = flat.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, *shape) if shape else np.zeros((0, 0, 0))
            row = np.cumsum(has) - 1
            out = np.full((n, len(names)), np.nan)
            for k, model in enumerate(sent.value.values()):
                own = x[:, [place[c] for c in model.features]]
                full = ~np.isnan(own).any(axis=1)
                if isinstance(model, Network) and model.image:
                    full &= has
                    out[full, k] = model.predict(own[full], pictures[row[full]])
                else:
                    out[full, k] = model.predict(own[full], np.zeros((int(full.sum()), 0, 0)))
            yield pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(names)), pa.array(out.ravel()))

    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns]) if columns else F.array().cast("array<double>")
    flat = F.flatten(image).cast("array<double>") if shape else F.lit(None).cast("array<double>")
    size = shape[0] * shape[1] if shape else 0
    made = table.withColumns({"__x": x, "__flat": F.when((F.size(flat) == size) & ~F.exists(flat, lambda v: v.isNull() | F.isnan(v)), flat) if shape else flat})
    scored = made.withColumn("__p", work("__x", "__flat"))
    p = lambda k: null_nan(F.col("__p")[k])
    return scored.select(*[c for c in table.columns if c not in models], *[(p(k) if digits is None else F.bround(p(k), digits)).alias(c) for k, c in enumerate(names)])
