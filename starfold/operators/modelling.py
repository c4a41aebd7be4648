"""Feature tables for models: statistics, imputation, scaling, splits, weights, classifiers and metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.functions.photometry import null_nan
from starfold.operators import quantiles
from starfold.operators.neighbours import impute_nearest


def feature_stats(table: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: {feature}_{min,max,median,mean,std} without NULL and NaN; the standard deviation is the population's.

    Medians are exact and come from :mod:`starfold.operators.quantiles`, which holds no column's values in one place.
    """
    medians = quantiles.of_columns(table, features, [0.5])
    out = []
    for c in features:
        x = null_nan(F.col(c).cast("double"))
        out += [F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max"), F.first(F.lit(medians[c][0]).cast("double")).alias(f"{c}_median"), F.avg(x).alias(f"{c}_mean"), F.stddev_pop(x).alias(f"{c}_std")]
    return table.agg(*out)


def impute(table: DataFrame, strategies: dict[str, str], reference: DataFrame | None = None, k: int = 5) -> DataFrame:
    """Fills missing values (NULL or NaN), in this order: ``zero``; ``median`` and ``mean`` of ``reference``, or of the table; ``regress``, by
    :func:`impute_nearest` on the features that have this strategy (the table needs an ``id``); at last ``none`` drops rows without the value."""
    of = lambda *names: [c for c, s in strategies.items() if s in names]
    filled = table.withColumns({c: null_nan(F.col(c).cast("double")) for c in strategies})
    known = reference if reference is not None else table
    values = known.transform(feature_stats, of("median", "mean")).first() if of("median", "mean") else {}
    fill = {c: 0.0 for c in of("zero")} | {c: values[f"{c}_{strategies[c]}"] for c in of("median", "mean") if values[f"{c}_{strategies[c]}"] is not None}
    filled = filled.na.fill(fill) if fill else filled
    if near := of("regress"):
        found = impute_nearest(filled.select("id", *near), near, known, k)
        filled = filled.drop(*near).join(found, "id")
    return filled.na.drop(subset=of("none")).select(table.columns)


def missing_flags(table: DataFrame, features: Sequence[str]) -> DataFrame:
    """(id, missing): names of the features that a row lacks."""
    lacks = F.array(*[F.when(null_nan(F.col(c).cast("double")).isNull(), F.lit(c)) for c in features])
    return table.select("id", F.filter(lacks, lambda x: x.isNotNull()).alias("missing"))


def scaled(table: DataFrame, features: Sequence[str], stats: dict[str, float], method: str = "min_max") -> DataFrame:
    """``min_max`` or ``median_std`` scaling; a feature without spread or statistics stays as it is."""

    def one(c: str) -> Column:
        std = stats.get(f"{c}_std")
        if not std:
            return F.col(c)
        if method == "min_max":
            return (F.col(c) - stats[f"{c}_min"]) / (stats[f"{c}_max"] - stats[f"{c}_min"])
        return (F.col(c) - stats[f"{c}_median"]) / std

    return table.withColumns({c: one(c) for c in features})


def binary_label(table: DataFrame, column: str, threshold: float = 0.5, out: str = "y") -> DataFrame:
    return table.withColumn(out, (F.col(column) > threshold).cast("int"))


def hash_order(key: Column, seed: int) -> Column:
    """A hash of a key as hexadecimal text: random choices go by its order, so they are the same however the rows are dealt."""
    return F.md5(F.concat_ws("/", key.cast("string"), F.lit(str(seed))))


def up_to_row(key: Column, seed: int, last) -> Column:
    """Whether a key stands no later in :func:`hash_order` than the row ``last`` (h, k)."""
    h = hash_order(key, seed)
    return (h < last["h"]) | ((h == last["h"]) & (key <= last["k"]))


def split_of(key: Column, seed: int = 42, test: float = 0.1, validation: float = 0.1) -> Column:
    """train, val or test by a hash of the key."""
    below = lambda share: F.substring(hash_order(key, seed), 1, 8) < f"{min(int(share * 2**32), 2**32 - 1):08x}"
    return F.when(below(test), "test").when(below(test + (1 - test) * validation), "val").otherwise("train")


def downsampled(table: DataFrame, balance: float, label: str = "y", key: str = "id", seed: int = 1) -> DataFrame:
    """Adds ``kept``: all rows of the smaller class, and of the larger at most ``balance`` times as many, by hash order.

    The rows that aren't kept stay in the table, as the dropped set.
    """
    counts = {r[label]: r["n"] for r in table.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    few, many = min(counts.get(0, 0), counts.get(1, 0)), max(counts.get(0, 0), counts.get(1, 0))
    keep, large = int(min(many, few * balance)), (1 if counts.get(1, 0) > counts.get(0, 0) else 0)
    order = F.struct(hash_order(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    # the last row of the larger class that is kept: a top-k of which only the end comes to the driver
    major = table.filter(F.col(label) == large).select(order.alias("o"))
    last = major.orderBy("o").offset(keep - 1).limit(1).first() if keep else None
    inside = up_to_row(F.col(key), seed, last["o"]) if last else F.lit(False)
    return table.withColumn("kept", (F.col(label) != large) | inside)


def class_weights(table: DataFrame, label: str = "y") -> DataFrame:
    """Weights 1 / count of each class, scaled so that the larger is 1, and their ratio."""
    n = table.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    w0, w1 = F.try_divide(F.lit(1.0), F.col("n0")), F.try_divide(F.lit(1.0), F.col("n1"))
    top = F.greatest(w0, w1)
    return n.select("n0", "n1", (w0 / top).alias("weight0"), (w1 / top).alias("weight1"), (w1 / w0).alias("scale_pos_weight"))


def confusion(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """Shares of the four outcomes and the measures from them; a score counts as 1 if it rounds (half to even) to 1."""
    hit = F.bround(F.col(score)) == 1
    yes = F.col(label) == 1
    n = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit & yes).alias("tp"), F.count_if(hit & ~yes).alias("fp"), F.count_if(~hit & yes).alias("fn"), F.count_if(~hit & ~yes).alias("tn"))
    c = {k: F.col(k) for k in ("n", "tp", "fp", "fn", "tn")}
    precision, recall = F.try_divide(c["tp"], c["tp"] + c["fp"]), F.try_divide(c["tp"], c["tp"] + c["fn"])
    return n.select(
        *[F.try_divide(c[k], c["n"]).alias(f"{k}_share") for k in ("tp", "fp", "fn", "tn")],
        F.try_divide(c["tp"] + c["tn"], c["n"]).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1"),
    )


def roc_points(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """(score, tp, fp): cumulated counts at each distinct score, from high to low.  Distinct scores alone are ordered."""
    each = scored.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    down = Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    return each.select(score, F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"), "pos", "neg")


def roc_auc(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """Area under the ROC curve by ranks; ties count half."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2))
    return roc_points(scored, label, score).agg(F.try_divide(area, F.sum("pos") * F.sum("neg")).alias("auc"))


def precision_recall(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """(score, precision, recall): the curve's points, one for each distinct score as the threshold."""
    total = F.sum("pos").over(Window.partitionBy())
    return roc_points(scored, label, score).select(score, (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide("tp", total).alias("recall"))


def class_gate(labels: DataFrame, thresholds: dict[str, float], min_count: int) -> DataFrame:
    """(class, n_positive) of the classes that have more than ``min_count`` examples above their threshold: those worth a model."""
    counts = labels.agg(*[F.count_if(F.col(c) > t).alias(c) for c, t in thresholds.items()])
    return counts.unpivot([], list(thresholds), "class", "n_positive").filter(F.col("n_positive") > min_count)


def latest(rows: DataFrame, by: str, created: str, columns: Sequence[str]) -> DataFrame:
    """The most recent row of each ``by``: its time and ``columns``; equal times go to the largest columns."""
    newest = F.max(F.struct(created, *columns)).alias("x")
    return rows.groupBy(by).agg(newest).select(by, "x.*")


def assemble(table: DataFrame, features: Sequence[str], label: str = "y") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip").transform(table).withColumn(label, F.col(label).cast("double"))


#: Parameters of boosted trees that are tuned one stage after another, each stage keeping the best of those before.
STAGES = ({"maxDepth": (3, 5)}, {"minInstancesPerNode": (1, 5)}, {"subsamplingRate": (0.5, 0.7, 0.9)}, {"featureSubsetStrategy": ("all", "onethird")}, {"stepSize": (0.05, 0.1, 0.3)})


def train_trees(table: DataFrame, features: Sequence[str], label: str = "y", stages: Sequence[dict[str, Sequence]] = STAGES, most: int = 20, folds: int = 2, at_once: int = 4, class_weights: tuple[float, float] = (1.0, 1.0)):
    """Boosted trees: parameters tuned stage by stage with cross-validation on the area under the ROC curve, then as many rounds as are best
    on the validation rows; gives (model, importances, chosen parameters).  ``class_weights``, of the classes 0 and 1, are those of :func:`class_weights`."""
    weight = F.when(F.col(label) == 1, float(class_weights[1])).otherwise(float(class_weights[0]))
    rows = assemble(table, features, label).select("features", label, F.to_json(F.struct(*features)).alias("__key"), weight.alias("__weight")).persist()
    try:
        model, chosen = fitted_trees(rows, label, stages, most, folds, at_once)
    finally:
        rows.unpersist()
    importances = sorted(zip(features, model.featureImportances.toArray().tolist()), key=lambda x: -x[1])
    return model, importances, chosen


def fitted_trees(rows: DataFrame, label: str, stages: Sequence[dict[str, Sequence]], most: int, folds: int, at_once: int):
    """(model, chosen parameters) of rows with ``features``, label, ``__weight`` and ``__key``."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    judge = BinaryClassificationEvaluator(labelCol=label, weightCol="__weight")
    chosen: dict = {}
    make = lambda rounds: GBTClassifier(featuresCol="features", labelCol=label, weightCol="__weight", seed=42, maxIter=rounds, **{"stepSize": 0.1, "subsamplingRate": 0.7, **chosen})
    for stage in stages:
        grid = ParamGridBuilder()
        for name, values in stage.items():
            grid = grid.addGrid(GBTClassifier().getParam(name), list(values))
        trees = make(max(2, most // 5))
        grid = [{trees.getParam(p.name): v for p, v in x.items()} for x in grid.build()]
        scores = CrossValidator(estimator=trees, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=42, parallelism=at_once).fit(rows).avgMetrics
        chosen |= {p.name: v for p, v in grid[int(np.argmax(scores))].items()}
    # early stopping: rounds go on while the validation rows gain
    model = make(most).setValidationIndicatorCol("__held").fit(rows.withColumn("__held", split_of(F.xxhash64("__key"), test=0.2) == "test"))
    return model, chosen


def held_out_measures(table: DataFrame, features: Sequence[str], model, label: str = "y") -> DataFrame:
    """One row: the area under the ROC curve, accuracy, precision, recall and f1 of a model on labelled rows that it hasn't seen."""
    scored = score(table.filter(F.col(label).isNotNull()), model, features, "p", label)
    one = lambda rows: rows.withColumn("__one", F.lit(1))  # noqa: E731  both have one row
    return one(roc_auc(scored, label)).join(one(confusion(scored, label)), "__one").drop("__one")


def train_network(table: DataFrame, features: Sequence[str], label: str = "y", hidden: Sequence[int] = (32, 16)):
    """A dense network on the scaled features."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    layers = [len(features), *hidden, 2]
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=layers, seed=42, maxIter=60).fit(assemble(table, features, label))


def score(table: DataFrame, model, features: Sequence[str], column: str, label: str = "y") -> DataFrame:
    """Probability of class 1, rounded half to even to two decimals."""
    from pyspark.ml.functions import vector_to_array

    rows = assemble(table.withColumn(label, F.lit(0.0)) if label not in table.columns else table, features, label)
    return model.transform(rows).select(*table.columns, F.bround(vector_to_array("probability")[1], 2).alias(column))


def log_edges(low: float, high: float, bins: int) -> list[float]:
    """``bins`` bins of equal width in the logarithm."""
    step = math.log10(high / low) / bins
    return [*(low * 10 ** (step * i) for i in range(bins)), high]


def histogram(values: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """(bin, n, share): left-closed bins, the last one closed on both sides."""
    last = len(edges) - 2
    x = F.col(column)
    at = reduce(lambda a, b: a + b, [(x >= e).cast("int") for e in edges[1:-1]], F.lit(0))
    counted = values.filter(x.between(edges[0], edges[-1])).groupBy(F.least(at, F.lit(last)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def overlapping_histogram(values: DataFrame, column: str, bins: Sequence[tuple[float, float]]) -> DataFrame:
    """(bin, n): bins may overlap; left-closed, the last one closed on both sides."""
    x, last = F.col(column), len(bins) - 1
    inside = F.array(*[F.when((x >= lo) & ((x <= hi) if i == last else (x < hi)), F.lit(i)) for i, (lo, hi) in enumerate(bins)])
    return values.select(F.explode(F.filter(inside, lambda b: b.isNotNull())).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))

