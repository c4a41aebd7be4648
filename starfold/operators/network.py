"""A classifier of two branches, trained over partitions: dense layers on the features, separable convolutions on the dm-dt image.

Training is data-parallel and synchronous.  In each step every task computes the gradient of its share of the step's rows; the sums
are added in two stages, so that the driver gets a few vectors however many partitions there are, and takes one Adam step.  A row
belongs to a step by hash of its key, so the steps don't depend on how rows are dealt.  The rows are written to the shared folder once; a lost executor
only repeats the tasks of the running step.

Defined results: rows that lack the image, a feature (NULL or NaN) or the label are left out of training; scoring gives NULL to those that lack
the image or a feature.  Without a row to learn from the weights stay as they were drawn.
"""

from __future__ import annotations

import math
import re
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions.photometry import null_nan

Weights = dict[str, np.ndarray]
#: Rows that a gradient is computed of at once.
ROWS = 256
#: Images that are convolved at once.
IMAGES = 16
#: Sums that reach the driver in one step, at most.
SUMS = 16


def shared_folder(df: DataFrame) -> None:
    """Makes sure that checkpoints go to ``spark.checkpoint.dir``; a folder of this machine only if Spark runs in this process alone."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        where = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not where and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="starfold-ckpt-"))


def correlate(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Each channel with its own kernel, inside the image: (n, h, w, c) and (a, b, c).

    A line of the image and its channels are one dimension here, so that numpy's inner loops are long; a few images at a time stay in the cache.
    """
    (n, high, wide, c), (a, b, _) = x.shape, kernel.shape
    h, w = high - a + 1, wide - b + 1
    lines, rows = np.tile(kernel, w), np.ascontiguousarray(x).reshape(n, high, wide * c)
    out = np.empty((n, h, w * c))
    for k in range(0, n, IMAGES):
        into, held = out[k : k + IMAGES], rows[k : k + IMAGES]
        part = np.empty_like(into)
        for i in range(a):
            for j in range(b):
                np.multiply(held[:, i : i + h, j * c : (j + w) * c], lines[i, j], out=part if i or j else into)
                if i or j:
                    into += part
    return out.reshape(n, h, w, c)


def correlate_back(x: np.ndarray, kernel: np.ndarray, grad: np.ndarray, further: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
    """Gradients of :func:`correlate` by its input (if the way back goes ``further``) and by the kernel."""
    (n, high, wide, c), (a, b, _) = x.shape, kernel.shape
    h, w = grad.shape[1:3]
    lines, rows, grad = np.tile(kernel, w), np.ascontiguousarray(x).reshape(n, high, wide * c), np.ascontiguousarray(grad).reshape(n, h, w * c)
    to_x, to_kernel = np.zeros_like(rows) if further else None, np.zeros((a, b, w * c))
    for k in range(0, n, IMAGES):
        come, held = grad[k : k + IMAGES], rows[k : k + IMAGES]
        part = np.empty_like(come)
        for i in range(a):
            for j in range(b):
                at = np.s_[:, i : i + h, j * c : (j + w) * c]
                if further:
                    np.multiply(come, lines[i, j], out=part)
                    to_x[k : k + IMAGES][at] += part
                np.multiply(held[at], come, out=part)
                to_kernel[i, j] += part.sum((0, 1))
    return to_x.reshape(x.shape) if further else None, to_kernel.reshape(a, b, w, c).sum(2)


@dataclass
class Network:
    """Sizes of the layers and the weights.  ``hidden`` are the dense layers of the features, ``channels`` the convolutions: two before
    the pooling, two after it; either branch may be left out."""

    features: list[str]
    image: tuple[int, int] | None = (26, 26)
    hidden: tuple[int, ...] = (256, 32)
    channels: tuple[int, ...] = (16, 16, 32, 32)
    kernel: int = 3
    last: int = 16
    dropout: tuple[float, float, float] = (0.25, 0.25, 0.4)
    seed: int = 42
    weights: Weights = field(default_factory=dict)
    #: (step, training loss, validation loss) as the training went.
    history: list[tuple[int, float, float]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.features and not self.image:
            raise ValueError("a network needs features or an image")
        if not self.weights:
            self.weights = self.drawn()

    def drawn(self) -> Weights:
        """First weights: uniform, by the sizes of the layers on both sides."""
        rng = np.random.default_rng(self.seed)

        def matrix(*shape: int) -> np.ndarray:
            limit = math.sqrt(6 / (math.prod(shape[:-1]) + shape[-1]))
            return rng.uniform(-limit, limit, shape)

        w: Weights = {}
        joint = 0
        if self.features:
            size = len(self.features)
            for k, n in enumerate(self.hidden):
                w[f"dense{k}"], w[f"dense{k}_bias"], size = matrix(size, n), np.zeros(n), n
            joint += size
        if self.image:
            size = 1
            for k, n in enumerate(self.channels):
                w[f"conv{k}_depth"] = rng.uniform(-1, 1, (self.kernel, self.kernel, size)) * math.sqrt(6 / (2 * self.kernel**2))
                w[f"conv{k}_point"], w[f"conv{k}_bias"], size = matrix(size, n), np.zeros(n), n
            joint += size
        w["last"], w["last_bias"] = matrix(joint, self.last), np.zeros(self.last)
        w["score"], w["score_bias"] = matrix(self.last, 1), np.zeros(1)
        return w

    def run(self, x: np.ndarray, image: np.ndarray, rng: np.random.Generator | None = None) -> tuple[np.ndarray, list]:
        """(log odds, what the way back needs) of (n, features) and (n, h, w); ``rng`` draws what is dropped, in training only."""
        w, tape, parts = self.weights, [], []

        def dropped(v: np.ndarray, share: float) -> np.ndarray:
            if rng is None or not share:
                return v
            mask = (rng.random(v.shape) >= share) / (1 - share)
            tape.append(("drop", mask))
            return v * mask

        def dense(v: np.ndarray, name: str) -> np.ndarray:
            out = np.maximum(v @ w[name] + w[f"{name}_bias"], 0)
            tape.append(("dense", name, v, out))
            return out

        if self.features:
            v = x
            for k in range(len(self.hidden)):
                v = dense(v, f"dense{k}")
                if k == 0:
                    v = dropped(v, self.dropout[0])
            parts.append(v)
            tape.append(("branch",))
        if self.image:
            v = image[..., None]
            for k in range(len(self.channels)):
                deep = correlate(v, w[f"conv{k}_depth"])
                out = np.maximum(deep @ w[f"conv{k}_point"] + w[f"conv{k}_bias"], 0)
                tape.append(("conv", k, v, deep, out))
                v = out
                if k in (1, len(self.channels) - 1):
                    v = dropped(v, self.dropout[1])
                if k == 1:
                    n, h, wide, c = v.shape
                    cells = v[:, : h // 2 * 2, : wide // 2 * 2].reshape(n, h // 2, 2, wide // 2, 2, c).transpose(0, 1, 3, 2, 4, 5).reshape(n, h // 2, wide // 2, 4, c)
                    top = cells.argmax(3)
                    tape.append(("pool", v.shape, top))
                    v = np.take_along_axis(cells, top[:, :, :, None], 3)[:, :, :, 0]
            tape.append(("mean", v.shape))
            parts.append(v.mean((1, 2)))
            tape.append(("branch",))
        v = dropped(np.concatenate(parts, axis=1), self.dropout[2])
        tape.insert(len(tape) - (rng is not None and self.dropout[2] > 0), ("joint", [p.shape[1] for p in parts]))
        v = dense(v, "last")
        return (v @ w["score"] + w["score_bias"])[:, 0], [*tape, ("score", v)]

    def gradient(self, x: np.ndarray, image: np.ndarray, y: np.ndarray, weight: np.ndarray, rng: np.random.Generator | None = None) -> tuple[float, Weights]:
        """(weighted sum of the logistic loss, its gradient)."""
        z, tape = self.run(x, image, rng)
        loss = float(weight @ (np.logaddexp(0, z) - y * z))
        delta = (weight * (1 / (1 + np.exp(-z)) - y))[:, None]
        w, out, waiting = self.weights, {}, []
        for what, *held in reversed(tape):
            if what == "score":
                out["score"], out["score_bias"] = held[0].T @ delta, delta.sum(0)
                delta = delta @ w["score"].T
            elif what == "drop":
                delta = delta * held[0]
            elif what == "dense":
                name, v, found = held
                delta = delta * (found > 0)
                out[name], out[f"{name}_bias"] = v.T @ delta, delta.sum(0)
                delta = delta @ w[name].T
            elif what == "joint":
                waiting = np.split(delta, np.cumsum(held[0])[:-1], axis=1)
            elif what == "branch":
                delta = waiting.pop()
            elif what == "mean":
                n, h, wide, c = held[0]
                delta = np.broadcast_to(delta[:, None, None] / (h * wide), held[0])
            elif what == "pool":
                shape, top = held
                n, h, wide, c = shape
                cells = np.zeros((n, h // 2, wide // 2, 4, c))
                np.put_along_axis(cells, top[:, :, :, None], delta[:, :, :, None], 3)
                delta = np.zeros(shape)
                delta[:, : h // 2 * 2, : wide // 2 * 2] = cells.reshape(n, h // 2, wide // 2, 2, 2, c).transpose(0, 1, 3, 2, 4, 5).reshape(n, h // 2 * 2, wide // 2 * 2, c)
            else:
                k, v, deep, found = held
                delta = delta * (found > 0)
                out[f"conv{k}_point"] = deep.reshape(-1, deep.shape[-1]).T @ delta.reshape(-1, delta.shape[-1])
                out[f"conv{k}_bias"] = delta.sum((0, 1, 2))
                delta, out[f"conv{k}_depth"] = correlate_back(v, w[f"conv{k}_depth"], delta @ w[f"conv{k}_point"].T, k > 0)
        return loss, out

    def predict(self, x: np.ndarray, image: np.ndarray) -> np.ndarray:
        parts = [1 / (1 + np.exp(-self.run(x[k : k + ROWS], image[k : k + ROWS])[0])) for k in range(0, len(x), ROWS)]
        return np.concatenate([np.zeros(0), *parts])

    def names(self) -> list[str]:
        return sorted(self.weights)

    def flat(self, weights: Weights) -> np.ndarray:
        return np.concatenate([weights[k].ravel() for k in self.names()])

    def shaped(self, flat: np.ndarray) -> Weights:
        out, at = {}, 0
        for k in self.names():
            size = self.weights[k].size
            out[k] = flat[at : at + size].reshape(self.weights[k].shape)
            at += size
        return out


def complete(table: DataFrame, net: Network, image: str) -> DataFrame:
    """(..., __x, __image): the features as one array and the image as a flat one; NULL where something is missing."""
    x = F.array(*[null_nan(F.col(c).cast("double")) for c in net.features]) if net.features else F.array().cast("array<double>")
    flat = F.flatten(image).cast("array<double>") if net.image else F.array().cast("array<double>")
    size = net.image[0] * net.image[1] if net.image else 0
    return table.withColumns({"__x": F.when(~F.exists(x, lambda v: v.isNull()), x), "__image": F.when((F.size(flat) == size) & ~F.exists(flat, lambda v: v.isNull() | F.isnan(v)), flat)})


def matrices(batch: pa.RecordBatch, net: Network) -> tuple[np.ndarray, np.ndarray]:
    n = batch.num_rows
    x = batch.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(net.features)) if net.features else np.zeros((n, 0))
    image = batch.column("__image").flatten().to_numpy(zero_copy_only=False).reshape(n, *net.image) if net.image else np.zeros((n, 0, 0))
    return x, image


def step_sums(rows: DataFrame, net: Network, drop: int | None = None) -> tuple[float, float, np.ndarray]:
    """(summed weights, summed loss, summed gradient) of all ``rows`` (__x, __image, __y, __w); ``drop`` seeds what is dropped."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(net)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, rng = sent.value, None if drop is None else np.random.default_rng([drop, TaskContext.get().partitionId()])
        total = None
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                y, w = (part.column(c).to_numpy() for c in ("__y", "__w"))
                loss, grad = own.gradient(*matrices(part, own), y, w, rng)
                vector = np.concatenate([[w.sum(), loss], own.flat(grad)])
                total = vector if total is None else total + vector
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column("sums"):
                vector = np.frombuffer(x.as_py())
                total = vector if total is None else total + vector
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    sums = rows.select("__x", "__image", "__y", "__w").mapInArrow(partial, "sums binary")
    if rows.rdd.getNumPartitions() > SUMS:
        sums = sums.repartition(SUMS).mapInArrow(added, "sums binary")
    parts = [np.frombuffer(bytes(r["sums"])) for r in sums.collect()]
    total = np.sum(parts, axis=0) if parts else np.zeros(2 + len(net.flat(net.weights)))
    sent.unpersist()
    return float(total[0]), float(total[1]), total[2:]


def train(
    table: DataFrame,
    features: Sequence[str],
    image: str | None = "dmdt",
    label: str = "y",
    key: str = "id",
    steps: int = 60,
    rate: float = 3e-3,
    batches: int = 4,
    class_weights: tuple[float, float] = (1.0, 1.0),
    validation: float = 0.15,
    patience: int = 4,
    tasks: int | None = None,
    **sizes,
) -> Network:
    """A network trained on (``key``, features, ``image``, ``label``): ``steps`` steps of Adam, each on the rows of one of ``batches`` hash classes.

    After every pass over the batches the loss of the validation rows (by hash of the key) is taken; training stops when it hasn't fallen for ``patience``
    passes, and the best weights are kept.
    """
    net = Network(list(features), sizes.pop("image_size", (26, 26)) if image else None, **sizes)
    shared_folder(table)
    hashed = lambda salt, n: F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(salt)), F.lit(n))
    rows = complete(table, net, image or "").filter(F.col(label).isNotNull() & F.col("__x").isNotNull() & F.col("__image").isNotNull())
    rows = rows.select("__x", "__image", F.col(label).cast("double").alias("__y"), F.when(F.col(label) == 1, class_weights[1]).otherwise(class_weights[0]).alias("__w"), hashed("batch", batches).cast("int").alias("__batch"), (hashed("held", 10_000) < int(validation * 10_000)).alias("__held"))
    rows = (rows.repartition(tasks) if tasks else rows).checkpoint()
    first, second = (np.zeros_like(net.flat(net.weights)) for _ in range(2))
    best, waited, seen = (math.inf, net.weights), 0, 0.0
    for step in range(1, steps + 1):
        weight, loss, grad = step_sums(rows.filter(~F.col("__held") & (F.col("__batch") == step % batches)), net, drop=net.seed * 100_003 + step)
        if weight:
            grad = grad / weight
            first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
            move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            net.weights = net.shaped(net.flat(net.weights) - move)
            seen = loss / weight
        if step % batches and step < steps:
            continue
        weight, loss, _ = step_sums(rows.filter("__held"), net)
        held = loss / weight if weight else seen
        net.history.append((step, seen, held))
        if held < best[0]:
            best, waited = (held, net.weights), 0
        else:
            waited += 1
            if waited >= patience:
                break
    net.weights = best[1]
    return net


def score(table: DataFrame, net: Network, column: str, image: str = "dmdt", digits: int | None = 2) -> DataFrame:
    """Adds the probability of class 1, rounded half to even to ``digits``."""
    sent = table.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def work(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, flat in parts:
            own, out = sent.value, np.full(len(x), np.nan)
            full = pa.compute.and_(pa.compute.is_valid(x), pa.compute.is_valid(flat)).to_numpy(zero_copy_only=False)
            batch = pa.RecordBatch.from_arrays([x.filter(pa.array(full)), flat.filter(pa.array(full))], ["__x", "__image"])
            out[full] = own.predict(*matrices(batch, own))
            yield pa.array(out)

    p = null_nan(work("__x", "__image"))
    made = complete(table, net, image).withColumn("__p", p)
    return made.select(*[c for c in table.columns if c != column], (F.col("__p") if digits is None else F.bround("__p", digits)).alias(column))
