"""Quality classifier: Bradley-Terry ranking from preference pairs.

A document with label 1 is preferred to one with label 0.  The score is linear in text features (shares of
character classes, word, line and repetition statistics, with hinges at sample quantiles); its weights minimise the logistic
loss on feature differences of pairs.  The threshold is the quantile of the training scores that the share of label 0 gives; scores are
shifted so that it lies at 0.7 of the logistic scale.

It is fitted on at most ``MAX_LABELLED`` labelled rows (those of smallest id hash), whose features alone reach the driver;
every document is scored, over its whole text.

Defined results: a null text counts as empty and is scored like one; without rows of both labels every score is 0.5;
repeated rows are scored alike; repeated labels of a document all count; an empty table gives an empty result.  Texts are scored whole.
Extra columns are kept by :func:`score`, whatever their names, but for those of its own results; a score of exactly 0.7 is accepted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Runs, WordBlock, arrow_map, is_held_out, read_documents, sheltered, text_blocks

#: Rows that the classifier is fitted on, at most.
MAX_LABELLED = 20_000
#: Preference pairs drawn from them.
PAIRS = 100_000
#: Pairs whose differences are worked on at once.
CHUNK = 10_000
CUT = 0.7
LIMIT = 30

# Character classes by byte.
CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!", "?", "|", "#*$%&", "<>", "{}[]()=+_~^\\/@", "\"'`", ":;-", "\n"]
_CLASS = np.full(256, len(CLASSES), dtype=np.int64)
for _k, _chars in enumerate(CLASSES):
    _CLASS[[ord(c) for c in _chars]] = _k
_CLASS[128:] = len(CLASSES) + 1
WIDTH = len(CLASSES) + 1 + 10


def distinct_share(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each owner over all of its values (1 where it has none)."""
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    total = np.bincount(owner, minlength=n)
    return np.where(total > 0, np.bincount(o[new], minlength=n) / np.maximum(total, 1), 1.0)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of WIDTH numbers for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc_of_byte = np.repeat(np.arange(n), size)
    kinds = len(CLASSES) + 2
    shares = np.bincount(doc_of_byte * kinds + _CLASS[data], minlength=n * kinds).reshape(n, kinds) / np.maximum(size, 1)[:, None]
    block = WordBlock(data, offsets)
    count = block.counts()
    doc = np.repeat(np.arange(n), count)
    length = block.end - block.start
    words = block.hash
    per = np.maximum(count, 1)
    runs = Runs(words)
    three = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, dtype=np.int64)
    newline = np.concatenate([[0], np.cumsum(data == 0x0A)])
    line_of = newline[block.start] if len(block.start) else np.zeros(0, dtype=np.int64)
    opens = np.ones(len(doc), dtype=bool)
    opens[1:] = (line_of[1:] != line_of[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(opens)
    line_hash = runs.of(at, np.append(at[1:], len(doc))) if len(at) else np.zeros(0, dtype=U64)
    lines = np.bincount(doc[at], minlength=n)
    more = np.stack(
        [
            np.log1p(count),
            np.bincount(doc, length, n) / per,
            np.sqrt(np.maximum(np.bincount(doc, length.astype(float) ** 2, n) / per - (np.bincount(doc, length, n) / per) ** 2, 0)),
            np.bincount(doc, length <= 2, n) / per,
            np.bincount(doc, length >= 12, n) / per,
            distinct_share(doc, words, n),
            distinct_share(doc[three], runs.of(three, three + 3), n),
            distinct_share(doc[at], line_hash, n),
            np.log1p(count / np.maximum(lines, 1)),
            np.log1p(lines),
        ],
        axis=1,
    )
    return np.hstack([np.sqrt(shares[:, : kinds - 1]), more])


@dataclass
class Model:
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    threshold: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Features and their hinges below and above the sample's quantiles."""
        return (np.hstack([x, np.maximum(self.low - x, 0), np.maximum(x - self.high, 0)]) - self.centre) / self.scale

    def clipped(self, x: np.ndarray) -> np.ndarray:
        """What is fitted and scored: no feature counts for more than ``LIMIT`` standard deviations."""
        return np.clip(self.expand(x), -LIMIT, LIMIT)

    def score(self, x: np.ndarray) -> np.ndarray:
        s = np.clip(self.clipped(x) @ self.weight - self.threshold + np.log(CUT / (1 - CUT)), -500, 500)
        return 1 / (1 + np.exp(-s))


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, steps: int = 25) -> Model:
    """Newton's method on the logistic loss of feature differences of preference pairs."""
    low, high = np.quantile(x, [0.1, 0.9], axis=0)
    model = Model(low, high, np.zeros(3 * x.shape[1]), np.ones(3 * x.shape[1]), np.zeros(3 * x.shape[1]), 0.0)
    wide = model.expand(x)
    model.centre, model.scale = wide.mean(axis=0), np.maximum(wide.std(axis=0), 1e-6)
    wide = model.clipped(x)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    draw = np.random.default_rng(0)
    each = max(pairs, len(good), len(bad))
    better, worse = good[draw.permutation(each) % len(good)], bad[draw.permutation(each) % len(bad)]
    w = model.weight
    for _ in range(steps):
        gradient, hessian = ridge * w, ridge * np.eye(len(w))
        for lo in range(0, each, CHUNK):  # differences are made anew, so that the driver never holds all of them
            difference = wide[better[lo : lo + CHUNK]] - wide[worse[lo : lo + CHUNK]]
            p = 1 / (1 + np.exp(-np.clip(difference @ w, -500, 500)))
            gradient = gradient + difference.T @ (p - 1) / each
            hessian = hessian + (difference * (p * (1 - p))[:, None]).T @ difference / each
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    model.weight = w
    model.threshold = float(np.quantile(wide @ w, len(bad) / len(label)))
    return model


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model | None:
    """Fits on the labelled rows of smallest id hash; only their features and labels come to the driver."""
    chosen = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)
    rows = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["__id"]).select("text", "quality")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [features(data, offsets) for _, _, data, offsets in text_blocks(batch.column("text"))]
        x = np.vstack(parts)
        return pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(list(x), pa.list_(pa.float64()))], ["quality", "x"])

    found = arrow_map(rows, work, "quality int, x array<double>").toArrow()
    quality = found.column("quality").to_numpy()
    if len(np.unique(quality)) < 2:
        return None
    return fit(found.column("x").combine_chunks().flatten().to_numpy().reshape(len(quality), -1), quality)


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``score`` and ``predicted`` to the ``keep`` columns."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    inner, held = sheltered(docs)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.full(batch.num_rows, 0.5)
        if model is not None:
            for lo, hi, data, offsets in text_blocks(batch.column("__text")):
                found[lo:hi] = model.score(features(data, offsets))
        columns = [batch.column(held[c]) for c in kept]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found), pa.array((found >= CUT).astype(np.int32))], [*kept, "score", "predicted"])

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "score double, predicted int"])
    return arrow_map(inner.select(*[held[c] for c in kept], F.col(held[text]).alias("__text")), work, schema)


def op4_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").filter(~is_held_out("doc_id", 4, 2))
    found = score(docs, learn(docs, labels), keep=["doc_id"])
    return found.select("doc_id", is_held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")
