"""Language identification by mixture inference.

Every language has a distribution over hashed byte trigrams of lower-cased text (anything but letters is one
space).  A document is a mixture of languages and of a flat background; expectation-maximisation estimates its
proportions from the trigrams' likelihoods.  The set of languages is the one with the best likelihood less a penalty for each
language, over the nested sets in order of their proportions.

Trigram counts cover all rows that may be learned from; the model has ``BUCKETS`` numbers for each language, so what is sent
to the tasks doesn't grow with the corpus.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is every text if nothing could be learned;
ties go to the language that sorts first; repeated rows are scored alike; an empty table gives an empty result.  Texts are judged whole, a
long one with all its trigrams.  Extra columns are kept by :func:`predict`, whatever their names, but for those of its own results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, is_held_out, read_documents, sheltered, text_blocks

BUCKETS = 1 << 16
SMOOTHING = 0.5
STEPS = 30
#: Log-likelihood that a further language must gain for each log(number of trigrams): trigrams overlap, so three times 1/2.
PENALTY = 1.5
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 0x20, dtype=np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray) -> np.ndarray:
    """Hashed trigrams (uint16) that begin at each byte but the last two."""
    c = _FOLD[data]
    if len(c) < 3:
        return np.zeros(0, dtype=np.uint16)
    packed = c[:-2] << np.uint32(16) | c[1:-1] << np.uint32(8) | c[2:]
    return ((packed * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def learn(docs: DataFrame, lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and log-probabilities of shape (BUCKETS, languages) from all rows of ``docs`` (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                grams = trigrams(data)
                names, codes = np.unique(langs[lo:hi].astype(str), return_inverse=True)
                owner = np.repeat(codes, np.diff(offsets))[: len(grams)]
                # a trigram across the border of two texts is left out
                ends = np.unique(np.concatenate([offsets[1:-1] - 1, offsets[1:-1] - 2]))
                keep = np.ones(len(grams), dtype=bool)
                keep[ends[(ends >= 0) & (ends < len(grams))]] = False
                for k, name in enumerate(names):
                    add = np.bincount(grams[keep & (owner == k)], minlength=BUCKETS)
                    totals[name] = totals[name] + add if name in totals else add
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))], ["lang", "bucket", "n"])

    rows = docs.select("text", F.col(lang).alias("lang")).na.drop()
    table = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(table["lang"].unique())
    counts = np.zeros((BUCKETS, len(names)))
    counts[table["bucket"], np.searchsorted(names, table["lang"].to_numpy(dtype=str)) if len(names) else []] = table["n"]
    return names, np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS))


def mixture(weight: np.ndarray, likelihood: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``likelihood`` and the log-likelihood, by expectation-maximisation."""
    n = weight.sum()
    share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
    for _ in range(steps):
        mixed = likelihood @ share
        new = share * ((weight / mixed) @ likelihood) / n
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(weight @ np.log(likelihood @ share))


def infer(grams: np.ndarray, probability: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(proportions of the languages and, last, of the background; the chosen set of languages)."""
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    weight = np.diff(np.append(first, len(grams))).astype(np.float64)
    rows = probability[grams[first]]
    langs = rows.shape[1] - 1
    share, _ = mixture(weight, rows)
    order = np.argsort(-share[:langs], kind="stable")
    price = PENALTY * np.log(weight.sum() + 1)
    best: tuple[float, np.ndarray, list[int]] | None = None
    for k in range(1, langs + 1):
        chosen = list(order[:k])
        part, fit = mixture(weight, rows[:, [*chosen, langs]])
        if best is not None and fit - price * k <= best[0]:
            break
        full = np.zeros(langs + 1)
        full[[*chosen, langs]] = part
        best = (fit - price * k, full, chosen)
    return best[1], best[2]


def predict(docs: DataFrame, names: list[str], log_probability: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (its proportion), ``langs`` (the chosen set) and ``shares`` to the ``keep`` columns."""
    own = ["lang_pred", "score", "langs", "shares"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in own]
    inner, held = sheltered(docs)
    flat = np.full((BUCKETS, 1), 1.0 / BUCKETS)
    probability = np.hstack([np.exp(log_probability), flat])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores, sets, shares = [], [], [], []
        column = batch.column("__text")
        for lo, _, data, offsets in text_blocks(column):
            grams = trigrams(data)
            for i in range(len(offsets) - 1):
                part = grams[offsets[i] : max(offsets[i], offsets[i + 1] - 2)]
                text = column[lo + i].as_py()
                if not names or not len(part) and not text or not _LETTER.search(text):
                    langs.append(UNKNOWN), scores.append(0.0), sets.append([]), shares.append([])
                    continue
                if not len(part):
                    part = trigrams(np.frombuffer(f" {text} ".encode(), dtype=np.uint8))
                share, chosen = infer(part, probability)
                top = min(chosen, key=lambda k: (-share[k], names[k]))
                langs.append(names[top]), scores.append(min(1.0, float(share[top]))), sets.append([names[k] for k in chosen]), shares.append([float(share[k]) for k in chosen])
        columns = [batch.column(held[c]) for c in kept]
        made = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays([*columns, *made], [*kept, *own])

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "lang_pred string, score double, langs array<string>, shares array<double>"])
    return arrow_map(inner.select(*[held[c] for c in kept], F.col(held[text]).alias("__text")), work, schema)


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: a language is given and the id isn't held out."""
    return docs.filter(~is_held_out("doc_id", 4, 2) & F.col("lang").isNotNull())


def accepted(min_score: float = 0.3) -> Column:
    """The stage's verdict: the languages that were found have together at least ``min_score`` of the text, the background the rest."""
    return (F.col("lang_pred") != UNKNOWN) & (F.aggregate("shares", F.lit(0.0), lambda s, x: s + x) >= min_score)


def op2_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "text", "lang")
    names, model = learn(learnable(docs))
    found = predict(docs, names, model, keep=["doc_id"])
    return found.select("doc_id", is_held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
