"""Language mixtures and the pairwise ranking against slow versions."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from starfold.llm import language_mix, pairwise_quality


def grams(text):
    """Hashed trigrams of folded bytes, one by one."""
    folded = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()]
    return [((((a << 16 | b << 8 | c) * 0x9E3779B1) & 0xFFFFFFFF) >> 16) for a, b, c in zip(folded, folded[1:], folded[2:])]


def slow_mixture(counts, rows, steps=30):
    """Expectation-maximisation in plain loops, ended by the operator's own rule."""
    share = [1 / len(rows[0])] * len(rows[0])
    total = sum(counts)
    for _ in range(steps):
        new = [0.0] * len(share)
        for n, row in zip(counts, rows):
            mixed = sum(s * p for s, p in zip(share, row))
            for k, p in enumerate(row):
                new[k] += n * share[k] * p / mixed
        new = [x / total for x in new]
        moved = max(abs(a - b) for a, b in zip(share, new))
        share = new
        if moved < 1e-3:
            break
    return share, sum(n * math.log(sum(s * p for s, p in zip(share, row))) for n, row in zip(counts, rows))


def slow_prediction(text, names, table):
    found = Counter(grams(text))
    rows = [[table[lang][g] for lang in names] + [1 / 65536] for g in found]
    counts = list(found.values())
    first, _ = slow_mixture(counts, rows)
    order = sorted(range(len(names)), key=lambda k: -first[k])
    best = None
    for k in range(1, len(names) + 1):
        chosen = order[:k]
        share, fit = slow_mixture(counts, [[r[c] for c in chosen] + [r[-1]] for r in rows])
        value = fit - 1.5 * math.log(sum(counts) + 1) * k
        if best is not None and value <= best[0]:
            break
        best = value, dict(zip(chosen, share))
    top = min(best[1], key=lambda k: (-best[1][k], names[k]))
    return names[top], best[1][top], sorted(names[k] for k in best[1])


def test_language_mixtures_equal_slow_inference(spark):
    rng = random.Random(4)
    letters = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "opqrstuvé"}
    words = {lang: ["".join(rng.choice(x) for _ in range(rng.randint(2, 7))) for _ in range(60)] for lang, x in letters.items()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    train = [(i, text(lang, 60), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 8)]
    asked = [text("aa", 40), text("bb", 5), text("cc", 200), text("aa", 60) + " " + text("bb", 60), text("aa", 30) + " " + text("cc", 90), "AB " + text("bb", 1), "qqqq zzzz xxxx 9 9 9"]
    names, model = language_mix.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    table = {}
    for lang in names:
        counts = Counter(g for _, t, own in train if own == lang for g in grams(t))
        total = sum(counts.values()) + 0.5 * 65536
        table[lang] = {g: (counts[g] + 0.5) / total for g in range(65536)}
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    for r in language_mix.predict(docs, names, model).collect():
        lang, score, chosen = slow_prediction(r.text, names, table)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-6 and sorted(r.langs) == chosen, r


def test_the_ranking_is_the_minimum_of_its_loss(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9)))
    rows = []
    for i in range(160):
        words = [word() for _ in range(rng.randint(20, 80))]
        quality = int(rng.random() < 0.6)
        noise = 0.1 if quality else 0.5
        rows.append((i, " ".join(w.upper() + "!!" if rng.random() < noise else w for w in words) + ".", quality))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    model = pairwise_quality.learn(docs, labels)
    x = np.vstack([pairwise_quality.features(np.frombuffer(t.encode(), dtype=np.uint8), np.array([0, len(t.encode())])) for _, t, _ in rows])
    quality = np.array([q for _, _, q in rows])
    # the loss over all preference pairs, each pair once, as the drawn ones hold each about equally often
    wide = model.clipped(x)
    good, bad = wide[quality == 1], wide[quality == 0]

    def loss(w):
        margin = (good @ w)[:, None] - (bad @ w)[None, :]
        return np.logaddexp(0, -margin).mean() + 0.5e-3 * w @ w

    least = loss(model.weight)
    w = np.zeros_like(model.weight)
    for _ in range(4000):  # plain gradient descent
        p = 1 / (1 + np.exp((good @ w)[:, None] - (bad @ w)[None, :]))
        w = w - 0.2 * (-(good * p.mean(1)[:, None]).sum(0) / len(good) + (bad * p.mean(0)[:, None]).sum(0) / len(bad) + 1e-3 * w)
    assert least <= loss(w) + 0.01 and least < 0.5 * math.log(2)
    raw = wide @ model.weight
    assert abs(np.mean(raw < model.threshold) - np.mean(quality == 0)) < 0.02
    found = {r.doc_id: r for r in pairwise_quality.score(docs, model).collect()}
    for (i, _, q), value in zip(rows, raw):
        assert abs(found[i].score - 1 / (1 + math.exp(-min(500, max(-500, value - model.threshold + math.log(0.7 / 0.3)))))) < 1e-9
        assert found[i].predicted == int(found[i].score >= 0.7)
    assert np.mean([found[i].predicted == q for i, _, q in rows]) > 0.9


def test_ties_at_the_threshold_and_between_languages(spark):
    model = pairwise_quality.Model(*(np.zeros(pairwise_quality.WIDTH) for _ in range(2)), np.zeros(3 * pairwise_quality.WIDTH), np.ones(3 * pairwise_quality.WIDTH), np.zeros(3 * pairwise_quality.WIDTH), 0.0)
    docs = spark.createDataFrame([(1, "any text"), (2, "")], "doc_id long, text string")
    assert all(abs(r.score - 0.7) < 1e-12 and r.predicted == int(r.score >= 0.7) for r in pairwise_quality.score(docs, model).collect())
    train = docs.filter("doc_id = 1").withColumn("lang", F.explode(F.array(F.lit("bb"), F.lit("aa"))))
    names, table = language_mix.learn(train)
    assert [r.lang_pred for r in language_mix.predict(docs.filter("doc_id = 1"), names, table).collect()] == ["aa"]
