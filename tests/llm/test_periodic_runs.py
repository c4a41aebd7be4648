"""Periodic runs against a search of every period."""

from __future__ import annotations

import hashlib
import random
import zlib

from starfold.llm import periodic_runs

DOCS = "doc_id long, text string"


def brute(words):
    """Every stretch that agrees with itself q words on, for each q; the smallest period of a stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic(rng, n, kinds):
    words = [f"w{rng.randint(0, kinds)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 13:
            a, q = rng.randint(0, n - 1), rng.randint(1, 14)
            for i in range(a + q, rng.randint(a, n)):
                words[i] = words[i - q]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(0)
    for _ in range(1500):
        words = periodic(rng, rng.randint(0, 90), rng.choice([0, 1, 1, 2, 4, 20]))
        assert periodic_runs.runs_of(words) == brute(words), words


def test_z_function():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randint(0, 1) for _ in range(rng.randint(0, 30))]
        assert periodic_runs.z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_long_texts():
    rng = random.Random(2)
    assert periodic_runs.runs_of(["a"] * 30_000) == [(0, 30_000, 1)]
    once = [str(rng.random()) for _ in range(4_000)]
    assert periodic_runs.runs_of(["x", *once, *once, *once[:100]]) == [(1, 8_100, 4_000)]
    assert periodic_runs.runs_of(once) == []


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2], sha(lines.encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i, " ".join(periodic(rng, rng.randint(0, 120), rng.choice([1, 3, 300])))) for i in range(150)]
    docs += [(7, docs[7][1]), (7, "other text"), (None, "a " * 40), (None, None), (1000, None), (1001, ""), (1002, " \n\t "), (-5, "a b " * 20), (1003, "é" * 9000), (10**15, "x y z " * 30)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in periodic_runs.op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted((expected(*d) for d in docs), key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(150)) > 5


def test_operator_keeps_texts_and_columns(spark):
    rows = [(1, "go " * 12 + "on", "a"), (2, None, "b")]
    found = {r.doc_id: r for r in periodic_runs.periodic_runs(spark.createDataFrame(rows, f"{DOCS}, runs string").withColumnRenamed("runs", "found")).collect()}
    assert found[1].collapsed == "go on" and [tuple(r) for r in found[1].runs] == [(0, 12, 1)] and found[1].found == "a"
    assert found[2].collapsed == "" and found[2].n_words == 0 and found[2].runs == []
    assert periodic_runs.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
