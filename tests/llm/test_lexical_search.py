"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from starfold.llm import lexical_search

DOCS, ITEMS = "doc_id long, text string", "item_id string, text string"


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, top):
    own = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for doc, counts in own:
            score, m = 0, 75 + 25 * sum(counts.values()) * n // max(total, 1)
            for t in terms(text):
                if counts[t]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scored.append((-score, math.inf if doc is None else doc))
        out += [(item, k, None if d == math.inf else d, -s) for k, (s, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(60)] + ["Word", "don't", "naïve", "日本", "x_y", "A1b2", "³"]
    text = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.08)), len(vocabulary) - 1)] for _ in range(n))
    docs = [(i, text(rng.randint(1, 60))) for i in rng.sample(range(-50, 1000), 160)]
    docs += [(2000 + i, docs[i][1]) for i in range(30)] + [(docs[0][0], docs[0][1]), (docs[1][0], "other t3 t4"), (None, docs[2][1]), (None, text(30)), (3000, None), (3001, ""), (3002, " ... "), (3003, text(30_000)), (3004, "z" * 50_000)]
    items = [(f"q{i}", text(rng.randint(1, 25))) for i in range(25)] + [("long", text(800)), ("none", None), ("empty", "?!"), ("unknown", "absent words"), ("twice", "t1 t1 t5"), ("twice", "t1 t1 t5"), (None, "t2 t9"), ("z", "z" * 50_000)]
    return docs, items


@pytest.mark.parametrize(("shard_bytes", "block_terms", "top"), [(700, 40, 5), (1 << 20, 10_000, 20)])
def test_search_equals_brute_force(spark, shard_bytes, block_terms, top):
    docs, items = corpus(shard_bytes)
    index = lexical_search.build_index(spark.createDataFrame(docs, DOCS).repartition(3), shard_bytes=shard_bytes)
    assert index.select("shard").distinct().count() >= (20 if shard_bytes < 1000 else 3)
    found = lexical_search.search(index, spark.createDataFrame(items, ITEMS), top=top, block_terms=block_terms)
    assert sorted(map(tuple, found.select("query", "rank", "doc_id", "score").collect()), key=str) == brute(docs, items, top)


def test_query_reads_only_its_columns(spark, tmp_path):
    docs, items = corpus(3)
    frame = spark.createDataFrame(docs, DOCS)
    frame.selectExpr("doc_id", "text", "text as term", "doc_id as shard", "text as data").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).selectExpr("*", "text as query").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = lexical_search.op11_lexical_search(spark, str(tmp_path))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, 20)


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([("a", "b c")], ITEMS)
    for docs, asked in ((none, items), (spark.createDataFrame([(1, None)], DOCS), items), (spark.createDataFrame([(1, "b")], DOCS), items.limit(0))):
        assert lexical_search.search(lexical_search.build_index(docs), asked).count() == 0


def test_numbers_survive_packing():
    rng = random.Random(1)
    values = np.array([rng.randrange(1 << rng.randint(1, 32)) for _ in range(2000)] + [0, 127, 128, 2**32 - 1])
    data, first = lexical_search.packed_numbers(values)
    assert (lexical_search.unpacked_numbers(data.tobytes()) == values).all() and len(first) == len(values)
    assert len(lexical_search.unpacked_numbers(b"")) == 0
