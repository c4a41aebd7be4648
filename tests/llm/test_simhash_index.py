"""The Gray-order index against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from starfold.llm import simhash_index

DOCS = "doc_id long, text string"


def fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, most=3):
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(values))]


def clusters(rng, n, spread):
    base = [rng.getrandbits(64) for _ in range(6)]
    out = []
    for _ in range(n):
        x = rng.choice(base)
        for _ in range(rng.randint(0, 9)):
            x ^= 1 << rng.randrange(spread)
        out.append(x)
    return out


@pytest.mark.parametrize("spread", [8, 20, 64])
def test_join_of_a_group_equals_all_pairs(spread):
    rng = random.Random(spread)
    for n in (0, 1, 2, 9, 64, 65, 300):
        fp = np.unique(np.array(clusters(rng, n, spread), dtype=np.uint64))
        fp = fp[np.argsort(simhash_index.gray_rank(fp))]
        label = simhash_index.joined(fp, np.zeros(len(fp)), 3).tolist()
        assert label == components([int(x) for x in fp])


def test_gray_rank():
    codes = np.arange(4096, dtype=np.uint64)
    gray = codes ^ (codes >> np.uint64(1))
    assert (simhash_index.gray_rank(gray) == codes).all()


def test_nodes_hold_what_their_members_share():
    fp = np.array([0b1100, 0b1101, 0b0101, 0b0111], dtype=np.uint64)
    levels = simhash_index.levels_of(fp, np.zeros(4), fan=2)
    assert [x & 15 for x in levels[1].ones.tolist()] == [0b1100, 0b0101] and [x & 15 for x in levels[1].zeros.tolist()] == [0b0010, 0b1000]
    assert levels[2].ones.tolist() == [0b0100] and [x & 15 for x in levels[2].zeros.tolist()] == [0]


@pytest.mark.parametrize("limit", [30, 150, 10_000])
def test_groups_lose_no_pair(spark, limit):
    rng = random.Random(5)
    values = sorted(set(clusters(rng, 900, 24) + clusters(rng, 100, 64) + [0]))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(i, x) for i, x in enumerate(signed)], "doc_id long, __fp long")
    keys = simhash_index.groups(prints.select("__fp").withColumnRenamed("__fp", "fp"), 3, limit)
    assert limit != 150 or keys.groupBy("key").count().agg({"count": "max"}).collect()[0][0] <= limit
    found = {r.doc_id: r.component_id for r in simhash_index.linked(prints, limit=limit).collect()}
    assert [found[i] for i in range(len(values))] == components(values)


def texts(rng):
    line = lambda n: " ".join(f"w{rng.randint(0, 300)}" for _ in range(n))
    base = [line(rng.randint(30, 200)) for _ in range(12)]
    docs = [(i, t) for i, t in enumerate(base)] + [(100 + i, t + " " + line(1)) for i, t in enumerate(base)] + [(200 + i, t.upper().replace(" ", "\n ", 3)) for i, t in enumerate(base)]
    docs += [(300 + i, "one two " + line(1)) for i in range(5)]
    return docs + [(400, None), (401, ""), (402, " \t\n"), (403, "Word"), (404, "two words"), (5, base[5]), (5, "other " + base[6]), (None, base[7]), (None, line(40)), (None, None), (405, line(120_000))]


def test_query_equals_brute_force(spark, tmp_path):
    docs = texts(random.Random(7))
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = simhash_index.op12_simhash(spark, str(tmp_path)).collect()
    prints = [fingerprint(t) for _, t in docs]
    root = components(prints)
    least = {r: min((d[0] for d, s in zip(docs, root) if s == r and d[0] is not None), default=None) for r in set(root)}
    assert sorted(map(tuple, found), key=str) == sorted(((d[0], f"{p:016x}", least[r]) for d, p, r in zip(docs, prints, root)), key=str)
    assert len(set(root)) < len(docs) - 20


def test_operator_keeps_columns(spark):
    rows = [(1, "a b c d", "x", "y"), (2, "a b c d", "z", None), (3, None, None, "q")]
    found = {r.doc_id: r for r in simhash_index.simhash_duplicates(spark.createDataFrame(rows, f"{DOCS}, __fp string, label string")).collect()}
    assert found[2].component_id == found[2].class_id == 1 and found[1]["__fp"] == "x" and found[3].label == "q" and found[3].fingerprint == "0" * 16
    assert simhash_index.simhash_duplicates(spark.createDataFrame([], DOCS)).count() == 0
