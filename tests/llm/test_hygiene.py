"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names in every operator and stage."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starfold.llm import bpe, fingerprints, jaccard_join, language_mix, packing, pairwise_quality, pitman_yor, quality_rules, substring_dedup, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["__text", "__id", "__sig", "covered", "starts", "node", "token", "tokens", "label", "block", "data", "home", "kind", "word", "__part", "__rank", "p", "w", "n", "quality2"]


def rows():
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + "."
    shared = text(60)
    docs = [(i, text(rng.randint(40, 90)), "xx" if i % 2 else "yy", "s", 1) for i in range(12)]
    docs += [(20, shared, "xx", None, None), (20, shared, "xx", None, None), (20, text(50), "yy", "s", 1), (None, shared, None, None, None), (None, shared, None, None, None), (None, text(45), "xx", "s", 3)]
    docs += [(30, None, None, None, None), (31, "", "xx", "s", 0), (32, " \n\t ", "xx", "s", 4), (33, "x", "yy", "s", 1), (None, None, None, None, None), (34, "1 2 3", "yy", "s", 5)]
    # one text of many words and one of a single endless word
    return docs + [(40, text(20_000), "xx", "s", 1), (41, "y" * 50_000, "yy", "s", 1)]


def table(spark, data):
    docs = spark.createDataFrame(data, SCHEMA)
    return docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHING})


def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(12)] + [(20, 1), (None, 1), (3, None)], "doc_id long, quality int")


def op2(docs):
    return language_mix.predict(docs, *language_mix.learn(language_mix.learnable(docs)))


def op4(docs):
    return pairwise_quality.score(docs, pairwise_quality.learn(docs.select("doc_id", "text"), labels(docs.sparkSession)))


def op7(docs):
    return pitman_yor.score(docs, pitman_yor.learn(docs.withColumn("learn", F.lit(True))))


def op8(docs):
    urls = docs.withColumn("url", F.concat(F.lit("http://"), "text"))
    return url_filter.judge(urls, url_filter.RULES, url_filter.listed_hosts(urls))


OPERATORS = {
    "op1": fingerprints.versions,
    "op2": op2,
    "op3": lambda d: bpe.encode(d, bpe.default_vocabulary()),
    "op4": op4,
    "op5": substring_dedup.substring_dedup,
    "op6": quality_rules.quality_rules,
    "op7": op7,
    "op8": op8,
    "op9": jaccard_join.near_duplicates,
    "op10": lambda d: packing.pack_documents(d, bpe.default_vocabulary(), bpe.default_vocabulary("byte_bpe_50k.tiktoken")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    data = rows()
    docs = table(spark, data)
    found = OPERATORS[name](docs).collect()
    if name == "op10":
        assert sum(r.piece == 0 for r in found) == len(data) and len({(r.sequence_id, r.offset) for r in found}) == len(found)
    else:
        assert len(found) == len(data)
    assert sorted(str(r["doc_id"]) for r in found if name != "op10" or r.piece == 0) == sorted(str(r[0]) for r in data)
    kept = [c for c in CLASHING if c in found[0].asDict()]
    if name in ("op2", "op3", "op4", "op5", "op6", "op8", "op9"):
        assert kept == CLASHING
    for r in found:
        for c in kept if name in ("op2", "op3", "op4", "op5", "op6", "op8", "op9") else ():
            assert r[c] == c + ("-" if r["doc_id"] is None else str(r["doc_id"]))
    # rows that repeat each other fare alike
    if name not in ("op1", "op10"):
        plain = [tuple(str(v) for v in r.asDict().values()) for r in found if r["doc_id"] == 20]
        assert len(set(plain)) == 2


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_an_empty_result(spark, name):
    assert OPERATORS[name](table(spark, [])).count() == 0


def test_long_hosts(spark):
    hosts = [".".join(["a"] * 20_000) + ".com", ".".join(["b"] * 3_000) + ".free-bets.org", ".".join(f"x{i}" for i in range(5_000))]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.RULES, url_filter.listed_hosts(pages)).collect()}
    assert found == {0: ("com/", "allow"), 1: (None, "block"), 2: (None, "allow")}


def test_long_listed_hosts(spark):
    """A listed name at the front of a host of many labels makes the listed entry long."""
    hosts = [".".join(["free-bets", *["a"] * 20_000, "org"]), ".".join(["x", "free-bets", *["a"] * 20_000, "org"]), ".".join(["a"] * 20_000 + ["org"]), "ads-track.net", "free-bets"]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id long, url string")
    found = {r.page_id: r.verdict for r in url_filter.judge(pages, url_filter.RULES, url_filter.listed_hosts(pages)).collect()}
    assert found == {0: "block", 1: "block", 2: "allow", 3: "block", 4: "block"}


def test_a_list_of_many_hosts(spark):
    hosts = [f"h{i}.d{i % 50}.{'com' if i % 3 else 'org'}" for i in range(3000)]
    listed = {h for i, h in enumerate(hosts) if i % 7 == 0} | {"d1.org", "absent.net"}
    pages = spark.createDataFrame([(i, f"https://www.{h}/q") for i, h in enumerate(hosts)], "page_id long, url string")
    table_ = spark.createDataFrame([(h,) for h in listed] + [(None,), ("",)], "key string")
    found = {r.page_id: r.verdict for r in url_filter.judge(pages, [("none.example", "/", "allow")], table_).collect()}
    for i, h in enumerate(hosts):
        labels_ = f"www.{h}".split(".")
        assert found[i] == ("block" if any(".".join(labels_[k:]) in listed for k in range(len(labels_))) else "allow")


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_and_survive(spark, tmp_path, stage):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    run = dict(corpus_pipeline.STAGES)[stage]
    for data in (rows(), []):
        docs = table(spark, data)
        found = run(spark, docs, str(tmp_path))
        if stage != "packing":
            assert found.columns == docs.columns
        got = found.collect()
        assert len(got) <= len(data) or stage == "packing"
        for r in got if stage != "packing" else ():
            assert r["covered"] == "covered" + ("-" if r["doc_id"] is None else str(r["doc_id"]))


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(9)
    base = [rng.choice("abcdefgh") + str(rng.randint(0, 60)) for _ in range(120)]
    data = []
    for i in range(70):
        words = list(base) if i % 2 else [rng.choice("abcdefgh") + str(rng.randint(0, 60)) for _ in range(60)]
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 9)}"
        data.append((rng.choice([None, i, i // 3]), " ".join(words), "xx", "s", 1))
    found = corpus_pipeline.near_copies(spark, spark.createDataFrame(data, SCHEMA), "")
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (r[1].split() for r in data)]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(data)):
        groups.setdefault(root(i), []).append(i)
    got = sorted(r.text for r in found.collect())
    assert len(got) == len(groups)
    for members in groups.values():
        ids = [data[i][0] for i in members if data[i][0] is not None]
        able = {data[i][1] for i in members if data[i][0] == (min(ids) if ids else None)}
        assert sum(t in able for t in got) == 1


def test_passages_equal_brute_force(spark):
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    shared = words(50)
    data = [(i, " ".join([*words(20), *(shared[rng.randint(0, 10) :] if i % 3 == 0 else words(30)), *words(10)]), "xx", "s", 1) for i in range(15)]
    found = {r.doc_id: r.text for r in corpus_pipeline.passages(spark, spark.createDataFrame(data, SCHEMA), "").collect()}
    seen = {}
    for i, text, *_ in data:
        w = text.split()
        for k in range(len(w) - 34):
            seen.setdefault(tuple(w[k : k + 35]), set()).add((i, k))
    for i, text, *_ in data:
        w = text.split()
        gone = set()
        for k in range(len(w) - 34):
            if len(seen[tuple(w[k : k + 35])]) > 1:
                gone |= set(range(k, k + 35))
        assert found[i].split() == [x for k, x in enumerate(w) if k not in gone]
