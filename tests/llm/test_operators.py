"""The training-data operators against brute force, round trips and held-out labels, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import math
import os
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold.llm import bpe, components, fingerprints, jaccard_join, language_mix, packing, pairwise_quality, pitman_yor, quality_rules, substring_dedup, url_filter

pytestmark = pytest.mark.skipif(not os.path.isdir("/opt/tokenizers"), reason="no tokenizer files")
DOCS = "doc_id long, text string"
ODD = ["", "   ", "\n", "a  b", " lead", "trail ", "x<|endoftext|> y", "tab\t\tz  \n\n q", "é ñ　x", "a \n b", "don't  'll  we'll 12 3", "²½Ⅷ x٣", "a\x1c b \x1d c", "日本語 テキスト", "🙂🙂 ok", "z" * 5000]


def words(rng, n, size=400):
    return [f"w{rng.randint(0, size)}" for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- BPE


def test_bpe_equals_the_library_and_decodes_to_the_text(spark):
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    library = Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = ODD + [" ".join("".join(rng.choice("abcdeé,.!'\n ") for _ in range(rng.randint(1, 12))) for _ in range(30)) for _ in range(60)]
    found = {r.doc_id: r for r in bpe.encode_digests(frame(spark, [*enumerate(texts), (999, None), (0, texts[0])]), path).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert bpe.encoder(path, bpe.default_vocabulary("byte_bpe_50k.tiktoken")).encode(text) == array("I", ids).tobytes()
    assert found[999].n_tokens == 0 and bpe.encode_digests(empty(spark), path).count() == 0


def test_bpe_keeps_extra_columns(spark):
    r = bpe.encode(frame(spark, [(1, "hello world"), (2, None)]).withColumn("ids", F.lit("clash")), bpe.default_vocabulary()).orderBy("doc_id").collect()
    assert r[0].decoded == "hello world" and r[1].ids == []


def test_bpe_memo_stays_bounded():
    own = bpe.Encoder(bpe.Vocabulary(bpe.default_vocabulary()), memo=10)
    whole = bpe.encoder(bpe.default_vocabulary())
    text = " ".join(f"word{i}" for i in range(200))
    assert own.encode(text) == whole.encode(text) and len(own.after_space) <= 10


# --- fingerprints


def test_fingerprints_follow_the_contract(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(" ".join(words(rng, 12)) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(60, rows[5][1]), (61, None), (62, "é" * 7)]
    found = {r.doc_id: r for r in fingerprints.versions(frame(spark, rows).repartition(3), blocks=7).collect()}
    order = sorted(rows, reverse=True)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert found[60].fingerprint == found[5].fingerprint and len({r.fingerprint for r in found.values()}) >= 50


def test_peeling_gives_the_exact_difference():
    rng = np.random.default_rng(0)
    for n in (0, 3, 40, 900):
        a = rng.integers(1, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[n // 3 :], rng.integers(1, 2**63, 5).astype(np.uint64)])
        exact = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        assert abs(fingerprints.likeness((np.array([0, n]), a), (np.array([0, len(b)]), b))[0] - exact) < 1e-12


def test_fingerprints_of_ties_one_row_and_nothing(spark):
    assert fingerprints.versions(empty(spark)).count() == 0
    r = fingerprints.versions(frame(spark, [(1, "abcd")])).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert fingerprints.versions(frame(spark, [(1, "a b"), (1, "c d"), (None, "e f"), (None, None)])).count() == 4


# --- language


def test_language_mixture_on_held_out_rows(spark):
    rng = random.Random(3)
    syllables = {"aa": ["ba", "ko", "ti", "mu"], "bb": ["sche", "lich", "ung", "der"]}
    text = lambda lang: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 3))) for _ in range(30))
    rows = [(i, text(lang), lang) for i in range(80) for lang in [("aa", "bb")[i % 2]]]
    docs = spark.createDataFrame(rows + [(900, None, "aa"), (901, "123 !!", None), (902, text("aa") + " " + text("bb"), None), (903, "ko", None)], DOCS + ", lang string")
    names, model = language_mix.learn(language_mix.learnable(docs))
    found = {r.doc_id: r for r in language_mix.predict(docs, names, model).collect()}
    assert names == ["aa", "bb"] and all(found[i].lang_pred == lang for i, _, lang in rows)
    assert found[900].lang_pred == found[901].lang_pred == "und" and found[900].score == 0
    assert sorted(found[902].langs) == ["aa", "bb"] and 0.3 < found[902].score < 0.7 and found[5].langs == ["bb"]
    nothing, flat = language_mix.learn(docs.filter("false"))
    assert {r.lang_pred for r in language_mix.predict(docs, nothing, flat).collect()} == {"und"}


# --- quality


def test_pairwise_ranking_orders_held_out_rows(spark):
    rng = random.Random(4)
    good = lambda: ". ".join(" ".join(words(rng, 8)).capitalize() for _ in range(6)) + "."
    bad = lambda: "!! ".join(w.upper() for w in words(rng, 40)) + "$$$"
    docs = frame(spark, [(i, good() if i % 3 else bad()) for i in range(150)] + [(900, None), (901, "")])
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(150)] + [(7, None)], "doc_id long, quality int")
    model = pairwise_quality.learn(docs, labels.filter("doc_id % 4 <> 2"))
    found = {r.doc_id: r for r in pairwise_quality.score(docs, model).collect()}
    held = [i for i in range(150) if i % 4 == 2]
    assert all(found[i].predicted == int(i % 3 > 0) for i in held) and 0 <= found[900].score <= 1 and found[900].score == found[901].score
    assert pairwise_quality.learn(docs, labels.filter("quality = 1")) is None
    assert {r.score for r in pairwise_quality.score(docs, None).collect()} == {0.5}


# --- substring dedup


@pytest.mark.parametrize("least, seed", [(5, 2), (6, 3), (35, 10)])
def test_substring_dedup_equals_brute_force(spark, least, seed):
    rng = random.Random(least)
    passages = [words(rng, rng.randint(least, 3 * least)) for _ in range(6)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randint(0, 4)):
            k = rng.random()
            own += rng.choice(passages)[rng.randint(0, 3) :] if k < 0.4 else ["a", "b"] * rng.randint(1, least) if k < 0.6 else words(rng, rng.randint(1, least), 10**6)
        rows.append((i, " \n".join(own) + " "))
    rows += [(100, None), (101, ""), (None, "a b " * 30), (0, rows[0][1]), (7, "other text of the same id")]
    count = Counter(tuple(w[s : s + least]) for _, t in rows for w in [(t or "").split()] for s in range(len(w) - least + 1))
    expected = []
    for i, t in rows:
        own = (t or "").split()
        gone = [False] * len(own)
        for s in range(len(own) - least + 1):
            if count[tuple(own[s : s + least])] > 1:
                gone[s : s + least] = [True] * least
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        expected.append((i, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = substring_dedup.substring_dedup(frame(spark, rows).repartition(3), min_words=least, seed_words=seed, digest=True).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found], key=str) == sorted(expected, key=str)


def test_substring_dedup_leaves_clean_texts_alone(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = frame(spark, [(1, "one\n two  three " + passage), (2, passage + "\nfour"), (3, "clean\n text  here")]).withColumn("n_words", F.lit(1)).withColumn("extra", F.lit("x"))
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(docs).collect()}
    assert found[1].text == "one\n two  three " and found[2].text == "four" and found[3].text == "clean\n text  here"
    assert [(s.first, s.end) for s in found[1].spans] == [(3, 43)] and found[3].n_words == 3
    assert substring_dedup.substring_dedup(empty(spark)).count() == 0


# --- quality rules


def test_quality_counts_by_hand(spark):
    rows = [(1, "a b c a b c\nx\nx\n\n \nx #$!"), (2, None), (3, ""), (4, "the cat\tsat on the mat " * 10), (4, "the cat\tsat on the mat " * 10)]
    found = {r.doc_id: r for r in quality_rules.quality_rules(frame(spark, rows).withColumn("n_lines", F.lit(7))).collect()}
    one = found[1]
    assert (one.n_words, one.word_chars, one.n_symbols, one.n_dup_lines, one.n_repeat_words, one.n_lines) == (10, 12, 2, 1, 6, 4)
    assert found[2].n_words == found[3].n_words == 0 and found[2].base_failed and not found[2].kept
    assert found[4].n_repeat_words == found[4].n_words == 60 and found[4].base_failed
    assert quality_rules.quality_rules(empty(spark)).count() == 0


# --- HPY


def test_language_model_base_score_and_normalisation(spark):
    rng = random.Random(6)
    # two languages of skewed words, so that a document's own restaurant has something to learn
    word = lambda lang: f"{'ab'[lang]}{int(rng.paretovariate(1.0)) % 200}"
    rows = [(i, " ".join(word(i % 2) for _ in range(rng.randint(0, 90)))) for i in range(80)] + [(900, None), (901, "Never Seen")]
    docs = frame(spark, rows).withColumn("learn", F.col("doc_id") < 70)
    model = pitman_yor.learn(docs)
    found = {r.doc_id: r for r in pitman_yor.score(docs, model).collect()}
    count = Counter(w for i, t in rows if i < 70 for w in [*(t or "").lower().split(), None])
    total, distinct = sum(count.values()), len(count)
    for i, t in rows:
        own = [*(t or "").lower().split(), None]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert abs(found[i].base_score - base) < 1e-6 and (found[i].n_tokens, found[i].n_known) == (len(own), sum(count[w] > 0 for w in own))
        assert found[i].score < 0
    known = sum(r.p for r in pitman_yor.predictive(model).collect())
    assert abs(known + model.unknown - 1) < 1e-6
    held = [i for i in range(70, 80)]
    assert sum(found[i].score for i in held) > sum(found[i].base_score for i in held)


def test_language_model_without_texts(spark):
    docs = empty(spark).withColumn("learn", F.lit(True))
    model = pitman_yor.learn(docs)
    assert pitman_yor.score(docs, model).count() == 0 and model.train_tokens == 0
    one = frame(spark, [(1, "a b")]).withColumn("learn", F.lit(False))
    model = pitman_yor.learn(one)
    r = pitman_yor.score(one, model).first()
    assert (r.n_tokens, r.n_known, r.base_score) == (3, 0, 0.0)


def test_language_model_knows_the_order_of_words(spark):
    rng = random.Random(7)
    text = lambda: " ".join(f"w{(start + i) % 50}" for start in [rng.randint(0, 49)] for i in range(40))
    rows = [(i, text()) for i in range(60)]
    shuffled = text().split()
    in_order = " ".join(shuffled)
    rng.shuffle(shuffled)
    docs = frame(spark, rows + [(100, in_order), (101, " ".join(shuffled))]).withColumn("learn", F.col("doc_id") < 60)
    model = pitman_yor.learn(docs)
    found = {r.doc_id: r for r in pitman_yor.score(docs, model).collect()}
    assert abs(found[100].base_score - found[101].base_score) < 1e-6 and found[100].score > found[101].score + 20


def test_language_model_does_not_get_used_to_unseen_words(spark):
    rng = random.Random(8)
    strange = lambda n: " ".join("".join(rng.choice("jkqxzvw") for _ in range(8)) for _ in range(n))
    rows = [(i, " ".join(words(rng, 60, 80))) for i in range(50)] + [(100, strange(10)), (101, strange(1000))]
    docs = frame(spark, rows).withColumn("learn", F.col("doc_id") < 50)
    model = pitman_yor.learn(docs)
    found = {r.doc_id: r for r in pitman_yor.score(docs, model).collect()}
    assert found[101].n_known == 1 and found[101].score / 1001 < -5 and abs(found[101].score / 1000 - found[100].score / 10) < 1.5


def plain_language_model(model):
    """A function (context, word) -> averaged predictive probability, from the rows of a model, word by word."""
    held = {}
    for r in model.rows.collect():
        held.setdefault(r.home, {})[r.kind] = pitman_yor.unpacked(r.data)
    discount, pair_discount, strength = model.discount, model.pair_discount, pitman_yor.STRENGTH
    words, pairs, contexts = [{} for _ in model.samples], [{} for _ in model.samples], [{} for _ in model.samples]
    for home, kinds in held.items():
        own, (_, _, sizes, names, _, at, c) = pitman_yor.parted(kinds[pitman_yor.PLACES][0]), kinds[pitman_yor.STATE]
        names = pitman_yor.parted(names)
        for k, sample in enumerate(model.samples):
            customers = kinds[pitman_yor.WORDS + k][0]
            spelled = np.exp(pitman_yor.spell(own, sample.spelling.log_table())[0])
            tables = pitman_yor.reseated(home, customers, spelled, sample.begun, discount, pitman_yor.BURN_IN + k)
            words[k] |= dict(zip(own, zip(customers, tables)))
            i = 0
            for u, size in zip(own, sizes):
                t = kinds[pitman_yor.CONTEXTS + k][0][i : i + size]
                contexts[k][u] = (int(c[i : i + size].sum()), int(t.sum()))
                pairs[k] |= {(u, names[at[i + j]]): (int(c[i + j]), int(t[j])) for j in range(size)}
                i += size

    def probability(u, w):
        total = 0.0
        for k, sample in enumerate(model.samples):
            c, t = words[k].get(w, (0, 0))
            alone = max(c - discount * t, 0) / (strength + sample.customers) + model.new_table(sample) * math.exp(pitman_yor.spell([w], sample.spelling.log_table())[0][0])
            n, opened = contexts[k].get(u, (0, 0))
            c, t = pairs[k].get((u, w), (0, 0))
            total += max(c - pair_discount * t, 0) / (strength + n) + (strength + pair_discount * opened) / (strength + n) * alone
        return total / len(model.samples)

    return probability, words[0]


def test_language_model_equals_word_by_word_predictions_however_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "BLOCK_TEXT", 700)
    rng = random.Random(12)
    rows = [(i if i % 7 else None, " ".join(rng.choice(["a", "b", "cc", "ddd", "E"]) for _ in range(rng.randint(0, 30)))) for i in range(60)] + [(500, "a zz cc  zz"), (501, None)] + [(502, "b cc")] * 3
    docs = frame(spark, rows).withColumn("learn", F.coalesce(F.col("doc_id") < 500, F.lit(True))).withColumn("data", F.lit("x")).withColumn("block", F.lit(1))
    model = pitman_yor.learn(docs)
    assert model.blocks > 1
    result = lambda m, d: sorted((r.doc_id or -1, r.n_tokens, round(r.base_score, 9), round(r.score, 9)) for r in pitman_yor.score(d, m).collect())
    found = result(model, docs)
    again = docs.repartition(3, "text")
    assert found == result(pitman_yor.learn(again), again)
    probability, known = plain_language_model(model)
    by_hand = []
    for i, t in rows:
        tokens = [b"", *[w.lower().encode() for w in (t or "").split()], b""]
        by_hand.append((i or -1, len(tokens) - 1, round(sum(math.log10(probability(u, w)) for u, w in zip(tokens, tokens[1:])), 6)))
    assert sorted(by_hand) == sorted((i, n, round(score, 6)) for i, n, _, score in found)
    # after any context the known words leave something to the others
    for u in (b"a", b"", b"never"):
        assert 0.5 < sum(probability(u, w) for w in known) < 1


def test_seating_bounds():
    customers = np.array([0, 1, 2, 50, 100_000])
    t = pitman_yor.seat(customers, np.full(5, 0.5), 0.5, np.random.default_rng(0))
    assert list(t[:2]) == [0, 1] and all(1 <= x <= c for x, c in zip(t[1:], customers[1:]))


# --- url filter


def test_cascade_is_exact_on_its_universe(spark):
    keys = [f"host{i}.example" for i in range(3000)]
    listed = spark.createDataFrame([(k,) for k in keys[::7]], "key string")
    universe = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string")
    cascade = url_filter.Cascade(listed, universe)
    found = {r.key for r in universe.na.drop().filter(cascade.has(F.col("key"))).collect()}
    assert found == set(keys[::7])
    none = url_filter.Cascade(listed.filter("false"), universe)
    assert universe.filter(none.has(F.col("key"))).count() == 0


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/1?x", "https://a.example.com/en/2", "http://b.example.com/fr/1#t", "http://x.net/es/9", "http://free-bets.example.org/q", "no url", None, "http://", "http://x.org", "http://com/", "http://x.org", "http://x.net?/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.RULES, url_filter.listed_hosts(pages)).collect()}
    assert found[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and found[1] == ("a.example.com", "/en/2", "example.com/en/", "block")
    assert found[2] == ("b.example.com", "/fr/1", "com/", "allow") and found[3] == ("x.net", "/es/9", "net/es/", "block")
    assert found[4] == ("free-bets.example.org", "/q", None, "block") and found[5] == found[6] == found[7] == ("", "", None, "allow")
    assert found[8] == found[10] == ("x.org", "", None, "allow") and found[9][2] == "com/" and found[11] == ("x.net", "", None, "allow")


# --- near duplicates


def brute_components(rows, size, least):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = (t or "").translate(lower).split()
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and least[1] * len(sets[i] & sets[j]) >= least[0] * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return sets, label


@pytest.mark.parametrize("size, least", [(3, (9, 10)), (5, (4, 5))])
def test_jaccard_join_equals_brute_force(spark, size, least):
    rng = random.Random(size)
    rows = []
    for i in range(30):
        base = words(rng, rng.choice([0, 1, 2, 4, 30, 120]), 5000)
        for _ in range(rng.randint(1, 5)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                if own:
                    own[rng.randrange(len(own))] = rng.choice(["X", "Yy", "z"])
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows), None), (len(rows) + 1, " \n "), (len(rows) + 2, rows[3][1].upper())]
    sets, label = brute_components(rows, size, least)
    found = {r.doc_id: r for r in jaccard_join.near_duplicates(frame(spark, rows).withColumn("n_links", F.lit(0)).repartition(3), size=size, least=least).collect()}
    for k, (i, _) in enumerate(rows):
        assert found[i].n_shingles == len(sets[k])
        assert found[i].component_id == min(rows[j][0] for j in range(len(rows)) if label[j] == label[k])


def test_jaccard_join_of_ties_nulls_and_nothing(spark):
    assert jaccard_join.near_duplicates(empty(spark)).count() == 0
    r = jaccard_join.near_duplicates(frame(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A b c d e f"), (3, None)])).collect()
    assert len(r) == 4 and sorted((x.component_id for x in r)) == [3, 5, 5, 5]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    found = {r.node: r.label for r in components.connected_components(links).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[100] == found[101] == 100


# --- packing


def test_packing_is_gapless_and_tight(spark):
    from tokenizers import Tokenizer

    rng = random.Random(8)
    rows = [(i, " ".join(words(rng, rng.choice([0, 3, 40, 300, 900, 2500])))) for i in range(60)] + [(900, None), (3, "same id"), (None, "x y")]
    found = packing.pack_documents(frame(spark, rows).repartition(3), bpe.default_vocabulary(), bpe.default_vocabulary("byte_bpe_50k.tiktoken")).collect()
    library = Tokenizer.from_file(bpe.default_vocabulary())
    pieces = Counter()
    for i, t in rows:
        ids = array("I", [*library.encode(t or "", add_special_tokens=False).ids, 0])
        at, size = 0, len(ids) % 2048 or 2048
        while at < len(ids):
            pieces[i, at, size, zlib.crc32(ids[at : at + size].tobytes())] += 1
            at, size = at + size, 2048
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in found) == pieces
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.1 * math.ceil(sum(r.length for r in found) / 2048) + 2
    assert packing.pack_documents(empty(spark), bpe.default_vocabulary(), bpe.default_vocabulary("byte_bpe_50k.tiktoken")).count() == 0


@pytest.mark.parametrize("n", [1, 50, 5000])
def test_plans_hold_each_piece_once(n):
    rng = random.Random(n)
    histogram = Counter(min(2048, max(1, int(rng.lognormvariate(6.3, 1.1)))) for _ in range(n))
    runs = packing.plan(dict(histogram))
    held = Counter()
    for run in runs:
        assert sum(run.lengths) == 2048 - run.gap <= 2048
        for x in run.lengths:
            held[x] += run.times
    assert held == histogram


def checked(patterns, counts):
    used = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= 2048 and times > 0
        for s in pattern:
            used[s] += times
    assert used == Counter(counts)
    return sum(times for _, times in patterns)


def test_configurations_of_the_program_beat_best_filling():
    counts = {900: 400, 700: 600, 600: 500, 450: 300, 333: 900}
    program, plain = packing.linear_program(counts, 2048), packing.filled(counts, 2048)
    assert np.allclose(program.patterns @ program.times, [counts[s] for s in program.sizes]) and (program.patterns.T @ program.sizes <= 2048).all()
    assert math.ceil(program.times.sum() - 1e-6) <= math.ceil(program.bound - 1e-6) <= checked(plain, counts)
    both = checked(packing.configurations(counts, 2048), counts)
    assert both <= checked(plain, counts) and both <= program.bound + len(counts)


def test_the_program_is_solved_and_makes_the_plan_of_real_lengths(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    pieces = packing.token_pieces(docs, bpe.default_vocabulary(), bpe.default_vocabulary("byte_bpe_50k.tiktoken"))
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    large = {x: n for x, n in histogram.items() if 256 < x < 2048}
    rounded, sizes = packing.group_sizes(large, packing.GROUPS), Counter()
    for x, n in large.items():
        sizes[rounded[x]] += n
    program = packing.linear_program(sizes, 2048)
    assert program.times.sum() <= (1 + packing.GAP) * program.bound + 1
    first, left = packing.rounded_down(program, sizes)
    total = checked(packing.configurations(sizes, 2048), sizes)
    assert sum(times for _, times in first) > 0.95 * total and sum(left.values()) < 0.05 * sum(sizes.values())
    assert total < checked(packing.filled(sizes, 2048), sizes) and total <= 1.005 * program.bound
    assert sum(run.times for run in packing.plan(histogram)) <= 1.005 * sum(x * n for x, n in histogram.items()) / 2048


def test_the_dearest_configurations_equal_trial():
    sizes, price = np.array([300, 500, 700]), np.array([0.2, 0.3, 0.45])
    able = [(a, b, c) for a in range(7) for b in range(5) for c in range(3) if 300 * a + 500 * b + 700 * c <= 2048]
    value, found = packing.dearest(sizes, price, 2048)
    assert abs(value - max(price @ np.array(x) for x in able)) < 1e-12 and (sizes @ found <= 2048).all()
    for k in range(3):
        assert abs(max(price @ np.array(x) for x in able if x[k]) - max(price @ x for x in found.T if x[k])) < 1e-12


def test_blocks_of_ids_equal_bisection(spark):
    rng = random.Random(1)
    for n in (0, 1, 2, 5, 50):
        cuts = sorted({rng.randint(-100, 100) for _ in range(n)})
        ids = [*range(-105, 106), None]
        found = frame(spark, [(i, "") for i in ids]).select("doc_id", fingerprints.block_of(F.col("doc_id"), cuts).alias("b")).collect()
        assert all(r.b == (0 if r.doc_id is None else sum(c < r.doc_id for c in cuts)) for r in found)
