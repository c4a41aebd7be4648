"""The pipeline's stages one after another on a small table."""

from __future__ import annotations

import os
import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytestmark = pytest.mark.skipif(not os.path.isdir("/opt/tokenizers"), reason="no tokenizer files")


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    line = lambda n: " ".join(f"{rng.choice(['ba', 'ko', 'ti'])}{rng.choice(['mu', 'ra', 'so'])}{rng.choice('xyz')}{rng.randint(0, 99)}" for _ in range(n))
    passage = line(60)
    rows = [(i, line(80) + ".", "aa", "s", 0) for i in range(40)]
    rows += [(100, rows[0][1], "aa", "s", 0), (101, rows[1][1] + " extra", "aa", "s", 0), (102, None, None, None, None), (103, "123 456", "aa", "s", 7)]
    rows += [(110 + i, line(30) + " " + passage + " " + line(30), "aa", "s", 0) for i in range(3)]
    bad = [(200 + i, "!! ".join(line(60).upper().split()) + "$$$", "aa", "s", 0) for i in range(20)]
    docs = spark.createDataFrame(rows + bad, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(200 + i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    ids = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{k}.parquet")
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if k == 3:
            assert all(passage not in r.text for r in docs.filter("doc_id >= 110").collect())
    assert 102 not in ids[0] and 103 not in ids[0] and {b[0] for b in bad} <= ids[0]
    assert not {b[0] for b in bad} & ids[1] and set(range(40)) <= ids[1]
    assert ids[2] == ids[1] - {100, 101} and ids[3] == ids[2] == ids[4]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_judge_rows_and_not_ids(spark):
    rng = random.Random(2)
    line = lambda: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(60))
    a, b, c, d, e = (line() for _ in range(5))
    rows = [(1, a), (7, a + " more"), (7, b), (8, c), (8, d), (None, e), (None, e + " more"), (None, d + " more"), (None, line()), (9, e), (9, e), (5, ""), (5, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "aa", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    expected = [rows[k] for k in (0, 2, 3, 4, 8, 9, 11, 12, 13)]
    assert sorted(kept, key=str) == sorted(expected, key=str)


def test_language_accepts_mixed_documents(spark):
    from starfold.llm import language_mix

    rows = [(1, "aa", 0.25, [0.25, 0.24, 0.24, 0.22]), (2, "aa", 0.2, [0.2]), (3, "aa", 0.9, [0.9]), (4, language_mix.UNKNOWN, 0.0, [])]
    found = spark.createDataFrame(rows, "doc_id long, lang_pred string, score double, shares array<double>").filter(language_mix.accepted())
    assert {r.doc_id for r in found.collect()} == {1, 3}
