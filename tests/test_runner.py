"""The chunked runner: killed half way, rerun, changed ids, torn attempts, empty chunks."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from starfold.operators.runner import ChunkedRun, in_chunks


def ids(spark, n=40):
    return spark.range(n).select(F.col("id")).union(spark.createDataFrame([(3,), (None,)], "id long"))


class Work:
    """Squares of ids that aren't multiples of 5; remembers which chunks it was given, and breaks at its ``breaks``-th call."""

    def __init__(self, breaks=None):
        self.calls, self.breaks, self.lock = 0, breaks, threading.Lock()

    def __call__(self, chunk):
        with self.lock:
            self.calls += 1
            if self.calls == self.breaks:
                raise RuntimeError("killed")
        return chunk.filter("id % 5 <> 0").select("id", (F.col("id") * F.col("id")).alias("square"))


EXPECTED = [(i, i * i) for i in range(40) if i % 5]


def test_rerun_after_a_failure_does_only_the_rest(spark, tmp_path):
    job = ChunkedRun(spark, f"{tmp_path}/run")
    job.plan(ids(spark), 6)
    broken = Work(breaks=4)
    with pytest.raises(RuntimeError):
        job.run(broken, at_once=1)
    done = {r.chunk: r.attempt for r in job.committed().collect()}
    assert len(done) == 3
    # an attempt that was torn before its commit isn't read
    spark.createDataFrame([(99, 99)], "id long, square long").write.parquet(f"{tmp_path}/run/data/chunk=5/attempt=torn")
    again = Work()
    assert len(job.run(again, at_once=1)) == 3 == again.calls
    after = {r.chunk: r.attempt for r in job.committed().collect()}
    assert {c: after[c] for c in done} == done and len(after) == 6
    assert sorted(map(tuple, job.result().collect())) == EXPECTED
    assert job.run(Work()) == []


def test_result_equals_an_uninterrupted_run(spark, tmp_path):
    assert sorted(map(tuple, in_chunks(ids(spark), Work(), f"{tmp_path}/whole", 5).collect())) == EXPECTED


def test_chunks_whose_ids_changed_are_done_again(spark, tmp_path):
    root = f"{tmp_path}/run"
    in_chunks(ids(spark), Work(), root, 6)
    job, work = ChunkedRun(spark, root), Work()
    job.plan(ids(spark, 41), 99)  # the number of chunks stays
    assert len(job.run(work)) == 1 == work.calls
    job.plan(ids(spark, 42), 6)
    job.run(Work())
    assert sorted(map(tuple, job.result().collect())) == EXPECTED + [(41, 41 * 41)]


def test_empty_chunks_are_committed(spark, tmp_path):
    root, fives = f"{tmp_path}/run", spark.range(0, 50, 5).toDF("id")
    assert in_chunks(fives, Work(), root, 4).count() == 0
    job = ChunkedRun(spark, root)
    assert job.run(Work()) == [] and {r.rows for r in job.committed().collect()} == {0}


def test_no_ids(spark, tmp_path):
    assert in_chunks(spark.range(0).toDF("id"), Work(), f"{tmp_path}/run", 4) is None
