"""Long jobs in chunks that survive being killed: a plan, attempts, and a manifest whose rows are the commits.

* The ids are dealt into chunks by hash once, and written by chunk (``plan``); a chunk reads its own files only.
* An attempt at a chunk writes its result into a folder of its own (``data/chunk=.../attempt=...``).  What is half written there is never read.
* Only then one row is added to the ``manifest``: chunk, attempt, number of rows, and a digest of the chunk's ids.  That row is the commit, so a result is published whole or
  not at all; nothing is renamed, which object stores can't do atomically.  A chunk without rows has a row in the manifest too and isn't tried again.
* A later run does the chunks that the manifest lacks, or whose ids have changed since.  Of several commits of a chunk the latest counts.

Defined results: no ids, no chunks; a chunk whose work fails stops the run after the chunks in progress, and what was committed stays; repeated ids count once;
null ids are left out.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "chunk int, attempt string, rows long, n long, digest long, at double"


class ChunkedRun:
    """A run below ``root``, a folder that all executors share; ``chunks`` is fixed when the run is first planned."""

    def __init__(self, spark: SparkSession, root: str, key: str = "id"):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key

    def plan(self, ids: DataFrame, chunks: int) -> None:
        """Deals the ids into chunks.  A run that has a plan already keeps its number of chunks and takes the new ids."""
        known = self.planned()
        chunks = (known.agg(F.max("chunks")).first()[0] if known is not None else None) or chunks
        chunk = F.pmod(F.xxhash64(F.col(self.key)), F.lit(chunks)).cast("int")
        rows = ids.select(self.key).na.drop().distinct().withColumns({"chunks": F.lit(chunks), "chunk": chunk})
        # a plan is a folder of its own as well; the newest that was finished counts
        version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        rows.repartition("chunk").write.partitionBy("chunk").parquet(f"{self.root}/plan/{version}")
        self.spark.createDataFrame([(version, dict(ids.dtypes)[self.key])], "version string, kind string").coalesce(1).write.parquet(f"{self.root}/plans/plan={version}")

    def read(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def planned(self) -> DataFrame | None:
        """(key, chunks, chunk) of the newest plan."""
        plans = self.read("plans", "version string, kind string")
        newest = plans.agg(F.max(F.struct("version", "kind"))).first()[0] if plans is not None else None
        return self.read(f"plan/{newest['version']}", f"`{self.key}` {newest['kind']}, chunks int, chunk int") if newest else None

    def digests(self) -> DataFrame:
        """(chunk, n, digest): the ids of each chunk, in any order."""
        return self.planned().groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.expr(f"bit_xor(xxhash64(`{self.key}`))").alias("digest"))

    def committed(self) -> DataFrame:
        """(chunk, attempt, rows, n, digest, at): the commit of each chunk that counts."""
        rows = self.read("manifest", MANIFEST)
        if rows is None:
            return self.spark.createDataFrame([], MANIFEST)
        fields = ["at", "attempt", "rows", "n", "digest"]
        return rows.groupBy("chunk").agg(F.max(F.struct(*fields)).alias("x")).select("chunk", "x.attempt", "x.rows", "x.n", "x.digest", "x.at")

    def pending(self) -> DataFrame:
        """(chunk, n, digest) of the chunks without a commit of the same ids."""
        return self.digests().join(self.committed().select("chunk", "n", "digest"), ["chunk", "n", "digest"], "left_anti")

    def attempt(self, chunk: int, n: int, digest: int, work: Callable[[DataFrame], DataFrame]) -> None:
        ids = self.planned().filter(F.col("chunk") == chunk).select(self.key)
        name = uuid.uuid4().hex
        folder = f"{self.root}/data/chunk={chunk}/attempt={name}"
        found = work(ids)
        found.write.parquet(folder)
        rows = self.spark.read.schema(found.schema).parquet(folder).count()
        commit = self.spark.createDataFrame([(chunk, name, rows, n, digest, time.time())], MANIFEST)
        # a folder for each row: writers that share one would clear each other's temporary files
        commit.coalesce(1).write.parquet(f"{self.root}/manifest/commit={name}")

    def run(self, work: Callable[[DataFrame], DataFrame], at_once: int = 2) -> list[int]:
        """Does the pending chunks, ``at_once`` side by side; gives their numbers."""
        todo = sorted((r["chunk"], r["n"], r["digest"]) for r in self.pending().collect())
        failed = threading.Event()

        def one(*chunk: int) -> None:
            if failed.is_set():
                return
            try:
                self.attempt(*chunk, work)
            except BaseException:
                failed.set()
                raise

        with ThreadPoolExecutor(at_once) as pool:
            for job in [pool.submit(one, *x) for x in todo]:
                job.result()
        return [x[0] for x in todo]

    def result(self) -> DataFrame | None:
        """The rows of all committed chunks of the newest plan; None before the first commit."""
        chunks = self.digests().select("chunk", "n", "digest")
        commits = self.committed().join(chunks, ["chunk", "n", "digest"], "left_semi").collect()
        paths = [f"{self.root}/data/chunk={r['chunk']}/attempt={r['attempt']}" for r in commits]
        if not paths:
            return None
        return self.spark.read.schema(self.spark.read.parquet(paths[0]).schema).parquet(*paths)


def in_chunks(ids: DataFrame, work: Callable[[DataFrame], DataFrame], root: str, chunks: int, key: str = "id", at_once: int = 2) -> DataFrame | None:
    """Plans, does what is left to do and gives the whole result."""
    job = ChunkedRun(ids.sparkSession, root, key)
    job.plan(ids, chunks)
    job.run(work, at_once)
    return job.result()
