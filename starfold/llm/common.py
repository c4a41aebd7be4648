"""Helpers that the text operators share: shared-folder tables, document hygiene and vectorised words.

Texts reach Python as Arrow batches.  ``WordBlock`` turns a run of texts into one byte array with word
boundaries and a 64-bit hash for every word, so that the cost for each document is a slice, not a loop.
"""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Rows of a few numbers that are sent to the tasks by broadcast, at most, after they have been counted; more are shuffled.
BROADCAST_ROWS = 500_000
#: Bytes of text that are worked on at once; a longer document is a block of its own.
BLOCK_BYTES = 500_000
#: Rows that a function of Arrow batches gets at once.
BATCH_ROWS = 1000


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder that the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only where it is unset and Spark runs in this process alone, a folder of
    this machine is used; on a cluster it's an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="starfold-ckpt-"))
    return df.checkpoint(eager=True)


def sheltered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns numbered, and what each is called now: so no name of theirs clashes with an operator's own."""
    names = {c: f"__in{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle and checkpoint files of DataFrames that are gone.

    It does so when the driver's JVM finds them unreachable, which may be long after a lineage was cut; a job of many
    large steps asks for it between them, so that their files don't stand side by side.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """While it lasts, Spark hands rows to Python in Arrow batches of at most ``rows``: buffers of whole texts are what an executor holds
    beside its heap.  Only for work that is done (checkpointed) inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(min(rows, int(before or rows)) if int(before or rows) > 0 else rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def read_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", *columns)


def is_held_out(key: str, modulus: int, remainder: int):
    """crc32 of the id's decimal text, modulo ``modulus``, equals ``remainder`` (a null id is not held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(modulus)) == remainder, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers, applied to whole arrays."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xC2B2AE3D27D4EB4F)
    x ^= x >> U64(32)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=U64) if n else out


_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_BYTE_INV, _WORD_INV = _inverse(_BYTE_BASE), _inverse(_WORD_BASE)
_BYTE_CODE = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class WordBlock:
    """Words (runs without space or U+0009..U+000D) of some texts, with hashes.

    ``first[d]:first[d+1]`` are the words of text ``d``; ``start``/``end`` their byte offsets in ``data``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        word = ~_IS_SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = word[:-1]
        self.start = np.flatnonzero(word & (~before | edge[:n]))
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = word[1:]
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)

    @property
    def hash(self) -> np.ndarray:
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(_BYTE_CODE[self.data] * _powers(_BYTE_BASE, n), out=sums[1:])
        raw = (sums[self.end] - sums[self.start]) * _powers(_BYTE_INV, n + 1)[self.start]
        return mix64(raw + (self.end - self.start).astype(U64) * U64(0xA0761D6478BD642F))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


class Runs:
    """Hashes of runs of words from prefix sums, under two independent mixes."""

    def __init__(self, words: np.ndarray, seed: int = 0):
        n = len(words)
        code = mix64(words + U64((seed * 0x8CB92BA72F3D8DD7) & (2**64 - 1)))
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(code * _powers(_WORD_BASE, n), out=self.sums[1:])
        self.back = _powers(_WORD_INV, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix64(raw + (end - start).astype(U64) * U64(0xE7037ED1A0B428DB))


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts an Arrow string column into blocks: (first row, end row, bytes, offsets).  A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    at = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + BLOCK_BYTES, side="right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` of a function of one batch, which gets ``BATCH_ROWS`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                yield work(batch.slice(lo, BATCH_ROWS))

    return df.mapInArrow(run, schema)


def list_array(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
