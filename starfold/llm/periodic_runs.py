"""Periodic runs of words by Main and Lorentz's divide and conquer.

A run is a longest stretch of words in which words ``q`` apart are identical, for its smallest period ``q``, of
``max(12, 2 q)`` words or more.  The words of a text become small numbers; the text is halved again and again, and the
repetitions that cross a midpoint are found from four Z-functions: how far the text from the midpoint agrees with the text ``q`` words
later or earlier, and how far the text before it does.  A run is found whole in the first segment whose midpoint it crosses; pieces
of it that segments further down find are dropped, because they extend beyond those segments.  A stretch with several periods keeps the smallest.

Six words that begin a match of a run stand in the run twice.  So texts, segments and midpoints around which no six words recur within the
segment need no Z-functions; the test is exact in one direction (hashes may collide, which only costs time).

Defined results: a null text has no words; an empty table gives an empty result; each row is judged for itself, so repeated
rows fare alike and ids may be null; a very long text is the work of one task, n log n in its words, and is never cut; extra columns are kept, and those called ``n_words``,
``runs`` or ``collapsed`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Runs, WordBlock, mix64, read_documents, sheltered, text_blocks

#: Words that a run has at least; it also has twice its period.
SHORTEST = 12
#: Consecutive words that any run holds twice: a run of period q agrees with itself, q words on, in max(12 - q, q) words or more.
SEED = SHORTEST // 2
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def z_function(s: list[int]) -> list[int]:
    """For each position, how many words from there on equal those from the start on; the first is the whole length."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def crossing(ids: list[int], lo: int, mid: int, hi: int, found: dict[tuple[int, int], int]) -> None:
    """Adds the runs of ids[lo:hi] that cross ``mid`` and that no word beside them extends: (start, end) -> smallest period."""
    n = len(ids)
    before, after, both = ids[lo:mid], ids[mid:hi], ids[lo:hi]
    m, k = len(before), len(after)
    before.reverse()
    # agreement with the words q later: forth from the midpoint, and back from it
    later = z_function(after)
    later.append(0)
    later_back = z_function(before + [-1] + both[::-1])
    # and with the words q earlier
    earlier = z_function(after + [-1] + both)
    earlier_back = z_function(before)
    earlier_back.append(0)
    hits = []
    for q in range(1, k + 1):
        forth, back = later[q], later_back[m + 1 + k - q]
        if forth + back >= q and forth + back + q >= SHORTEST:
            hits.append((mid - back, mid + q + forth, q))
    for q in range(1, m + 1):
        forth, back = earlier[k + 1 + m - q], earlier_back[q]
        if forth + back >= q and forth + back + q >= SHORTEST:
            hits.append((mid - q - back, mid + forth, q))
    for start, end, q in hits:
        if (start and ids[start - 1] == ids[start - 1 + q]) or (end < n and ids[end] == ids[end - q]):
            continue  # a piece of a run that a segment further up holds whole
        if found.get((start, end), n) > q:
            found[start, end] = q


def neighbours(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of SEED words, where it comes next and came last (past the end and -1: nowhere)."""
    n = len(ids) - SEED + 1
    code = mix64(ids.astype(U64) + U64(1))
    seed = np.zeros(n, dtype=U64)
    for k in range(SEED):
        seed = seed * U64(0x9E3779B97F4A7C15) + code[k : k + n]
    order = np.argsort(seed, kind="stable")
    same = seed[order[1:]] == seed[order[:-1]]
    after, last = np.full(n, len(ids)), np.full(n, -1)
    after[order[:-1][same]] = order[1:][same]
    last[order[1:][same]] = order[:-1][same]
    return after, last


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period."""
    if len(words) < SHORTEST:
        return []
    table: dict = {}
    ids = [table.setdefault(w, len(table)) for w in words]
    after, last = neighbours(np.array(ids, dtype=np.int64))
    at = np.flatnonzero(after < len(ids))
    after_at = after[at]
    after, last = after.tolist(), last.tolist()
    found: dict[tuple[int, int], int] = {}
    segments = [(0, len(ids))]
    while segments:
        lo, hi = segments.pop()
        a, b = np.searchsorted(at, (lo, hi))
        if hi - lo < SHORTEST or not (after_at[a:b] <= hi - SEED).any():
            continue
        mid = (lo + hi) // 2
        if any(after[i] <= hi - SEED or last[i] >= lo for i in range(max(lo, mid - SEED), min(mid, hi - SEED) + 1)):
            crossing(ids, lo, mid, hi, found)
        segments += (lo, mid), (mid, hi)
    return sorted(((start, end - start, q) for (start, end), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that any run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def may_repeat(texts: pa.Array) -> np.ndarray:
    """Whether any SEED words stand in a text twice, for many texts at once."""
    out = np.zeros(len(texts), dtype=bool)
    for lo, _, data, offsets in text_blocks(texts):
        block = WordBlock(data, offsets)
        count, first = block.counts(), block.first
        n = np.maximum(count - SEED + 1, 0)
        doc = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + first[doc]
        seed = mix64(Runs(block.hash).of(at, at + SEED) + doc.astype(U64) * U64(0xD1B54A32D192ED03))
        ranked = np.sort(seed)
        twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        if len(twice):
            out[lo + np.unique(doc[np.isin(seed, twice)])] = True
    return out


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words``, ``runs`` (start, length, period of each, by start and period) and ``collapsed``, the words that are kept, joined by a space."""

    @F.arrow_udf(f"struct<n_words: bigint, runs: array<{RUN}>, collapsed: string>")
    def work(texts: pa.Array) -> pa.Array:
        n, found, kept = [], [], []
        for value, live in zip(texts, may_repeat(texts).tolist()):
            # bytes are split at the space and U+0009..U+000D, nowhere else
            words = (value.as_py() or "").encode().split()
            runs = runs_of(words) if live else []
            n.append(len(words))
            found.append(runs)
            kept.append(b" ".join(collapse(words, runs)).decode())
        flat = np.array([r for runs in found for r in runs], dtype=np.int64).reshape(-1, 3)
        items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(runs) for runs in found])]).astype(np.int32))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, items), pa.array(kept, pa.string())], ["n_words", "runs", "collapsed"])

    own = ["n_words", "runs", "collapsed"]
    inner, held = sheltered(docs)
    made = inner.withColumn("found", work(F.col(held[text])))
    return made.select(*[F.col(held[c]).alias(c) for c in docs.columns if c not in own], *[F.col("found")[c].alias(c) for c in own])


def with_periods(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Makes the end of a tenth of the texts periodic: where h = crc32(id) is a multiple of 10, word i >= a becomes word a + (i - a) % p,
    with g = h div 10, a = g % n and p = 1 + (n - a) div (3 + g % 8); n counts the words.  A null id leaves its text alone."""
    h = F.crc32(F.col(key).cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    inner = docs.withColumn("__words", F.when(h % 10 == 0, words))
    n = F.size("__words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    inner = inner.withColumn("__cut", F.when(n > 0, F.struct(a.alias("a"), p.alias("p"))))
    at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < F.col("__cut.a"), i).otherwise(F.col("__cut.a") + (i - F.col("__cut.a")) % F.col("__cut.p")))
    edited = F.array_join(F.transform(at, lambda i: F.get("__words", i)), " ")
    return inner.withColumn(text, F.when(F.col("__cut").isNotNull(), edited).otherwise(F.col(text))).drop("__words", "__cut")


def longest(runs: Column) -> Column:
    """The longest run; of several the first, then the one of smallest period."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("back"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(ranked)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(read_documents(spark, sf_dir, "text"))).withColumn("top", longest(F.col("runs")))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    length, period = -F.col("top.back"), F.col("top.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
