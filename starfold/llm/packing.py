"""Best-fit packing of documents into sequences of a fixed number of tokens.

Method: linear grouping.  Large lengths are put in groups of equal cardinality and rounded up to the
largest of their group; configurations of the few rounded sizes are optimised by a linear program whose columns are generated (each round
prices the sizes and adds the configurations that are worth most) until it is solved, and rounded down; actual
documents take the places of the rounded ones; small documents then go to the tightest gap that holds them.

Everything the driver plans with is the histogram of lengths, which has at most ``capacity`` entries however
many documents there are; bins of equal content are one *run* with a multiplicity.  Rows find their place by
their rank among rows of equal length, which is counted by (input partition, length), so that a length that a third of all
rows share is still counted in many tasks.

Defined results: null text counts as empty (one piece that is the end id alone); repeated rows are packed
each for itself; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import default_vocabulary, encoder
from .common import arrow_map, read_documents, shared_checkpoint

CAPACITY = 2048
#: Lengths over capacity / SMALL_PART are large.
SMALL_PART = 8
#: Groups of equal cardinality among the large lengths.
GROUPS = 128
#: How much prices lean to the best feasible ones.
SMOOTH = 0.95
#: Share of the sequences by which a program may lie above its bound.
GAP = 0.001
#: Rounds after which the program's inverse is computed anew.
RENEWED = 20
END_ID = 0


def token_pieces(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document: its ids, then the end id, cut only where longer than ``capacity``.

    The first piece takes the remainder, the others are full.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path, ranks)
        end = END_ID.to_bytes(4, "little")
        row, piece, start, length, crc = [], [], [], [], []
        for i, text in enumerate(batch.column("text")):
            raw = own.encode(text.as_py() or "") + end
            total = len(raw) // 4
            at, k = 0, 0
            size = total % capacity or capacity
            while at < total:
                row.append(i), piece.append(k), start.append(at), length.append(size)
                crc.append(zlib.crc32(raw[4 * at : 4 * (at + size)]))
                at, k, size = at + size, k + 1, capacity
        ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
        return pa.RecordBatch.from_arrays([ids, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_map(docs.select("doc_id", "text"), work, "doc_id long, piece int, start long, length long, ids_crc32 long")


@dataclass
class Run:
    """``times`` sequences that hold pieces of the same lengths."""

    lengths: list[int]
    times: int
    gap: int


def group_sizes(counts: dict[int, int], groups: int) -> dict[int, int]:
    """Linear grouping: each length's rounded-up size, groups holding about equally many documents."""
    total, seen, cut = sum(counts.values()), 0, 1
    size: dict[int, int] = {}
    held: list[int] = []
    for length in sorted(counts):
        held.append(length)
        seen += counts[length]
        if seen * groups >= total * cut:
            size |= dict.fromkeys(held, length)
            held = []
            cut = seen * groups // total + 1
    return size


def fill(sizes: list[int], room: int) -> list[int]:
    """A multiset of ``sizes`` (descending) whose sum is the largest that fits in ``room``; large sizes are preferred."""
    mask = (1 << (room + 1)) - 1
    reach = 1
    for s in sizes:
        step = s
        while step <= room:  # doubling: after it any number of s has been added
            reach |= (reach << step) & mask
            step *= 2
    best, out = reach.bit_length() - 1, []
    while best:
        s = next(s for s in sizes if s <= best and reach >> (best - s) & 1)
        out.append(s)
        best -= s
    return out


def dearest(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """(largest worth of a configuration at these prices, columns): for each size the dearest configuration that holds it.

    The knapsack problem by dynamic programming; one table answers for every room that is left.
    """
    best = np.zeros(capacity + 1)
    steps = np.zeros((len(sizes), capacity + 1), dtype=np.int64)
    for k, (size, worth) in enumerate(zip(sizes.tolist(), price.tolist())):
        if worth <= 0:
            continue
        before = best
        best = before.copy()
        for n in range(1, capacity // size + 1):
            more = before[: capacity + 1 - n * size] + n * worth
            better = more > best[n * size :]
            best[n * size :][better] = more[better]
            steps[k, n * size :][better] = n
    room = capacity - sizes
    found = np.zeros((len(sizes), len(sizes)))
    for k in range(len(sizes) - 1, -1, -1):
        found[k] = steps[k, room]
        room = room - found[k].astype(np.int64) * sizes[k]
    return float(best[capacity]), np.unique(found + np.eye(len(sizes)), axis=1)


def greedy_basis(sizes: np.ndarray, wanted: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, fractional multiplicities) by best filling: each pattern uses up one size, so there are as many as sizes."""
    left = dict(zip(sizes.tolist(), wanted.tolist()))
    place = {s: k for k, s in enumerate(sizes.tolist())}
    columns, times = [], []
    while left:
        top = max(left)
        need = Counter([top, *fill(sorted(left, reverse=True), capacity - top)])
        scarce = min(need, key=lambda s: left[s] / need[s])
        n = left[scarce] / need[scarce]
        column = np.zeros(len(sizes))
        for s, k in need.items():
            column[place[s]] = k
            left[s] -= k * n
        del left[scarce]
        # rounding may leave a hair below nothing
        left = {s: max(x, 0.0) for s, x in left.items()}
        columns.append(column), times.append(n)
    return np.array(columns).T, np.array(times)


@dataclass
class Program:
    """Patterns (columns over the sizes) with fractional multiplicities; no solution needs less than ``bound``."""

    sizes: np.ndarray
    patterns: np.ndarray
    times: np.ndarray
    bound: float


def linear_program(counts: dict[int, int], capacity: int) -> Program:
    """The linear program that needs the fewest sequences for ``counts``: the simplex method with generated columns, from the greedy patterns.

    It ends when no configuration is worth more than a sequence, or when by the prices' bound not one whole sequence, or less than the share ``GAP``, is left to gain.
    """
    sizes = np.array(sorted(s for s, n in counts.items() if n), dtype=np.int64)
    wanted = np.array([counts[s] for s in sizes], dtype=float)
    base, times = greedy_basis(sizes, wanted, capacity)
    inverse = np.linalg.inv(base)
    bound = float(sizes @ wanted) / capacity
    enough = lambda: math.ceil(times.sum() - 1e-6) <= math.ceil(bound - 1e-6) or times.sum() <= (1 + GAP) * bound
    # configurations are generated at prices between the program's and the best feasible ones so far, at first a size's share of
    # a sequence: the program's own prices swing too far in its first rounds
    held, near, rounds = sizes / capacity, SMOOTH, 0
    while not enough():
        price = inverse.sum(axis=0)
        between = near * held + (1 - near) * price
        value, columns = dearest(sizes, between, capacity)
        # prices over the dearest pattern's worth are feasible for the dual program
        if (low := float(between @ wanted) / max(value, 1.0)) > bound:
            bound, held = low, between / max(value, 1.0)
        if np.einsum("i,ij->j", price, columns).max() <= 1 + 1e-7:
            if not near:
                break
            near = near / 2 if near > 0.05 else 0.0
            continue
        near = SMOOTH
        # the new columns enter one after another, the dearest first, as long as any is worth more than a sequence
        moved = False
        for _ in range(4 * len(sizes)):
            worth = np.einsum("i,ij->j", inverse.sum(axis=0), columns)
            best = int(np.argmax(worth))
            if worth[best] <= 1 + 1e-7:
                break
            step = np.einsum("ij,j->i", inverse, columns[:, best])
            able = step > 1e-7
            if not able.any():
                break
            ratio = np.where(able, times / np.where(able, step, 1), np.inf)
            out = int(np.argmin(ratio))
            base[:, out], moved = columns[:, best], True
            times = times - ratio[out] * step
            times[out] = ratio[out]
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
        if not moved:
            break
        rounds += 1
        if rounds % RENEWED == 0:
            # anew from the patterns, so that rounding errors don't add up
            inverse = np.linalg.inv(base)
            times = np.maximum(inverse @ wanted, 0)
    times = np.maximum(np.linalg.solve(base, wanted), 0)
    return Program(sizes, base, times, bound)


def configurations(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns of the few rounded sizes with whole multiplicities that hold every piece once.

    The program's multiplicities are rounded down.  What that leaves, less than one sequence of each pattern, is packed by smaller programs of its own, or by
    best filling if that needs fewer sequences.
    """
    if not any(counts.values()):
        return []
    first, left = rounded_down(linear_program(counts, capacity), counts)
    return first + min(dived(left, capacity), filled(left, capacity), key=lambda found: sum(times for _, times in found))


def whole(column: np.ndarray, sizes: np.ndarray, times: int, left: Counter[int]) -> list[tuple[list[int], int]]:
    """The pattern as often as it's wanted and pieces are left for it; they are taken from ``left``."""
    need = {int(s): int(c) for s, c in zip(sizes, column) if c > 0.5}
    times = min([times, *(left[s] // c for s, c in need.items())])
    if times <= 0:
        return []
    for s, c in need.items():
        left[s] -= c * times
    return [([s for s, c in sorted(need.items(), reverse=True) for _ in range(c)], times)]


def rounded_down(program: Program, counts: dict[int, int]) -> tuple[list[tuple[list[int], int]], Counter[int]]:
    """(patterns with multiplicities rounded down, the pieces that are left)."""
    left, out = Counter({s: n for s, n in counts.items() if n}), []
    for k, n in enumerate(np.floor(program.times + 1e-9).astype(np.int64).tolist()):
        out += whole(program.patterns[:, k], program.sizes, n, left)
    return out, +left


def dived(counts: Counter[int], capacity: int) -> list[tuple[list[int], int]]:
    """Programs one after another, each rounded down; where that leaves nothing, its patterns with the largest fractions are taken once."""
    left, out = Counter(counts), []
    while left := +left:
        program = linear_program(left, capacity)
        found, left = rounded_down(program, left)
        if not found:
            order = np.argsort(-program.times, kind="stable").tolist()
            for k in [order[0], *(k for k in order[1:] if program.times[k] > 0.6)]:
                found += whole(program.patterns[:, k], program.sizes, 1, left)
        if not found:
            # the pattern holds more of a size than is left
            return out + filled(left, capacity)
        out += found
    return out


def filled(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns by best filling: the largest size left, and with it what fills the sequence as tightly as can be."""
    left = {s: n for s, n in counts.items() if n}
    out = []
    while left:
        top = max(left)
        enough = sorted(left, reverse=True)
        while True:
            pattern = [top, *fill(enough, capacity - top)]
            need = Counter(pattern)
            short = [s for s, k in need.items() if left[s] < k]
            if not short:
                break
            enough = [s for s in enough if s not in short]
        times = min(left[s] // k for s, k in need.items())
        out.append((pattern, times))
        for s, k in need.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
    return out


def substitute(patterns: list[tuple[list[int], int]], counts: dict[int, int], rounded: dict[int, int], capacity: int) -> list[Run]:
    """Puts actual lengths, longest first, in the places of rounded sizes; equal sequences stay one run."""
    stock: dict[int, list[list[int]]] = {}
    for length in sorted(counts):
        stock.setdefault(rounded[length], []).append([length, counts[length]])
    runs = []
    for pattern, times in patterns:
        while times:
            now = min(times, *(stock[s][-1][1] // k or 1 for s, k in Counter(pattern).items()))
            if any(stock[s][-1][1] < k for s, k in Counter(pattern).items()):
                now = 1
            lengths = []
            for s in pattern:
                entry = stock[s][-1]
                lengths.append(entry[0])
                entry[1] -= now
                if not entry[1]:
                    stock[s].pop()
            runs.append(Run(lengths, now, capacity - sum(lengths)))
            times -= now
    return runs


def best_fit(runs: list[Run], counts: dict[int, int], capacity: int) -> list[Run]:
    """Adds lengths, longest first, each to the tightest gap that holds it, or to a new sequence."""
    by_gap: dict[int, list[Run]] = {}
    for run in runs:
        by_gap.setdefault(run.gap, []).append(run)
    gaps = sorted(by_gap)
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                many = max(1, min(n, n // (capacity // length)))
                run, gap = Run([], many, capacity), capacity
            else:
                gap = gaps[at]
                run = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[at]
            if run.times > n:
                rest = Run(list(run.lengths), run.times - n, run.gap)
                if gap not in by_gap:
                    bisect.insort(gaps, gap)
                by_gap.setdefault(gap, []).append(rest)
                run.times = n
            n -= run.times
            run.lengths.append(length)
            run.gap -= length
            if run.gap not in by_gap:
                bisect.insort(gaps, run.gap)
            by_gap.setdefault(run.gap, []).append(run)
    return [run for held in by_gap.values() for run in held]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs that hold every piece of the histogram once."""
    full = [Run([capacity], histogram[capacity], 0)] if histogram.get(capacity) else []
    large = {x: n for x, n in histogram.items() if capacity // SMALL_PART < x < capacity}
    small = {x: n for x, n in histogram.items() if x <= capacity // SMALL_PART}
    rounded = group_sizes(large, groups)
    sizes: Counter[int] = Counter()
    for x, n in large.items():
        sizes[rounded[x]] += n
    runs = substitute(configurations(sizes, capacity), large, rounded, capacity)
    return full + best_fit(runs, small, capacity)


def places(runs: list[Run]) -> tuple[np.ndarray, ...]:
    """Sorted by (length, first rank): where ranks of a length begin, the sequence of the first, and the offset."""
    rank: Counter[int] = Counter()
    rows, sequence = [], 0
    for run in runs:
        offset = 0
        for length in run.lengths:
            rows.append((length, rank[length], sequence, offset))
            rank[length] += run.times
            offset += length
        sequence += run.times
    rows.sort()
    return tuple(np.array([r[k] for r in rows], dtype=np.int64) for k in range(4))


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have a ``length``; the rows are checkpointed, as they are read twice."""
    pieces = shared_checkpoint(pieces).withColumn("__part", F.spark_partition_id())
    counts = pieces.groupBy("__part", "length").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    table = places(plan(histogram, capacity, groups))
    before = counts.select("__part", "length", (F.sum("count").over(Window.partitionBy("length").orderBy("__part")) - F.col("count")).alias("__before"))
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]
    ranked = pieces.withColumn("__rank", F.row_number().over(Window.partitionBy("__part", "length").orderBy(*order)) - 1)
    placed = ranked.join(before, ["__part", "length"]).withColumn("__rank", (F.col("__rank") + F.col("__before")).cast("long"))
    kept = [c for c in pieces.columns if c != "__part"]
    wanted = placed.select(*kept, "__rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema if f.name != "__rank") + ", sequence_id long, offset long"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, first, sequence, offset = table
        x, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "__rank"))
        wide = int(first.max(initial=0)) + int(rank.max(initial=0)) + 2
        at = np.searchsorted(length * wide + first, x * wide + rank, side="right") - 1
        columns = [batch.column(c) for c in kept]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])], [*kept, "sequence_id", "offset"])

    return arrow_map(wanted, work, schema)


def pack_documents(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places."""
    return pack(token_pieces(docs, path, ranks, capacity), capacity)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "text")
    return pack_documents(docs, default_vocabulary(), default_vocabulary("byte_bpe_50k.tiktoken"))
