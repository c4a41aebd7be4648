"""Exact quantiles of whole columns by distributed selection.

A double becomes a 64-bit number of the same order.  One pass counts its first 16 bits; each wanted rank lies in one of these buckets, the next pass
counts the next 16 bits of the rows in those, and so on.  As soon as the buckets left hold few rows, their values are fetched; a bucket of one
repeated value is decided at once.  Nothing ever holds a column, or its distinct values, in one place: the driver gets at most 65,536 counts for a wanted
bucket, and ``FETCHED`` values.

Defined results: NULL and NaN don't count; between two ranks a quantile is interpolated; without values it is None.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions.photometry import null_nan

#: Bits of a pass, and values that are fetched at most once the buckets left are small.
DIGIT, FETCHED = 16, 100_000


def ordered(x: np.ndarray) -> np.ndarray:
    """Doubles as signed longs of the same order."""
    bits = np.ascontiguousarray(x, dtype=np.float64).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def values_of(keys: np.ndarray) -> np.ndarray:
    keys = np.asarray(keys, dtype=np.int64)
    return np.where(keys < 0, keys ^ np.int64(2**63 - 1), keys).view(np.float64)


def keyed(rows: DataFrame) -> DataFrame:
    """(c, v) -> (c, k) of the values that count."""

    @F.arrow_udf("bigint")
    def work(v: pa.Array) -> pa.Array:
        return pa.array(ordered(v.to_numpy(zero_copy_only=False)))

    return rows.select("c", null_nan(F.col("v").cast("double")).alias("v")).filter("v is not null").select("c", work("v").alias("k"))


def of_groups(rows: DataFrame, shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Quantiles of ``v`` for each name ``c``; the names must be few, as each has its counts on the driver."""
    keys = keyed(rows)
    spark = rows.sparkSession

    def counted(wanted: DataFrame | None, level: int) -> dict[tuple, list[tuple[int, int, int, int]]]:
        """(c, prefix) -> [(digit prefix, rows, least, largest)] in order."""
        shift = 64 - DIGIT * (level + 1)
        own = keys if wanted is None else keys.withColumn("p", F.shiftright("k", shift + DIGIT)).join(F.broadcast(wanted), ["c", "p"])
        prefix = F.lit(0) if wanted is None else F.col("p")
        found = own.groupBy("c", prefix.cast("long").alias("p"), F.shiftright("k", shift).alias("d")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
        out: dict[tuple, list] = {}
        for r in found.collect():
            out.setdefault((r["c"], r["p"]), []).append((r["d"], r["n"], r["lo"], r["hi"]))
        return {k: sorted(v) for k, v in out.items()}

    buckets = counted(None, 0)
    size = {c: sum(n for _, n, _, _ in found) for (c, _), found in buckets.items()}
    # each wanted rank of each name: where it is looked for, and its rank there
    ranks = {(c, r): ((c, 0), r) for c, n in size.items() for s in shares for r in {math.floor(s * (n - 1)), math.ceil(s * (n - 1))}}
    known: dict[tuple[str, int], int] = {}
    level = 0
    while ranks:
        found: dict[tuple, tuple[tuple, int, int]] = {}
        for target, (place, rank) in ranks.items():
            for digit, n, lo, hi in buckets[place]:
                if rank < n:
                    break
                rank -= n
            if lo == hi:
                known[target] = lo
            else:
                found[target] = ((place[0], digit), rank, n)
        ranks = {t: (place, rank) for t, (place, rank, _) in found.items()}
        if not ranks:
            break
        places = {place: n for place, _, n in found.values()}
        wanted = spark.createDataFrame(list(places), "c string, p long")
        if sum(places.values()) <= FETCHED:
            shift = 64 - DIGIT * (level + 1)
            near = keys.withColumn("p", F.shiftright("k", shift)).join(F.broadcast(wanted), ["c", "p"]).toArrow().to_pandas()
            held = {k: np.sort(g.to_numpy()) for k, g in near.groupby(["c", "p"])["k"]}
            known |= {t: int(held[place][rank]) for t, (place, rank) in ranks.items()}
            break
        level += 1
        buckets = counted(wanted, level)
    at = lambda c, r: float(values_of(np.array([known[c, r]]))[0])

    def one(c: str, share: float) -> float | None:
        x = share * (size[c] - 1)
        low, high = at(c, math.floor(x)), at(c, math.ceil(x))
        return low if low == high else low + (x - math.floor(x)) * (high - low)

    return {c: [one(c, s) for s in shares] for c in size}


def of_columns(table: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Quantiles of each of the columns, all in the same passes."""
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(str(i)).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]))
    found = of_groups(table.select(pairs.alias("x")).select("x.*"), shares)
    return {c: found.get(str(i), [None] * len(shares)) for i, c in enumerate(columns)}
