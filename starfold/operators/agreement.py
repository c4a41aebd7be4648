"""Agreement of algorithms on periods, consensus, and families of sidereal aliases.

Tables are long: (id, algorithm, rank from 1, period, significance).
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.functions.photometry import null_nan
from starfold.operators.periods import curve_tasks

# Harmonic ratios, shortest credible period (days), sidereal frequency (cycles a day).
HARMONICS = (1.0, 0.5, 2.0, 1 / 3, 3.0)
SIMPLE_HARMONICS = (1.0, 2.0, 0.5)
SHORTEST = 0.007
SIDEREAL = 24.0 / 23.9345


def together(periods: DataFrame, tasks: int | None = None) -> DataFrame:
    """The rows of a curve in one task, of a stated number: what follows by curve needs no further shuffle, and its tasks aren't merged into fewer and larger ones."""
    return periods.repartition(tasks or curve_tasks(periods.sparkSession), "id")


def judged(periods: DataFrame, columns: list[str], work: Callable[[list[tuple]], tuple], schema: str, tasks: int | None = None) -> DataFrame:
    """(id, ...): ``work`` on the rows of each curve, as tuples of ``columns``.  Many curves go to Python at once, as each has few rows."""
    listed = together(periods, tasks).groupBy("id").agg(F.collect_list(F.struct(*columns)).alias("rows"))

    @F.arrow_udf(f"struct<{schema}>")
    def found(rows: pa.Array) -> pa.Array:
        flat = rows.flatten()
        values = list(zip(*[flat.field(c).to_pylist() for c in range(len(columns))]))
        sizes, at, out = pa.compute.list_value_length(rows).to_pylist(), 0, []
        for n in sizes:
            out.append(work(values[at : at + n]))
            at += n
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = {"double": pa.float64(), "int": pa.int32(), "string": pa.string()}
        made = [pa.array([r[k] for r in out], kinds[x.split()[1]]) for k, x in enumerate(schema.split(", "))]
        return pa.StructArray.from_arrays(made, names)

    return listed.select("id", found("rows").alias("found")).select("id", "found.*")


def period_match(a: Column, b: Column, tolerance: float = 0.05, harmonics: tuple[float, ...] = HARMONICS) -> Column:
    """Some harmonic of b is within the tolerance of a; false for invalid periods."""
    found = F.lit(False)
    for h in harmonics:
        found = found | (F.abs(F.try_divide(a, b * h) - 1) < tolerance)
    return F.coalesce((a > 0) & (b > 0) & ~F.isnan(a) & ~F.isnan(b) & found, F.lit(False))


def agreement(periods: DataFrame, algorithms: list[str], shortest: float = SHORTEST, tolerance: float = 0.05, harmonics: tuple[float, ...] = HARMONICS) -> DataFrame:
    """Scores of each curve over the pairs of algorithms, in the order given.

    A pair agrees if any two of its periods match, strictly if its best ones do; its weight is the largest 1 / (rank * rank).
    The best agreed period is the one of the first algorithm of the first pair that agrees.
    """
    place = F.array_position(F.array(*map(F.lit, algorithms)), F.col("algorithm"))
    rows = together(periods.withColumn("a", place).filter("a > 0"))
    valid = rows.filter((F.col("period") >= shortest) & ~F.isnan("period"))
    x, y = valid.alias("x"), valid.alias("y")
    # no side goes to all tasks, however small its files are: a curve's rows are together already
    hits = x.join(y.hint("merge"), (F.col("x.id") == F.col("y.id")) & (F.col("x.a") < F.col("y.a"))).filter(period_match(F.col("x.period"), F.col("y.period"), tolerance, harmonics))
    pair = hits.groupBy(F.col("x.id").alias("id"), F.col("x.a").alias("a"), F.col("y.a").alias("b")).agg(
        F.max(1 / (F.col("x.rank") * F.col("y.rank"))).alias("weight"),
        F.max(((F.col("x.rank") == 1) & (F.col("y.rank") == 1)).cast("int")).alias("strict"),
        F.min_by("x.period", F.struct("x.rank", "y.rank")).alias("period"),
    )
    found = pair.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("strict").alias("strict"), F.sum("weight").alias("weight"), F.min_by("period", F.struct("a", "b")).alias("period"))
    total = F.col("k") * (F.col("k") - 1) / 2
    every = rows.groupBy("id").agg(F.count_distinct("a").alias("k")).join(found.hint("merge"), "id", "left")
    share = lambda c: F.coalesce(F.try_divide(F.coalesce(F.col(c), F.lit(0)), total), F.lit(0.0))
    return every.select(
        "id",
        F.coalesce("n", F.lit(0)).alias("n_agree_pairs"),
        total.cast("long").alias("n_total_pairs"),
        share("n").alias("agree_score"),
        share("strict").alias("agree_strict"),
        share("weight").alias("agree_weighted"),
        F.col("period").alias("best_agree_period"),
    )


def simple_agreement(periods: DataFrame, algorithms: list[str]) -> DataFrame:
    """The variant with three harmonics, no shortest period and four results."""
    found = agreement(periods, algorithms, shortest=0.0, harmonics=SIMPLE_HARMONICS)
    return found.select("id", "n_agree_pairs", "n_total_pairs", "agree_score", "best_agree_period")


def matches(a: float, b: float, tolerance: float = 0.05, harmonics: tuple[float, ...] = HARMONICS) -> bool:
    return a > 0 and b > 0 and any(abs(a / (b * h) - 1) < tolerance for h in harmonics)


def consensus_of(rows: list[tuple[int, int, float]]) -> float:
    """Period of most weighted votes.  Rows are (algorithm, rank, period); each votes in order for the first group that it matches."""
    votes: dict[float, float] = {}
    for own, rank, p in rows:
        vote = 0.0
        for other in sorted({a for a, _, _ in rows} - {own}):
            first = next((r for a, r, q in rows if a == other and matches(p, q)), None)
            vote += 1 / (rank * first) if first else 0.0
        group = next((q for q in votes if matches(p, q)), p)
        votes[group] = votes.get(group, 0.0) + vote
    best = max(votes, key=votes.get, default=math.nan)
    return best if votes.get(best, 0) > 0 else math.nan


def consensus(periods: DataFrame, algorithms: list[str], shortest: float = SHORTEST, tasks: int | None = None) -> DataFrame:
    """(id, best_consensus_period)."""
    place = {a: i for i, a in enumerate(algorithms)}

    def work(rows: list[tuple]) -> tuple:
        voting = sorted((place[a], int(r), p) for a, r, p in rows if a in place and p is not None and p >= shortest)
        return (consensus_of(voting),)

    found = judged(periods.withColumn("period", F.col("period").cast("double")), ["algorithm", "rank", "period"], work, "best_consensus_period double", tasks)
    return found.withColumn("best_consensus_period", null_nan(F.col("best_consensus_period")))


def sidereal_alias(a: Column, b: Column, orders: int = 15, tolerance: float = 0.03) -> Column:
    """Frequencies differ, up to a harmonic, by a whole number of sidereal frequencies."""
    found = F.lit(False)
    for h in (1.0, 0.5, 2.0):
        x = (1 / a - h / b) / F.lit(SIDEREAL)
        near = F.rint(x)
        found = found | ((F.abs(near) <= orders) & (F.abs(x - near) < tolerance))
    return F.coalesce((a > 0) & (b > 0) & found, F.lit(False))


def sidereal_edges(periods: DataFrame) -> DataFrame:
    """(id, a, b): pairs of a curve's entries, numbered by (algorithm, rank), that are aliases."""
    rows = together(periods.filter("period > 0")).withColumn("i", F.row_number().over(Window.partitionBy("id").orderBy("algorithm", "rank")))
    x, y = rows.alias("x"), rows.alias("y")
    pairs = x.join(y.hint("merge"), (F.col("x.id") == F.col("y.id")) & (F.col("x.i") < F.col("y.i")))
    return pairs.filter(sidereal_alias(F.col("x.period"), F.col("y.period"))).select(F.col("x.id").alias("id"), F.col("x.i").alias("a"), F.col("y.i").alias("b"))


def sidereal_families(periods: DataFrame, tasks: int | None = None) -> DataFrame:
    """The family of aliases that most algorithms, then the best ranks, support; one small group for each curve."""

    def alias(p: float, q: float) -> bool:
        x = [(1 / p - h / q) / SIDEREAL for h in (1.0, 0.5, 2.0)]
        return any(abs(round(v)) <= 15 and abs(v - round(v)) < 0.03 for v in x)

    def work(rows: list[tuple]) -> tuple:
        valid = [(a, r, p, math.nan if s is None else s) for a, r, p, s in rows if p is not None and p > 0]
        rows = sorted(valid, key=lambda x: (x[0] is None, x[0] or "", x[1]))
        family = list(range(len(rows)))
        for i in range(len(rows)):
            for j in range(i + 1, len(rows)):
                if family[i] != family[j] and alias(rows[i][2], rows[j][2]):
                    old, new = family[j], family[i]
                    family = [new if f == old else f for f in family]
        best = (0, 0.0, 0, math.nan, "")
        for f in dict.fromkeys(family):
            members = [r for r, g in zip(rows, family) if g == f]
            rank: dict[str, int] = {}
            for a, r, _, _ in members:
                rank[a] = min(rank.get(a, r), r)
            score = (len(rank), sum(1 / r for r in rank.values()))
            if score > best[:2]:
                top = max((m for m in members if m[1] == 1), key=lambda m: m[3], default=(None, 0, math.nan, 0))
                best = (*score, len(members), top[2], top[0] or "")
        return (*best[:3], len(rows), *best[3:])

    schema = "family_n_algos int, family_rank_score double, family_n_members int, family_n_total int, family_best_period double, family_best_algo string"
    numbers = periods.withColumns({c: F.col(c).cast("double") for c in ("period", "significance")})
    found = judged(numbers, ["algorithm", "rank", "period", "significance"], work, schema, tasks)
    return found.withColumn("family_best_period", null_nan(F.col("family_best_period")))
