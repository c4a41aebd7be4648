"""Predictions: combining models, one row for each source, sampling for follow-up, comparing runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.functions.photometry import null_nan
from starfold.operators import quantiles
from starfold.operators.modelling import hash_order, up_to_row

#: Ids that name a source, in order of preference; 0 is "none".
SURVEYS = ("Gaia_EDR3___id", "AllWISE___id", "PS1_DR1___id")
#: Shares that the groups of one source are dealt into.
SHARES = 64


def combine_models(left: DataFrame, right: DataFrame, key: str = "_id") -> DataFrame:
    """Rows that both models scored; columns that the left has already are dropped from the right."""
    return left.join(right.select(key, *[c for c in right.columns if c not in left.columns]), key)


def merge_models(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("obj_id", "survey_id"), method: str = "mean") -> DataFrame:
    """Scores of one class from either model as one column ({class}_dnn, {class}_xgb -> {class}), mean or max for each source;
    only sources that both models have."""
    plain = lambda t: t.withColumnsRenamed({c: c.rsplit("_", 1)[0] for c in t.columns if c.endswith(("_dnn", "_xgb"))})
    a, b = plain(left), plain(right)
    sources = [t.select(keys[0], F.lit(i).alias("side")).distinct() for i, t in enumerate((a, b))]
    both = sources[0].union(sources[1]).groupBy(keys[0]).agg(F.count(F.lit(1)).alias("sides")).filter("sides = 2").select(keys[0])
    rows = a.unionByName(b, allowMissingColumns=True)
    agg = {"mean": F.avg, "max": F.max}[method]
    merged = rows.groupBy(*keys).agg(*[agg(c).alias(c) for c in rows.columns if c not in keys])
    # a source may have very many groups: they are dealt into shares, and what both models have is repeated for each
    dealt = merged.withColumn("__share", F.pmod(F.xxhash64(*keys), F.lit(SHARES)).cast("int"))
    every = both.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return dealt.join(every, [keys[0], "__share"], "left_semi").select(merged.columns)


def classes_above(scores: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Adds ``labels``: names of the classes whose score exceeds the threshold."""
    return scores.withColumn("labels", F.filter(F.array(*[F.when(F.col(c) > threshold, F.lit(c)) for c in columns]), lambda x: x.isNotNull()))


def survey_id() -> Column:
    """``Survey___id_value`` of the first survey that has an id; NULL without any."""
    return F.coalesce(*[F.when(F.col(c) != 0, F.concat(F.lit(f"{c.removesuffix('id')}"), F.col(c).cast("string"))) for c in SURVEYS])


def consolidate(predictions: DataFrame, columns: Sequence[str], method: str = "mean", keep_unmatched: bool = False) -> DataFrame:
    """One row for each source: mean, max or median of the columns, and the least ``_id`` as its representative.

    Rows without any survey id vanish, or with ``keep_unmatched`` stand for themselves.
    """
    rows = predictions.withColumn("survey_id", survey_id())
    rows = rows.withColumn("survey_id", F.coalesce("survey_id", F.concat(F.lit("_id_"), F.col("_id").cast("string")))) if keep_unmatched else rows.filter("survey_id is not null")
    agg = {"mean": F.avg, "max": F.max, "median": lambda c: F.percentile(c, F.lit(0.5))}[method]
    return rows.groupBy("survey_id").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("n"), *[agg(c).alias(c) for c in columns])


def refield(consolidated: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sources that several fields have: the mean over fields."""
    return consolidated.groupBy("survey_id", "_id").agg(*[F.avg(c).alias(c) for c in columns])


def not_variable(scores: DataFrame, column: str = "vnv") -> DataFrame:
    return scores.withColumn("nonvar", F.bround(1 - F.col(column), 2))


def top_for_each_class(scores: DataFrame, columns: Sequence[str], n: int, threshold: float) -> DataFrame:
    """(class, rank, id, score): the best ``n`` rows of each class that reach the threshold."""
    long = scores.unpivot(["id"], list(columns), "class", "score").filter(F.col("score") >= threshold)
    return long.withColumn("rank", F.row_number().over(Window.partitionBy("class").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= n)


def sample_for_each_class(scores: DataFrame, columns: Sequence[str], n: int, threshold: float, seed: int = 9) -> DataFrame:
    """(class, id): ``n`` rows of each class that reach the threshold, least hash first; a row may serve several classes."""
    long = scores.unpivot(["id"], list(columns), "class", "score").filter(F.col("score") >= threshold)
    order = [hash_order(F.col("id"), seed), F.col("id")]
    return long.withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy(*order))).filter(F.col("r") <= n).select("class", "id")


def sample_counting_selected(scores: DataFrame, columns: Sequence[str], n: int, threshold: float, seed: int = 9) -> DataFrame:
    """Rows chosen class by class until ``n`` of each reach the threshold: rows that an earlier class chose count for later ones.

    Each class takes what it still needs from the rest, least hash first.  Only counts and the last row taken come to the driver.
    """
    order = F.struct(hash_order(F.col("id"), seed).alias("h"), F.col("id").alias("k"))
    chosen = F.lit(False)
    for c in columns:
        able = F.coalesce(F.col(c) >= threshold, F.lit(False))
        needed = n - scores.agg(F.count_if(able & chosen).alias("n")).first()["n"]
        if needed <= 0:
            continue
        rest = scores.filter(able & ~chosen).select(order.alias("o"))
        last = rest.orderBy("o").offset(needed - 1).limit(1).first()
        chosen = chosen | (able & up_to_row(F.col("id"), seed, last["o"]) if last else able)
    return scores.filter(chosen)


def union_of_tops(parts: Sequence[DataFrame], key: str = "obj_id") -> DataFrame:
    """Union of selections: missing scores are 0, the largest of each source counts."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    columns = [c for c in whole.columns if c != key]
    return whole.na.fill(0.0, columns).groupBy(key).agg(*[F.max(c).alias(c) for c in columns])


def disagreements(scores: DataFrame, dnn: str, xgb: str, high: float = 0.95, low: float = 0.1) -> DataFrame:
    a, b = F.col(dnn), F.col(xgb)
    return scores.filter(((a > high) & (b <= low)) | ((a <= low) & (b > high)))


def high_scoring(scores: DataFrame, dnn: str, xgb: str, limit: float = 0.9, both: bool = False, limit_dnn: float | None = None, limit_xgb: float | None = None) -> DataFrame:
    a, b = F.col(dnn) > (limit_dnn or limit), F.col(xgb) > (limit_xgb or limit)
    return scores.filter(a & b if both else a | b)


def candidates(scores: DataFrame, significances: Sequence[str], n: int = 20) -> DataFrame:
    """Sources whose algorithms agree on a credible period, the most significant first."""
    found = scores.filter((F.col("agree_score") >= 0.5) & (F.col("best_agree_period") > 0.04) & (F.col("best_agree_period") < 10))
    return found.withColumn("max_sig", F.greatest(*significances) if len(significances) > 1 else F.col(significances[0])).orderBy(F.desc("max_sig"), "id").limit(n)


def compare_runs(a: DataFrame, b: DataFrame, column: str, key: str = "id") -> DataFrame:
    """Common sources of two runs: how many, and how often the second is better, equal or worse."""
    both = a.select(key, F.col(column).alias("x")).join(b.select(key, F.col(column).alias("y")), key)
    return both.agg(F.count(F.lit(1)).alias("common"), F.count_if(F.col("y") > F.col("x")).alias("better"), F.count_if(F.col("y") == F.col("x")).alias("same"), F.count_if(F.col("y") < F.col("x")).alias("worse"))


def compare_ranks(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs of ranked periods (id, algorithm, rank, period): for each algorithm and rank of the second, how many sources have a period,
    its median, its range, and how many equal the first run's best within 5 %."""
    first = a.filter("rank = 1").select("id", "algorithm", F.col("period").alias("first"))
    both = b.filter(F.col("period") > 0).join(first, ["id", "algorithm"])
    same = F.abs(F.try_divide("period", "first") - 1) < 0.05
    group = ["algorithm", "rank"]
    counts = both.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("period").alias("lo"), F.max("period").alias("hi"), F.count_if(same).alias("same"))
    name = F.to_json(F.struct(*group))
    # a few groups, of any number of rows: medians by selection, not in one task each
    medians = quantiles.of_groups(both.select(name.alias("c"), F.col("period").alias("v")), [0.5])
    known = a.sparkSession.createDataFrame([(c, m) for c, (m,) in medians.items()], "name string, median double")
    return counts.withColumn("name", name).join(F.broadcast(known), "name", "left").select(*group, "n", "median", "lo", "hi", "same")


def described(table: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, standard deviation, minimum, quartiles and maximum of a column without NULL and NaN."""
    x = null_nan(F.col(column).cast("double"))
    q = quantiles.of_columns(table, [column], [0.25, 0.5, 0.75])[column]
    found = table.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    return found.select("count", "mean", "std", "min", *[F.lit(v).cast("double").alias(f"q{p}") for v, p in zip(q, (25, 50, 75))], "max")


def with_object_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """All rows of predictions with the ``obj_id`` that their ``survey_id`` has in ``names`` (survey_id, obj_id); rows without one vanish."""
    return rows.withColumn("survey_id", survey_id()).join(names.select("survey_id", "obj_id").dropDuplicates(["survey_id"]), "survey_id")


def spurious_fraction(periods: DataFrame, shortest: float = 0.007) -> DataFrame:
    """Share of periods below the shortest credible one, for each algorithm."""
    return periods.groupBy("algorithm").agg(F.avg((F.col("period") < shortest).cast("int")).alias("fraction"))
