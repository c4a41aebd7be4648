"""Training-set curation: labels, ambiguous matches, upserts, chunk merges, set operations, catalog completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def expand_labels(sources: DataFrame, mapper: dict[str, str], min_votes: int | None = None) -> DataFrame:
    """One column for each mapped label from ``;``-joined parallel lists.

    ``sources``: id, classification, probability[, votes].  The first probability of a class counts; classes without one are 0.0.
    With ``min_votes`` a label needs so many net votes.
    """
    lists = [F.split("classification", ";").alias("c"), F.split("probability", ";").alias("p")]
    if min_votes is not None:
        lists.append(F.split("votes", ";").alias("v"))
    opened = sources.select("id", F.posexplode(F.arrays_zip(*lists)).alias("i", "x")).select("id", "i", "x.*")
    if min_votes is not None:
        opened = opened.filter(F.expr("try_cast(v as int)") >= min_votes)
    first = opened.withColumn("r", F.row_number().over(Window.partitionBy("id", "c").orderBy("i"))).filter("r = 1")
    value = F.expr("try_cast(p as double)")
    wide = first.groupBy("id").agg(*[F.coalesce(F.max(F.when(F.col("c") == name, value)), F.lit(0.0)).alias(label) for name, label in mapper.items()])
    return sources.select("id").distinct().join(wide, "id", "left").na.fill(0.0, list(mapper.values()))


def join_lists(votes: DataFrame) -> DataFrame:
    """(id, classification, votes) rows to ``;``-joined lists in the order of the class names, votes summed."""
    summed = votes.groupBy("id", "classification").agg(F.sum("votes").alias("votes"))
    one = summed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("classification", "votes"))).alias("x"))
    return one.select("id", F.array_join("x.classification", ";").alias("classification"), F.array_join(F.transform("x.votes", lambda v: v.cast("string")), ";").alias("votes"))


def resolve_matches(pairs: DataFrame) -> DataFrame:
    """(source, ra, dec, rid, r_ra, r_dec): an object that several sources claim goes to the nearest in the (ra, dec) plane."""
    d = (F.col("ra") - F.col("r_ra")) ** 2 + (F.col("dec") - F.col("r_dec")) ** 2
    claims = F.count(F.lit(1)).over(Window.partitionBy("rid"))
    ranked = pairs.withColumns({"claims": claims, "r": F.row_number().over(Window.partitionBy("rid").orderBy(d, "source"))})
    return ranked.filter("r = 1").drop("r")


def features_with_labels(features: DataFrame, labels: DataFrame, key: str = "id", most_lost: float | None = None) -> DataFrame:
    """Inner join; with ``most_lost`` it's an error if a larger share of the labelled rows has no features."""
    if most_lost is not None:
        lost = labels.join(features.select(F.col(key).alias("__f")).distinct(), F.col(key) == F.col("__f"), "left").agg(F.avg(F.col("__f").isNull().cast("int")).alias("x")).first()["x"]
        if lost is not None and lost > most_lost:
            raise ValueError(f"{lost:.1%} of the labelled rows have no features; at most {most_lost:.1%} may lack them")
    return features.join(labels, key)


def upsert(old: DataFrame, new: DataFrame, key: str = "id", name: str = "obj_id") -> DataFrame:
    """Union by ``key``: the newest row, under the name that the key had first."""
    both = old.withColumn("__v", F.lit(0)).unionByName(new.withColumn("__v", F.lit(1)), allowMissingColumns=True)
    own = Window.partitionBy(key)
    named = both.withColumns({"__first": F.first(name).over(own.orderBy("__v")), "__r": F.row_number().over(own.orderBy(F.desc("__v")))})
    return named.filter("__r = 1").withColumn(name, F.col("__first")).drop("__first", "__r", "__v")


def merge_chunks(chunks: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Chunks over each other, missing columns NULL; the first row of each key stays (chunks in order, then ``order``)."""
    whole = chunks[0].withColumn("__c", F.lit(0))
    for i, chunk in enumerate(chunks[1:], 1):
        whole = whole.unionByName(chunk.withColumn("__c", F.lit(i)), allowMissingColumns=True)
    return whole.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy("__c", *order))).filter("__r = 1").drop("__c", "__r")


def keep_unique(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key stands once."""
    return rows.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(key))).filter("__n = 1").drop("__n")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicates"))


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work that isn't done: how interrupted runs are resumed."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def chunk_numbers(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds ``chunk`` numbers of ``size`` rows in order.  Rows are numbered by range partition, not in one task."""
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id())
    counts = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("n"), F.min("__i").alias("__lo"))
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("__p")) - F.col("n")).select("__p", "__lo", "before")
    # one row for each partition, so it's small
    numbered = parts.join(F.broadcast(before), "__p").withColumn("row", F.col("__i") - F.col("__lo") + F.col("before"))
    return numbered.withColumn("chunk", F.floor(F.col("row") / size)).drop("__p", "__i", "__lo", "before")


def completeness(sources: DataFrame, min_obs: int = 0) -> DataFrame:
    """(field, ccd, quad, n) with subtotals: NULL ccd and quad is a field's total, all NULL the grand total."""
    return sources.filter(F.col("nobs") >= min_obs).rollup("field", "ccd", "quad").agg(F.count(F.lit(1)).alias("n"))


def missing_quadrants(sources: DataFrame, expected: int = 64) -> DataFrame:
    """Fields that have fewer than the expected (ccd, quad) combinations."""
    return sources.groupBy("field").agg(F.count_distinct("ccd", "quad").alias("quads")).filter(F.col("quads") < expected)


def taxonomy_edges(tree: dict, parent: str | None = None) -> list[tuple[str | None, str]]:
    """Edges (parent, child) of a nested {class, subclasses} taxonomy, depth first."""
    own = [(parent, tree["class"])]
    for child in tree.get("subclasses", []):
        own += taxonomy_edges(child, tree["class"])
    return own


def above_threshold(scores: DataFrame, mapper: dict[str, str], threshold: float) -> DataFrame:
    """(id, class, probability) of the scores that reach the threshold, or exceed 0 where it is 0; classes mapped to None go."""
    names = [c for c, label in mapper.items() if label != "None"]
    long = scores.unpivot(["id"], names, "column", "probability")
    cut = F.col("probability") >= threshold if threshold > 0 else F.col("probability") > 0
    label = F.create_map(*[F.lit(x) for kv in mapper.items() for x in kv])[F.col("column")]
    return long.filter(cut).select("id", label.alias("class"), "probability")


def zero_below(scores: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    return scores.withColumns({c: F.when(F.col(c) < threshold, 0.0).otherwise(F.col(c)) for c in columns})


def label_columns(table: DataFrame) -> list[str]:
    """Double columns that look like labels: all within [0, 1], over half of them exactly 0 or 1."""
    names = [c for c, kind in table.dtypes if kind == "double"]
    if not names:
        return []
    parts: list[Column] = []
    for c in names:
        x = F.col(c)
        parts += [F.min(x).alias(f"{c}|lo"), F.max(x).alias(f"{c}|hi"), F.avg(x.isin(0.0, 1.0).cast("int")).alias(f"{c}|share")]
    r = table.agg(*parts).first()
    return [c for c in names if r[f"{c}|lo"] is not None and r[f"{c}|lo"] >= 0 and r[f"{c}|hi"] <= 1 and r[f"{c}|share"] > 0.5]
