"""A survey laid out in buckets: what a lookup shuffles and what it finds."""

from __future__ import annotations

from pyspark.sql import functions as F

from starfold.sources import survey


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_lookup_shuffles_the_ids_alone(spark, tmp_path):
    rows = spark.range(20_000).select((F.col("id") % 700).alias("obj"), F.col("id").alias("visit"))
    survey.save_bucketed(rows, "bucketed_test", f"{tmp_path}/t", "obj", 6)
    ids = spark.createDataFrame([(5,), (5,), (None,), (699,), (10_000,)], "obj long")
    found = survey.lookup(spark, "bucketed_test", ids, "obj")
    assert sorted(r.visit for r in found.collect()) == sorted(i for i in range(20_000) if i % 700 in (5, 699))
    plain = rows.join(ids.na.drop().hint("merge"), "obj", "left_semi")
    assert exchanges(found) == 1 and exchanges(plain) == 2
    scan = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line]
    assert scan and "Bucketed: true" in scan[0]
    spark.sql("drop table bucketed_test")
