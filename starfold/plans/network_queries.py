"""Images and features in one network, many models in one pass, and features in resumable chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators import curves, modelling, network, quantiles, scoring, stats
from starfold.operators.runner import in_chunks
from starfold.plans.catalogue import query
from starfold.plans.model_queries import FEATURES, TEXT_FEATURES, T, features, run_folder, text_features
from starfold.plans.roles import FORCED, SERIES, forced, measured, series, table
from starfold.sources import survey

CURVE_FEATURES = ["std", "cads_avg", "percent_beyond_1_std", "percent_close_to_median"]


@query("network_scores")
def network_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network of both branches on all curves: does a curve's amplitude lie above the median one?  A score for every curve."""
    points = measured(series(spark, sf_dir))
    x = stats.simple_features(points)
    middle = quantiles.of_columns(x, ["amplitude"], [0.5])["amplitude"][0] or 0.0
    table = x.select("id", *CURVE_FEATURES, (F.col("amplitude") > middle).cast("int").alias("y")).join(curves.dmdt_images(points), "id")
    known = modelling.feature_stats(table, CURVE_FEATURES).first().asDict()
    table = modelling.scaled(table, CURVE_FEATURES, known, "median_std")
    net = network.train(table, CURVE_FEATURES, steps=16, rate=0.01, hidden=(32, 16), channels=(8, 8, 16, 16))
    return network.score(table, net, "p").select("id", "p")


#: Weights over the features of each of three models.
MODELS = {"m_x": ({"x": 0.004}, -6.0), "m_yz": ({"y": 0.05, "z": -0.03}, 0.1), "m_all": ({"x": 0.002, "y": -0.02, "z": 0.01}, -3.0)}


def linear_sql(weights: dict[str, float], intercept: float) -> str:
    terms = " + ".join(f"{w}::double * {c}" for c, w in weights.items())
    return f"round_even(1 / (1 + exp(-({terms} + {intercept}::double))), 2)"


@query("score_models", f"with {T} select id, " + ", ".join(f"{linear_sql(*m)} as {c}" for c, m in MODELS.items()) + " from t")
def score_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models with features of their own, one pass."""
    models = {c: scoring.Linear(list(w), list(w.values()), b) for c, (w, b) in MODELS.items()}
    return scoring.score_many(features(spark, sf_dir).select("id", *FEATURES), models).select("id", *models)


@query("tree_measures")
def tree_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees with class weights, measured on rows held out by hash of the id."""
    d = text_features(spark, sf_dir).filter("y is not null")
    part = modelling.split_of(F.col("id"), test=0.3, validation=0.0)
    learn, held = d.filter(part != "test"), d.filter(part == "test")
    w = modelling.class_weights(learn).first()
    model, _, _ = modelling.train_trees(learn, TEXT_FEATURES, stages=(), class_weights=(w["weight0"] or 1.0, w["weight1"] or 1.0))
    return modelling.held_out_measures(held, TEXT_FEATURES, model)


@query("chunked_features", f"with {SERIES} select id, count(*) as n, round(avg(m), 6) as mean, round(max(t) - min(t), 6) as span from s group by id having count(*) >= 60")
def chunked_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of all curves by the chunked runner, eight chunks, each a commit of its own."""
    points = series(spark, sf_dir)

    def work(ids: DataFrame) -> DataFrame:
        own = points.join(ids, "id", "left_semi")
        found = own.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("m"), 6).alias("mean"), F.round(F.max("t") - F.min("t"), 6).alias("span"))
        return found.filter("n >= 60")

    return in_chunks(points.select("id").distinct(), work, f"{run_folder(spark)}/run", 8, at_once=4)


@query("bucketed_lookup", f"with {FORCED} select id, visit, line, flux from f where id in (select s_suppkey from supplier where s_suppkey % 9 = 0)")
def bucketed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forced photometry laid out by object, and an id list looked up in it."""
    folder = run_folder(spark)
    name = "forced_" + folder.rsplit("-", 1)[1]
    survey.save_bucketed(forced(spark, sf_dir).select("id", "visit", "line", "flux"), name, f"{folder}/forced", "id", 8)
    wanted = table(spark, sf_dir, "supplier").filter("s_suppkey % 9 = 0").select(F.col("s_suppkey").alias("id"))
    return survey.lookup(spark, name, wanted, "id")
