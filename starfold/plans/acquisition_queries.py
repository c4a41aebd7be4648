"""Queries of the acquisition operators: pages, ranges, id lists, cones, nested light curves, photometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.casts import forgiving_true, matrix_of
from starfold.functions.photometry import days
from starfold.operators import acquisition, modelling
from starfold.plans.catalogue import query
from starfold.plans.roles import place, positions, separation, table

BANDS = {"click": 1, "view": 2, "purchase": 3}


def curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light curves as documents: one for each user and band, its points nested."""
    e = table(spark, sf_dir, "events")
    u, n = F.col("user_id"), F.col("event_id")
    band = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).otherwise(3)
    point = F.struct(
        (days(F.col("ts")) + 2400000.5).alias("hjd"), F.col("value").alias("mag"), (F.col("value") * 0.05).alias("magerr"), (n % 10 == 0).cast("int").alias("catflags"), (n % 4).cast("int").alias("programid"), F.floor(n / 2).alias("uexpid"), n.alias("n")
    )
    made = e.groupBy((u * 10 + band).alias("_id"), u.alias("user_id"), band.alias("filter")).agg(F.sort_array(F.collect_list(point)).alias("data"))
    return made.select("_id", "user_id", "filter", (u % 7).alias("field"), F.pmod(u * F.lit(137.508), F.lit(360.0)).alias("ra"), (-90 + 180 * F.pmod(u * F.lit(0.754877), F.lit(1.0))).alias("dec"), "data")


CURVES = f"""pt as (select user_id * 10 + case event_type when 'click' then 1 when 'view' then 2 else 3 end as _id, user_id, case event_type when 'click' then 1 when 'view' then 2 else 3 end as filter, user_id % 7 as field,
 epoch_us(ts) / 8.64e10 + 2400000.5 as hjd, value as mag, value * 0.05::double as magerr, (event_id % 10 = 0)::int as catflags, (event_id % 4)::int as programid, event_id // 2 as uexpid, event_id as n from events),
cv as (select _id, user_id, filter, field, (user_id * 137.508::double) % 360.0::double as ra, -90 + 180 * ((user_id * 0.754877::double) % 1.0::double) as dec, count(*) as points, bool_or(programid in (1, 2)) as ok, bool_or(hjd <= 2459960.0) as early from pt group by all)"""


@query("find_page", "select o_orderkey as _id, o_totalprice as price from orders where o_totalprice > 1000 order by 1 limit 500 offset 100")
def find_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("_id"), F.col("o_totalprice").alias("price"), "o_orderstatus")
    return acquisition.find(o, F.col("price") > 1000, ["_id", "price"], limit=500, skip=100)


@query("quad_counts", "select o_orderkey % 4 as ccd, (o_orderkey // 4) % 4 as quad, count(*) as n from orders where o_orderkey % 50 >= 20 and o_orderkey % 4 between 1 and 2 and (o_orderkey // 4) % 4 between 0 and 2 group by all")
def quad_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select((k % 4).alias("ccd"), (F.floor(k / 4) % 4).alias("quad"), (k % 50).alias("nobs"))
    return acquisition.quadrant_counts(o, (1, 2), (0, 2))


@query("curves_by_ids", f"with {CURVES} select _id, filter, field, points from cv where user_id in (select c_custkey from customer where c_custkey % 2 = 0) and ok and early")
def curves_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.explode(F.array(*[F.col("c_custkey") * 10 + k for k in (1, 2, 3)])).alias("_id"))
    found = acquisition.curves_by_ids(curves(spark, sf_dir), ids, (1, 2), 2459960.0, "basic")
    return found.select("_id", "filter", "field", F.size("data").cast("long").alias("points"))


@query("curves_by_position", f"with {CURVES} select _id, round(ra, 6) as ra, round(dec, 6) as dec from cv where {separation('ra', 'dec', '120.0::double', '10.0::double')} <= 40 and ok")
def curves_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = acquisition.curves_by_position(curves(spark, sf_dir), 120.0, 10.0, 40.0, programs=(1, 2), projection="ids")
    return found.select("_id", F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"))


@query("flatten_curves", f"with {CURVES} select _id, filter, field, n, mag from pt where catflags = 0")
def flatten_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.flattened(curves(spark, sf_dir)).select("_id", "filter", "field", "n", "mag")


@query("photometry_columns", f"with {CURVES} select n, filter as fid, 'ztf' || substr('gri', filter, 1) as ztf_filter, 'ab' as magsys, 23.9::double as zp, round(hjd - 2400000.5, 6) as mjd from pt")
def photometry_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.photometry(curves(spark, sf_dir)).select("n", "fid", "ztf_filter", "magsys", "zp", F.round("mjd", 6).alias("mjd"))


@query("photometry_dedup", f"with {CURVES} select uexpid from pt where catflags = 0 group by uexpid")
def photometry_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquisition.source_photometry(curves(spark, sf_dir)).select("uexpid")


@query("mean_position", f"with {CURVES} select user_id as obj_id, round(avg(ra), 6) as ra, round(avg(dec), 6) as dec from cv group by 1")
def mean_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = acquisition.mean_position(curves(spark, sf_dir).withColumnRenamed("user_id", "obj_id"))
    return found.select("obj_id", F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"))


@query("feature_download", "select p_partkey as _id, try_cast(substr(p_brand, 7) as int) as brand, p_size::double as size from part where p_partkey in (select l_partkey from lineitem where l_tax > 0.04) and p_partkey % 3 <> 0")
def feature_download(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_id"), F.expr("substr(p_brand, 7)").alias("brand"), F.col("p_size").alias("size"))
    ids = table(spark, sf_dir, "lineitem").filter("l_tax > 0.04").select(F.col("l_partkey").alias("_id"))
    return acquisition.feature_rows(p, ids, {"brand": "int", "size": "double"}, p.filter("_id % 3 = 0"))


RADIUS = 2.0
NEAR = f"t as (select {place('s_suppkey')}, s_name, s_acctbal from supplier), c as (select {place('c_custkey')} from customer), pr as (select t.id as obj_id, c.id as _id, c.ra, c.dec, s_name, s_acctbal from t join c on abs(t.dec - c.dec) <= {RADIUS} and {separation('t.ra', 't.dec', 'c.ra', 'c.dec')} <= {RADIUS})"


@query("classified_features", f"with {NEAR} select obj_id, _id, c_acctbal as feature from pr join customer on _id = c_custkey")
def classified_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = positions(spark, sf_dir, "supplier", "s_suppkey").select(F.col("id").alias("obj_id"), "ra", "dec")
    c = positions(spark, sf_dir, "customer", "c_custkey").withColumnRenamed("id", "_id")
    features = c.select("_id", "ra", "dec", F.col("c_acctbal").alias("feature"))
    return acquisition.classified_features(s, c, features, RADIUS).select("obj_id", "_id", "feature")


@query("match_input", "select s_suppkey as ztf_id, s_name as name, c_name as found from supplier join customer on s_suppkey = c_custkey")
def match_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ztf_id"), F.col("s_name").alias("name"))
    return acquisition.match_input(wanted, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ztf_id"), F.col("c_name").alias("found")))


@query("window_sources", f"with o as (select o_custkey, max(o_orderdate) as saved from orders group by 1), t as (select {place('o_custkey')} from o where saved between timestamp '2000-08-01' and timestamp '2001-07-15'), c as (select {place('s_suppkey')} from supplier), pr as (select t.id as obj_id, c.id as _id from t join c on abs(t.dec - c.dec) <= {RADIUS} and {separation('t.ra', 't.dec', 'c.ra', 'c.dec')} <= {RADIUS}) select min(obj_id) as obj_id, _id from pr group by _id")
def window_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("saved_at"))
    k = F.col("o_custkey")
    sources = saved.select(k.alias("obj_id"), F.pmod(k * F.lit(137.508), F.lit(360.0)).alias("ra"), (-90 + 180 * F.pmod(k * F.lit(0.754877), F.lit(1.0))).alias("dec"), "saved_at")
    found = positions(spark, sf_dir, "supplier", "s_suppkey").withColumnRenamed("id", "_id")
    return acquisition.window_sources(sources, found, "2000-08-01", 348, RADIUS).select("obj_id", "_id")


@query("source_list", f"with c as (select {place('c_custkey')} from customer) select id as ztf_id, round(ra - 180, 6) as lon, round(dec, 6) as lat from c")
def source_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(spark, sf_dir, "customer", "c_custkey").select(F.col("id").alias("_id"), "ra", "dec")
    return acquisition.source_list(rows).select("ztf_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("forgiving_true", "select c_custkey as id, c_custkey % 4 in (0, 1) as flag from customer")
def forgiving(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = F.when(k % 4 == 0, F.lit("True")).when(k % 4 == 1, F.lit("1")).when(k % 4 == 2, F.lit("no"))
    return table(spark, sf_dir, "customer").select(k.alias("id"), forgiving_true(text).alias("flag"))


@query("matrix_text", "select c_custkey as id, c_acctbal as corner, 2::bigint as n_rows from customer")
def matrix_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_string("[[%s, 1], [2.5, 3]]", F.col("c_acctbal").cast("string"))
    m = matrix_of(text)
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), m[0][0].alias("corner"), F.size(m).cast("long").alias("n_rows"))


@query("class_gate", "select 'toxic' as class, count_if(toxic > 0.5)::bigint as n_positive from labels having count_if(toxic > 0.5) > 20 union all select 'quality', count_if(quality > 0.5)::bigint from labels having count_if(quality > 0.5) > 20")
def class_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling.class_gate(table(spark, sf_dir, "labels"), {"toxic": 0.5, "quality": 0.5}, 20)


@query("latest_model", "select o_orderpriority as tag, max(o_orderdate) as created, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as path from orders group by 1")
def latest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("tag"), F.col("o_orderdate").alias("created"), F.col("o_orderkey").alias("path"))
    return modelling.latest(o, "tag", "created", ["path"])
