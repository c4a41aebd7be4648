"""Spatial joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.photometry import from_geojson_ra, to_geojson_ra
from starfold.functions.spherical import iau_name
from starfold.operators import spatial
from starfold.plans.catalogue import query
from starfold.plans.roles import place, positions, separation, table

C = f"c as (select {place('c_custkey')}, c_acctbal from customer)"
S = f"t as (select {place('s_suppkey')}, s_acctbal, s_nationkey from supplier)"
PAIRS = f"{C}, {S}, j as (select c.id, t.id as rid, c.ra, c.dec, t.ra as r_ra, t.dec as r_dec, t.s_acctbal, {separation('c.ra', 'c.dec', 't.ra', 't.dec')} as sep from c, t)"
RADIUS = 4.0


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(spark, sf_dir, "customer", "c_custkey").select("id", "ra", "dec", "c_acctbal")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(spark, sf_dir, "supplier", "s_suppkey").select(F.col("id").alias("rid"), "ra", "dec", "s_acctbal", "s_nationkey")


@query("cone_search", f"with {C} select id, round({separation('ra', 'dec', '120.0::double', '10.0::double')}, 6) as sep from c where {separation('ra', 'dec', '120.0::double', '10.0::double')} <= 15")
def cone_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.cone(customers(spark, sf_dir), 120.0, 10.0, 15.0).select("id", F.round("sep", 6).alias("sep"))


@query("spatial_pairs", f"with {PAIRS} select id, rid, round(sep, 6) as sep from j where sep <= {RADIUS}")
def spatial_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spatial.within(customers(spark, sf_dir).select("id", "ra", "dec"), suppliers(spark, sf_dir), RADIUS)
    return pairs.select("id", "rid", F.round("sep", 6).alias("sep"))


@query("nearest_match", f"with {PAIRS} select c.id, coalesce(b.rid, 0) as demo___id, b.acc as demo__s_acctbal from c left join (select id, arg_min(rid, sep) as rid, arg_min(s_acctbal, sep) as acc from j where sep <= {RADIUS} group by id) b using (id)")
def nearest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.nearest(customers(spark, sf_dir), suppliers(spark, sf_dir), RADIUS, ["s_acctbal"], "demo")
    return found.select("id", F.coalesce("demo___id", F.lit(0)).alias("demo___id"), "demo__s_acctbal")


# Suppliers as stars: magnitudes from 4 to 14, colours from 0 to 2; exclusion radii are scaled to degrees so that some reach a source.
STAR_G, STAR_COLOUR = "4 + (s_suppkey % 11)", "(s_suppkey % 21) / 10.0"
B = "(g - (-0.004288 + c * (-0.8547 + c * (0.1244 + c * (-0.9085 + c * (0.4843 + c * (-0.06814)))))))"
V = "(g - (-0.01077 + c * (-0.0682 + c * (-0.2387 + c * 0.02342))))"


@query(
    "bright_star_reject",
    f"""with {C}, t0 as (select {place('s_suppkey')}, ({STAR_G})::double as g, ({STAR_COLOUR})::double as c from supplier), t1 as (select *, {B} as b, {V} as v from t0 where g < 13),
t as (select *, case when b < 13 then (354.817 - 53.27823 * b + 66.01137 * (b - v) + 2.1031286 * b * b + 7.6737066 * (b - v) * (b - v) - 6.164676 * b * (b - v)) else 0 end * 100 / 3600 as reach from t1),
j as (select c.id, t.id as rid, t.ra as r_ra, t.dec as r_dec, reach, {separation('c.ra', 'c.dec', 't.ra', 't.dec')} as sep from c, t),
r as (select *, row_number() over (partition by id order by sep, rid) as n from j where sep <= 10.0),
w as (select id, bool_or(not (n = 1 and sep < 2.0) and reach > sep) as spoilt, max(case when n = 1 and sep < 2.0 then r_ra end) as ra, max(case when n = 1 and sep < 2.0 then r_dec end) as dec from r group by id)
select c.id, round(coalesce(w.ra, c.ra), 6) as ra, round(coalesce(w.dec, c.dec), 6) as dec from c left join w using (id) where not coalesce(spoilt, false)""",
)
def bright_star_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    stars = positions(spark, sf_dir, "supplier", "s_suppkey").select(F.col("id").alias("rid"), "ra", "dec", F.expr(STAR_G).cast("double").alias("g"), F.expr(STAR_COLOUR).cast("double").alias("colour"))
    kept = spatial.without_bright_stars(customers(spark, sf_dir), stars, query=10.0, same=2.0, scale=100.0)
    return kept.select("id", F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"))


@query(
    "alert_stats",
    f"""with {PAIRS} select c.id, coalesce(n, 0) as n_alerts, round(coalesce(s, 0), 6) as mean_score from c left join
(select id, count(distinct rid) as n, avg(v) as s from (select id, rid, unnest([s_acctbal, -s_acctbal / 2]) as v from j where sep <= {RADIUS}) group by id) using (id)""",
)
def alert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = suppliers(spark, sf_dir).withColumn("scores", F.create_map(F.lit("a"), F.col("s_acctbal"), F.lit("b"), -F.col("s_acctbal") / 2))
    return spatial.alert_stats(customers(spark, sf_dir), alerts, RADIUS).withColumn("mean_score", F.round("mean_score", 6))


@query(
    "neighbour_fraction",
    f"""with {C}, x as (select id, ra * cos(radians(dec)) as x, dec as y, case when id % 7 = 0 then null else 1 + id % 3 end as p from c)
select a.id, round(coalesce(b.hits * 1.0 / b.n, 0), 6) as fraction from x a left join (select a.id, count(*) as n, count_if(abs(a.p / b.p::double - 1) < 0.05) as hits
from x a join x b on a.id <> b.id and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 16 group by a.id) b using (id)""",
)
def neighbour_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = customers(spark, sf_dir).withColumn("period", F.when(F.col("id") % 7 != 0, (1 + F.col("id") % 3).cast("double")))
    return spatial.neighbour_fraction(x, 4.0).withColumn("fraction", F.round("fraction", 6))


@query("assign_field", f"with {C} select id, case when ra between 36 and 40 then 'RA38' when ra between 51 and 55 then 'RA53' when ra between 57 and 61 then 'RA59' when ra between 93 and 97 then 'RA95' end as field from c")
def assign_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select("id", spatial.field_of(F.col("ra")).alias("field"))


MEAN = "degrees(atan2(avg(sin(radians(ra))), avg(cos(radians(ra)))))"


@query(
    "circular_mean",
    f"""with {S}, m as (select s_nationkey, {MEAN} - 360 * floor({MEAN} / 360) as c_ra, avg(dec) as c_dec from t group by s_nationkey)
select s_nationkey, round(c_ra, 5) as c_ra, round(c_dec, 5) as c_dec, round(max({separation('ra', 'dec', 'c_ra', 'c_dec')}), 5) as radius from t join m using (s_nationkey) group by s_nationkey, c_ra, c_dec""",
)
def circular_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = suppliers(spark, sf_dir).withColumnRenamed("rid", "id")
    return spatial.covering_cone(x, ["s_nationkey"]).select("s_nationkey", *[F.round(c, 5).alias(c) for c in ("c_ra", "c_dec", "radius")])


@query("gaia_abs_mag", "select p_partkey as id, case when p_size - 20 > 0 then round(p_retailprice / 100 + 5 * log10((p_size - 20) * 0.001) + 5, 6) end as abs_mag, case when p_size - 19 > 0 then round(p_retailprice / 100 + 5 * log10((p_size - 19) * 0.001) + 5, 6) end as abs_mag_bound, round(p_retailprice / 90 - p_retailprice / 110, 6) as bp_rp from part")
def gaia_abs_mag(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") / 100).alias("g"), (F.col("p_size") - 20).alias("parallax"), F.lit(1).alias("parallax_error"), (F.col("p_retailprice") / 90).alias("bp"), (F.col("p_retailprice") / 110).alias("rp"))
    found = spatial.absolute_magnitudes(p)
    return found.select("id", *[F.round(c, 6).alias(c) for c in ("abs_mag", "abs_mag_bound", "bp_rp")])


@query(
    "iau_name",
    f"""with {C}, x as (select id, ra, abs(dec) as a, dec < 0 as south, floor(ra / 15) as h, floor(ra * 4) % 60 as m from c), y as (select *, ra * 240 - h * 3600 - m * 60 as s, floor(a) as d, floor(a * 60) % 60 as am from x)
select id, 'ZTFJ' || lpad(h::bigint::varchar, 2, '0') || lpad(m::bigint::varchar, 2, '0') || printf('%05.2f', s) || case when south then '-' else '+' end || lpad(d::bigint::varchar, 2, '0') || lpad(am::bigint::varchar, 2, '0') || printf('%04.1f', a * 3600 - d * 3600 - am * 60) as name from y""",
)
def iau_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select("id", iau_name(F.col("ra"), F.col("dec")).alias("name"))


@query("geojson", f"with {C} select id, round(ra - 180, 6) as lon, round(ra - 180 + 180, 6) as ra from c")
def geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select("id", F.round(to_geojson_ra(F.col("ra")), 6).alias("lon"), F.round(from_geojson_ra(to_geojson_ra(F.col("ra"))), 6).alias("ra"))
