"""Scans, cleaning, curves and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.photometry import band_number, flag_sum, magnitude, magnitude_error, phase
from starfold.operators import clean, curves, stats
from starfold.plans.catalogue import query
from starfold.plans.roles import FORCED, SERIES, forced, measured, series, table, visits

BANDS = {"A": 0, "N": 1}


@query("scan_project", "select l_suppkey as id, count(*) as n, round(sum(l_extendedprice), 2) as flux from lineitem where l_shipdate >= timestamp '1995-01-01' group by 1")
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00")))
    return x.groupBy(F.col("l_suppkey").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("flux"))


@query("flags_filter", f"with {FORCED} select id, visit, line, bad::int + cr::int as flags from f where bad::int + cr::int > 0 and flux > 0 and flux_err > 0")
def flags_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = clean.with_flags(forced(spark, sf_dir), ["pixelFlags_bad", "pixelFlags_cr"], "flags")
    return clean.positive_flux(x).filter("flags > 0").select("id", "visit", "line", "flags")


@query("visit_join", f"with {FORCED} select id, count(*) as n, round(min(t), 6) as first_t, round(max(t), 6) as last_t from f join v using (visit) group by id")
def visit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = forced(spark, sf_dir).join(visits(spark, sf_dir), "visit")
    return x.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("t"), 6).alias("first_t"), F.round(F.max("t"), 6).alias("last_t"))


@query("id_semi_join", "select l_orderkey as visit, l_suppkey as id from lineitem where l_suppkey in (select s_suppkey from supplier where s_acctbal > 0)")
def id_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"))
    return forced(spark, sf_dir).select("visit", "id").join(ids, "id", "left_semi").select("visit", "id")


@query("band_filter", f"with {FORCED} select band, count(*) as n from f where band in ('A', 'R') group by band")
def band_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.in_bands(forced(spark, sf_dir), ["A", "R"]).groupBy("band").agg(F.count(F.lit(1)).alias("n"))


@query("flux_to_mag", f"with {FORCED} select visit, line, round(-2.5 * log10(flux) + 31.4, 6) as m, round(2.5 / ln(10) * (flux_err / flux), 6) as e, case band when 'A' then 0 when 'N' then 1 else -1 end as filter from f where flux > 0")
def flux_to_mag(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = forced(spark, sf_dir).filter("flux > 0")
    return x.select("visit", "line", F.round(magnitude(F.col("flux")), 6).alias("m"), F.round(magnitude_error(F.col("flux"), F.col("flux_err")), 6).alias("e"), band_number(F.col("band"), BANDS).alias("filter"))


@query("nest_lightcurves", f"with {SERIES} select id, band, count(*) as n, round(min(t), 6) as t_first, round(arg_min(m, t), 6) as m_first, round(arg_max(m, t), 6) as m_last from s group by id, band")
def nest_lightcurves(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = curves.nest(series(spark, sf_dir))
    return d.select("id", "band", F.size("data").cast("long").alias("n"), F.round(F.col("data")[0]["t"], 6).alias("t_first"), F.round(F.col("data")[0]["m"], 6).alias("m_first"), F.round(F.element_at("data", -1)["m"], 6).alias("m_last"))


@query("combine_bands", f"with {SERIES} select id, string_agg(distinct band, ',' order by band) as bands, count(*) as n, round(min(t), 6) as t_min, round(max(t), 6) as t_max, 'demo' as survey from s group by id")
def combine_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = curves.combine_bands(series(spark, sf_dir), "demo")
    return x.withColumns({"t_min": F.round("t_min", 6), "t_max": F.round("t_max", 6)})


THIN = f"""with recursive {SERIES}, o as (select id, t, event_id, row_number() over (partition by id order by t, event_id) as i from s),
r as (select id, i, t, t as last, true as keep, event_id from o where i = 1
 union all select o.id, o.i, o.t, case when o.t - r.last >= 0.5 then o.t else r.last end, o.t - r.last >= 0.5, o.event_id from r join o on o.id = r.id and o.i = r.i + 1)"""


@query("cadence_thin", f"{THIN} select id, event_id from r where keep")
def cadence_thin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.thin(series(spark, sf_dir).select("id", "t", "event_id"), 0.5, tie=["event_id"]).select("id", "event_id")


@query("cadence_thin_arrays", f"{THIN} select id, count(*) as n, round(sum(t), 4) as total from r where keep group by id")
def cadence_thin_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = curves.nest(series(spark, sf_dir), ["id"], ["t", "event_id"]).select("id", clean.thinned(F.col("data"), 0.5).alias("d"))
    return d.select("id", F.size("d").cast("long").alias("n"), F.round(F.aggregate("d", F.lit(0.0), lambda a, p: a + p["t"]), 4).alias("total"))


@query("min_points", f"with {SERIES} select id, count(*) as n from s where catflags = 0 group by id having count(*) >= 50")
def min_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.with_minimum(clean.unflagged(series(spark, sf_dir)), 50).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("time_cutoff", f"with {SERIES} select id, count(*) as n from s where t > 0 and t <= (select min(t) + 10 from s) group by id")
def time_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = series(spark, sf_dir)
    limit = x.agg(F.min("t") + 10).first()[0]
    return clean.up_to(x, limit).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("baseline", f"with {SERIES} select band, round(max(span), 6) as baseline from (select band, id, max(t) - min(t) as span from s group by band, id) group by band")
def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.baseline(series(spark, sf_dir), ["band"]).withColumn("baseline", F.round("baseline", 6))


@query("phase_fold", f"with {SERIES} select event_id, round(((t - 19000) / 3.7) - floor((t - 19000) / 3.7), 6) as phase from s")
def phase_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir).select("event_id", F.round(phase(F.col("t"), F.lit(3.7), 19000.0), 6).alias("phase"))


BASE = f"""with {SERIES}, g as (select id, count(*) as n, median(m) as med, sum(m / (e * e)) / sum(1 / (e * e)) as wm from s group by id),
x as (select s.*, n, med, wm, m - wm as dev, sqrt(n / (n - 1.0)) * (m - wm) / e as d from s join g using (id)),
y as (select *, d * lead(d) over o as pr, lead(t) over o - t as dt, lead(m) over o - m as dm from x window o as (partition by id order by t, event_id))"""


@query("stats_basic", f"{BASE} select id, max(n) as n, round(max(med), 6) as median, round(max(wm), 6) as wmean, round(sum(dev * dev / (e * e)) / (max(n) - 1), 5) as chi2red, round(sum(abs(m - med) / e) / (max(n) - 1), 5) as roms, round(sqrt(sum(dev * dev / (e * e)) / sum(1 / (e * e))), 6) as wstd, round((max(m - e) - min(m + e)) / (max(m - e) + min(m + e)), 6) as norm_peak_to_peak_amp, round(sum(dev * dev - e * e) / (max(n) * max(wm) * max(wm)), 6) as norm_excess_var, round(median(abs(m - med)), 6) as median_abs_dev from y where n >= 4 group by id")
def stats_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["median", "wmean", "chi2red", "roms", "wstd", "norm_peak_to_peak_amp", "norm_excess_var", "median_abs_dev"]
    x = stats.basic_stats(series(spark, sf_dir), tie=["event_id"]).filter("n is not null")
    return x.select("id", "n", *[F.round(c, 5 if c in ("chi2red", "roms") else 6).alias(c) for c in names])


@query("stats_quantiles", f"{BASE} select id, round(quantile_cont(m, 0.75) - quantile_cont(m, 0.25), 6) as iqr, round(quantile_cont(m, 0.8) - quantile_cont(m, 0.2), 6) as i60r, round(quantile_cont(m, 0.85) - quantile_cont(m, 0.15), 6) as i70r, round(quantile_cont(m, 0.9) - quantile_cont(m, 0.1), 6) as i80r, round(quantile_cont(m, 0.95) - quantile_cont(m, 0.05), 6) as i90r from y where n >= 4 group by id")
def stats_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = stats.basic_stats(series(spark, sf_dir), tie=["event_id"]).filter("n is not null")
    return x.select("id", *[F.round(c, 6).alias(c) for c in ("iqr", "i60r", "i70r", "i80r", "i90r")])


@query("stats_moments", f"{BASE} select id, round(max(n) / ((max(n) - 1.0) * (max(n) - 2)) * sum(power(dev / e, 3)), 3) as skew, round(max(n) * (max(n) + 1.0) / ((max(n) - 1.0) * (max(n) - 2) * (max(n) - 3)) * sum(power(dev / e, 4)) - 3 * power(max(n) - 1.0, 2) / ((max(n) - 2.0) * (max(n) - 3)), 2) as smallkurt from y where n >= 4 group by id")
def stats_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = stats.basic_stats(series(spark, sf_dir), tie=["event_id"]).filter("n is not null")
    return x.select("id", F.round("skew", 3).alias("skew"), F.round("smallkurt", 2).alias("smallkurt"))


@query("stats_sequential", f"{BASE} select id, round(sum(case when dt > 0 then 1 / (dt * dt) end) * sum(dev * dev / (e * e)) / sum(1 / (e * e)) / sum(case when dt > 0 then dm * dm / (dt * dt) end), 5) as inv_vonneumannratio, round(sum(pr), 3) as welch_i, round(sum(sign(pr) * sqrt(abs(pr))), 4) as stetson_j, round(sum(abs(d)) / max(n) / sqrt(sum(d * d) / max(n)), 6) as stetson_k from y where n >= 4 group by id")
def stats_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = stats.basic_stats(series(spark, sf_dir), tie=["event_id"]).filter("n is not null")
    digits = {"inv_vonneumannratio": 5, "welch_i": 3, "stetson_j": 4, "stetson_k": 6}
    return x.select("id", *[F.round(c, n).alias(c) for c, n in digits.items()])


@query("stats_normality")
def stats_normality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.normality(measured(series(spark, sf_dir)))


SIMPLE = f"""{SERIES}, a as (select *, lead(t) over o - t as dt, lead(m) over o - m as dm, median(m) over i as med, avg(m) over i as mu, stddev_pop(m) over i as sd, max(m) over i - min(m) over i as span, power(10, -0.4 * m) as f from s window i as (partition by id), o as (partition by id order by t, m, e)),
g as (select id, count(*) as n_epochs, max(t) - min(t) as total_time, avg(dt) as cads_avg, median(dt) as cads_med, stddev_pop(dt) as cads_std, avg(t) as avgt, avg(m) as mean, avg(e) as avg_err, median(e::double) as med_err, stddev_pop(e) as std_err, stddev_pop(m) as std,
 sum(m / (e * e)) / sum(1 / (e * e)) as weighted_average, min(m) as minimum, max(m) as maximum, max(med) as median, avg(power(m - mu, 3)) / power(max(sd), 3) as skew, median(abs(m - med)) as median_absolute_deviation, avg((abs(m - mu) > sd)::int) as percent_beyond_1_std,
 avg((abs(m - med) < 0.2 * span / 2)::int) as percent_close_to_median, max(case when dt > 0 then abs(dm / dt) end) as max_slope, quantile_cont(f, [0.05, 0.175, 0.25, 0.325, 0.4, 0.6, 0.675, 0.75, 0.825, 0.95, 0.1, 0.9]) as q, power(10, -0.4 * max(med)) as fm, min(f) as f_lo, max(f) as f_hi from a group by id)"""
FOUND = ["total_time", "cads_avg", "cads_med", "cads_std", "avgt", "mean", "avg_err", "med_err", "std_err", "std", "weighted_average", "minimum", "maximum", "median", "skew", "median_absolute_deviation", "percent_beyond_1_std", "percent_close_to_median", "max_slope"]
RATIOS = {"flux_percentile_ratio_mid20": "(q[6] - q[5]) / (q[10] - q[1])", "flux_percentile_ratio_mid35": "(q[7] - q[4]) / (q[10] - q[1])", "flux_percentile_ratio_mid50": "(q[8] - q[3]) / (q[10] - q[1])", "flux_percentile_ratio_mid65": "(q[9] - q[2]) / (q[10] - q[1])", "flux_percentile_ratio_mid80": "(q[12] - q[11]) / (q[10] - q[1])", "percent_difference_flux_percentile": "(q[10] - q[1]) / fm", "percent_amplitude": "greatest(abs(f_hi - fm), abs(f_lo - fm)) / fm", "amplitude": "(maximum - minimum) / 2"}


@query("simple_features", f"with {SIMPLE} select id, n_epochs, " + ", ".join([*(f"round({c}, 4) as {c}" for c in FOUND), *(f"round({x}, 4) as {c}" for c, x in RATIOS.items())]) + " from g")
def simple_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = stats.simple_features(series(spark, sf_dir))
    return x.select("id", "n_epochs", *[F.round(c, 4).alias(c) for c in [*FOUND, *RATIOS]])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = forced(spark, sf_dir).join(visits(spark, sf_dir), "visit")
    x = x.filter(flag_sum(F.col("pixelFlags_bad"), F.col("pixelFlags_cr")) == 0)
    x = clean.with_magnitudes(clean.positive_flux(x)).select("id", "t", "m", "e", "visit", "line")
    return stats.basic_stats(clean.with_minimum(clean.thin(x, 0.5, tie=["visit", "line", "m"]), 4))


FLAGSHIP = f"""with recursive {FORCED}, s as (select id, t, -2.5 * log10(flux) + 31.4 as m, 2.5 / ln(10) * (flux_err / flux) as e, visit, line from f join v using (visit) where not bad and not cr and flux > 0 and flux_err > 0),
o as (select *, row_number() over (partition by id order by t, visit, line, m) as i from s),
r as (select *, t as last, true as keep from o where i = 1
 union all select o.*, case when o.t - r.last >= 0.5 then o.t else r.last end, o.t - r.last >= 0.5 from r join o on o.id = r.id and o.i = r.i + 1),
g as (select id, count(*) as n, median(m) as med, sum(m / (e * e)) / sum(1 / (e * e)) as wm from r where keep group by id)
select id, max(n) as n, round(max(med), 5) as median, round(max(wm), 5) as wmean, round(sum((m - wm) * (m - wm) / (e * e)) / (max(n) - 1), 2) as chi2red from r join g using (id) where keep and n >= 4 group by id"""


@query("flagship", FLAGSHIP)
def flagship_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir).select("id", "n", F.round("median", 5).alias("median"), F.round("wmean", 5).alias("wmean"), F.round("chi2red", 2).alias("chi2red"))


DM, DT = curves.DM_EDGES, curves.DT_EDGES


def bin_sql(x: str, edges: list[float]) -> str:
    steps = " + ".join(f"({x} >= {e}::double)::int" for e in edges[1:-1])
    return f"case when {x} between {edges[0]} and {edges[-1]} then {steps} end"


DMDT = f"""with {SERIES}, a as (select id, t, m, row_number() over (partition by id order by t, m) as i from s),
b as (select p.id, {bin_sql('(q.m - p.m)', DM)} as dm_bin, {bin_sql('(q.t - p.t)', DT)} as dt_bin from a p join a q on p.id = q.id and p.i < q.i),
c as (select id, dm_bin, dt_bin, count(*) as n from b where dm_bin is not null and dt_bin is not null group by all)"""


@query("dmdt", f"{DMDT} select id, dm_bin, dt_bin, n from c")
def dmdt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.dmdt_counts(series(spark, sf_dir))


@query("dmdt_norm", f"{DMDT} select id, round(sqrt(sum(power(n / norm, 2))), 5) as norm, count(*) as cells from c join (select id, sqrt(sum(n * n)) as norm from c group by id) using (id) group by id")
def dmdt_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = curves.dmdt_images(series(spark, sf_dir)).select("id", F.flatten("dmdt").alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    return flat.filter(norm > 0).select("id", F.round(norm, 5).alias("norm"), F.size(F.filter("x", lambda v: v > 0)).cast("long").alias("cells"))
