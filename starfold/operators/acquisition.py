"""Getting light curves, features and sources out of large tables: pages, ranges, id lists, cones, time windows.

Light curves come as documents with their points in an array ``data`` of structs.  What a remote service would page through is one lazy
DataFrame here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.photometry import ZTF_FILTERS, hjd_to_mjd, to_geojson_ra
from starfold.operators import spatial
from starfold.operators.clean import distinct_exposures

#: Columns of the three projections of light curves; ``full`` has all.
PROJECTIONS = {"ids": ("_id", "ra", "dec"), "basic": ("_id", "filter", "field", "data"), "full": None}
# Photometric system and zero point of the survey's magnitudes.
SYSTEM, SURVEY_ZERO_POINT = "ab", 23.9


def find(table: DataFrame, condition: Column | None = None, columns: Sequence[str] | None = None, limit: int | None = None, skip: int = 0, order: Sequence[str] = ("_id",)) -> DataFrame:
    """Rows that meet ``condition``, projected; ``skip`` and ``limit`` cut a page out of the order."""
    found = table if condition is None else table.filter(condition)
    if limit is not None or skip:
        found = found.orderBy(*order)
        found = found.offset(skip) if skip else found
        found = found.limit(limit) if limit is not None else found
    return found if columns is None else found.select(*columns)


def quadrant_counts(sources: DataFrame, ccds: tuple[int, int] = (1, 16), quads: tuple[int, int] = (1, 4), min_obs: int = 20) -> DataFrame:
    """(ccd, quad, n) of the sources with ``min_obs`` observations or more in closed ranges of ccd and quadrant."""
    inside = F.col("ccd").between(*ccds) & F.col("quad").between(*quads) & (F.col("nobs") >= min_obs)
    return sources.filter(inside).groupBy("ccd", "quad").agg(F.count(F.lit(1)).alias("n"))


def curves_by_ids(curves: DataFrame, ids: DataFrame, programs: Sequence[int] = (1, 2, 3), max_hjd: float | None = None, projection: str = "full") -> DataFrame:
    """Light curves whose ``_id`` is in ``ids``, that have *any* point of the programs and, with ``max_hjd``, any point in (0, max_hjd].

    The conditions choose curves, not points: the array is returned whole.
    """
    found = curves.join(ids.select("_id").distinct(), "_id", "left_semi")
    found = found.filter(F.exists("data", lambda p: p["programid"].isin(*programs)))
    if max_hjd is not None:
        found = found.filter(F.exists("data", lambda p: (p["hjd"] > 0) & (p["hjd"] <= max_hjd)))
    columns = PROJECTIONS[projection]
    return found if columns is None else found.select(*columns)


def curves_by_position(curves: DataFrame, ra: float, dec: float, radius: float, **conditions) -> DataFrame:
    """Light curves within ``radius`` degrees of a place, by their ids (see :func:`curves_by_ids`)."""
    places = curves.select(F.col("_id").alias("id"), "ra", "dec")
    near = spatial.cone(places, ra, dec, radius).select(F.col("id").alias("_id"))
    return curves_by_ids(curves, near, **conditions)


def flattened(curves: DataFrame, drop_flagged: bool = True, parents: Sequence[str] = ("_id", "filter", "field")) -> DataFrame:
    """A row for each point of ``data`` with its curve's columns; flagged points go unless they are asked for.  Curves without points vanish."""
    points = curves.select(*parents, F.inline("data"))
    return points.filter(F.col("catflags") == 0) if drop_flagged else points


def photometry(curves: DataFrame, drop_flagged: bool = False) -> DataFrame:
    """Points with the name of their filter, photometric system, zero point and modified Julian date; magnitudes as floats."""
    points = flattened(curves, drop_flagged).withColumnRenamed("filter", "fid")
    name = F.create_map(*[F.lit(x) for kv in ZTF_FILTERS.items() for x in kv])[F.col("fid")]
    made = {"ztf_filter": name, "magsys": F.lit(SYSTEM), "zp": F.lit(SURVEY_ZERO_POINT), "mjd": hjd_to_mjd(F.col("hjd")).cast("double")}
    return points.withColumns(made | {c: F.col(c).cast("float") for c in ("mag", "magerr")})


def source_photometry(curves: DataFrame) -> DataFrame:
    """Photometry of a source: unflagged points without a missing value, each exposure once."""
    points = photometry(curves, drop_flagged=True)
    return distinct_exposures(points, "uexpid", *points.columns)


def mean_position(curves: DataFrame, by: str = "obj_id") -> DataFrame:
    """(by, ra, dec): mean position over a source's light curves; missing ones don't count."""
    return curves.groupBy(by).agg(F.avg("ra").alias("ra"), F.avg("dec").alias("dec"))


def feature_rows(features: DataFrame, ids: DataFrame, types: dict[str, str], done: DataFrame | None = None) -> DataFrame:
    """Features of the listed ``_id``, those in ``done`` left out, cast to the configured types; a value that its type can't hold is NULL."""
    found = features.join(ids.select("_id").distinct(), "_id", "left_semi")
    if done is not None:
        found = found.join(done.select("_id").distinct(), "_id", "left_anti")
    return found.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def classified_features(sources: DataFrame, curves: DataFrame, features: DataFrame, radius: float) -> DataFrame:
    """Sources (obj_id, ra, dec, ...) with the ``_id`` of every curve within the radius and its features; the source's position stays."""
    left = sources.select(F.col("obj_id").alias("id"), "ra", "dec")
    right = curves.select(F.col("_id").alias("rid"), "ra", "dec")
    pairs = spatial.within(left, right, radius, deal="right").select(F.col("id").alias("obj_id"), F.col("rid").alias("_id"))
    plain = features.drop("ra", "dec")
    return sources.join(pairs, "obj_id").join(plain, "_id")


def match_input(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """The input list with what was found for it, joined on the id that both have: ``obj_id``, else ``ztf_id``."""
    key = next((c for c in ("obj_id", "ztf_id") if c in wanted.columns and c in found.columns), None)
    if key is None:
        raise ValueError("neither obj_id nor ztf_id is in both tables")
    return wanted.join(found.select(key, *[c for c in found.columns if c not in wanted.columns]), key)


def window_sources(sources: DataFrame, curves: DataFrame, begin: str, days: int = 7, radius: float = 0.5 / 3600) -> DataFrame:
    """(obj_id, _id, ra, dec): curves within the radius of sources saved in [begin, begin + days], each ``_id`` once (least ``obj_id``)."""
    start = F.lit(begin).cast("timestamp_ntz")
    saved = F.col("saved_at").cast("timestamp_ntz")
    recent = sources.filter((saved >= start) & (saved <= start + F.expr(f"interval {days} days"))).select(F.col("obj_id").alias("id"), "ra", "dec")
    pairs = spatial.within(recent, curves.select(F.col("_id").alias("rid"), "ra", "dec"), radius)
    first = pairs.groupBy("rid").agg(F.min_by(F.struct("id", "r_ra", "r_dec"), "id").alias("x"))
    return first.select(F.col("x.id").alias("obj_id"), F.col("rid").alias("_id"), F.col("x.r_ra").alias("ra"), F.col("x.r_dec").alias("dec"))


def source_list(rows: DataFrame) -> DataFrame:
    """(ztf_id, lon, lat): GeoJSON coordinates from ra and dec, else from ``coordinates``, else from ``radec_geojson`` (structs with
    an array ``coordinates``)."""
    key = next((c for c in ("ztf_id", "_id") if c in rows.columns), None)
    if key is None:
        raise ValueError("neither ztf_id nor _id is in the table")
    if {"ra", "dec"} <= set(rows.columns):
        pair = F.array(to_geojson_ra(F.col("ra")), F.col("dec"))
    elif "coordinates" in rows.columns:
        pair = F.col("coordinates.radec_geojson.coordinates")
    elif "radec_geojson" in rows.columns:
        pair = F.col("radec_geojson.coordinates")
    else:
        raise ValueError("no coordinates in the table")
    return rows.select(F.col(key).alias("ztf_id"), F.get(pair, F.lit(0)).alias("lon"), F.get(pair, F.lit(1)).alias("lat"))
