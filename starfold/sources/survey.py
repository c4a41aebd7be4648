"""A survey of objects, visits and forced photometry as one column-pruned source of light curves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.photometry import PIXEL_FLAGS, flag_sum
from starfold.operators import clean, spatial

OBJECT = "objectId long, coord_ra double, coord_dec double, detect_isIsolated boolean"
VISIT = "visit long, expMidptMJD double"
FORCED = "objectId long, visit long, band string, psfFlux double, psfFluxErr double, " + ", ".join(f"{f} boolean" for f in PIXEL_FLAGS)
#: Visits are broadcast up to so many rows, and joined by a shuffle beyond.
BROADCAST_VISITS = 1_000_000


@dataclass
class Survey:
    """Tables ``object``, ``visit`` and ``forced``; every method gives a lazy DataFrame."""

    object: DataFrame
    visit: DataFrame
    forced: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> Survey:
        return cls(*(spark.read.schema(s).parquet(f"{root}/{n}.parquet") for n, s in (("object", OBJECT), ("visit", VISIT), ("forced_source", FORCED))))

    def cone(self, ra: float, dec: float, radius: float, limit: int | None = 10000) -> DataFrame:
        """Isolated objects within ``radius`` degrees, ``limit`` at most as a cone search of the survey gives by default; None for all."""
        isolated = self.object.filter("detect_isIsolated").select(F.col("objectId").alias("id"), F.col("coord_ra").alias("ra"), F.col("coord_dec").alias("dec"))
        return spatial.cone(isolated, ra, dec, radius, limit)

    def photometry(self, ids: DataFrame | None = None, bands: list[str] | None = None) -> DataFrame:
        """(id, band, t, flux, flux_err, flags) of unspoilt positive fluxes; ``ids`` (id) restricts the objects by a semi join."""
        visits = self.visit.select("visit", "expMidptMJD")
        small = visits.limit(BROADCAST_VISITS + 1).count() <= BROADCAST_VISITS
        points = self.forced
        if ids is not None:
            points = points.join(ids.select(F.col("id").alias("objectId")).distinct(), "objectId", "left_semi")
        points = points.join(F.broadcast(visits) if small else visits, "visit")
        points = points.select(F.col("objectId").alias("id"), "band", F.col("expMidptMJD").alias("t"), F.col("psfFlux").alias("flux"), F.col("psfFluxErr").alias("flux_err"), flag_sum(*[F.col(f) for f in PIXEL_FLAGS]).alias("catflags"))
        return clean.positive_flux(clean.in_bands(points, bands))


def save_bucketed(rows: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Writes a table hashed into ``buckets`` by ``key`` and sorted by it within each, so that later joins on the key neither shuffle nor sort it."""
    laid = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    laid.option("path", path).mode("overwrite").saveAsTable(table)


def lookup(spark: SparkSession, table: str, ids: DataFrame, key: str) -> DataFrame:
    """Rows of a bucketed table whose key is in ``ids`` (``key``): only the ids are shuffled, to the table's buckets.

    Repeated and null ids find nothing twice.  A list of one bucket's ids reads that bucket alone.
    """
    wanted = ids.select(key).na.drop()
    return spark.table(table).join(wanted.hint("merge"), key, "left_semi")
