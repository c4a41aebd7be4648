"""From photometry to one feature row for each curve, as one lazy chain but for the baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators import agreement, clean, curves, periods, stats

ALGORITHMS = ("LS", "CE", "AOV")


def feature_table(points: DataFrame, algorithms: Sequence[str] = ALGORITHMS, cadence_days: float = 30 / 1440, least: int = 50, top: int = 3, samples_per_peak: int = 10, max_freq: float = 48.0, base: float | None = None) -> DataFrame:
    """Statistics, ranked periods, agreement, Fourier features and dm-dt images of (id, t, m, e).

    The frequency grid needs the longest baseline of all curves: the one scalar that comes to the driver, unless it is given.
    """
    # the baseline, the search, the fits, the images and the statistics read the thinned points: without keeping them, each would thin anew
    kept = clean.thin_many(points, cadence_days, ["m", "e"], least).persist(StorageLevel.MEMORY_AND_DISK)
    base = base or curves.baseline(kept).first()["baseline"] or 0.0
    grid = curves.frequency_grid(base, samples_per_peak, max_freq, remove=curves.TERRESTRIAL)
    # four parts read the ranked periods: without keeping them, each would search anew
    found = periods.search(kept, grid, list(algorithms), top).persist(StorageLevel.MEMORY_AND_DISK)
    columns = [(f"{what}_{r}_{a}", F.max(F.when((F.col("algorithm") == a) & (F.col("rank") == r), F.col(what)))) for a in algorithms for r in range(1, top + 1) for what in ("period", "significance")]
    wide = found.groupBy("id").agg(*[x.alias(c) for c, x in columns])
    best = found.filter((F.col("algorithm") == algorithms[0]) & (F.col("rank") == 1)).select("id", "period")
    parts = [wide, agreement.agreement(found, list(algorithms)), periods.fourier(kept, best), curves.dmdt_images(kept)]
    out = stats.basic_stats(kept)
    for part in parts:
        out = out.join(part, "id", "left")
    return out
