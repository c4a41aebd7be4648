"""Column expressions for fluxes, magnitudes, bands, times and positions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# AB zero point for fluxes in nanojansky, band numbers, Julian date offset.
ZERO_POINT = 31.4
BANDS = {"u": 0, "g": 1, "r": 2, "i": 3, "z": 4, "y": 5}
ZTF_FILTERS = {1: "ztfg", 2: "ztfr", 3: "ztfi"}
MJD_OFFSET = 2400000.5
# Flag columns of forced photometry.
PIXEL_FLAGS = ("pixelFlags_bad", "pixelFlags_cr", "pixelFlags_edge", "pixelFlags_saturated", "pixelFlags_suspect")


def null_nan(x: Column) -> Column:
    """NaN as NULL: operators work on NULL only."""
    return F.when(~F.isnan(x), x)


def magnitude(flux: Column) -> Column:
    """AB magnitude of a positive flux; NULL otherwise."""
    return F.when(flux > 0, -2.5 * F.log10(flux) + ZERO_POINT)


def magnitude_error(flux: Column, error: Column) -> Column:
    return F.when(flux > 0, (2.5 / math.log(10)) * (error / flux))


def band_number(band: Column, numbers: dict[str, int] = BANDS) -> Column:
    """Number of a band, -1 if unknown."""
    return F.coalesce(reduce(lambda out, kv: out.when(band == kv[0], kv[1]), list(numbers.items())[1:], F.when(band == next(iter(numbers)), next(iter(numbers.values())))), F.lit(-1))


def flag_sum(*flags: Column) -> Column:
    """Number of set flags; a NULL flag isn't set."""
    return reduce(lambda a, b: a + b, [F.coalesce(f.cast("int"), F.lit(0)) for f in flags])


def days(ts: Column) -> Column:
    """A timestamp as days since the epoch."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(8.64e10)


def hjd_to_mjd(hjd: Column) -> Column:
    return hjd - MJD_OFFSET


def to_geojson_ra(ra: Column) -> Column:
    return ra - 180.0


def from_geojson_ra(lon: Column) -> Column:
    return lon + 180.0


def phase(t: Column, period: Column, t0: Column | float = 0.0) -> Column:
    """Phase in [0, 1)."""
    return F.pmod((t - t0) / period, F.lit(1.0))
