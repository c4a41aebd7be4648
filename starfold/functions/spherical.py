"""Angles on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCSEC = 3600.0


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Angular separation in degrees (Vincenty's formula, stable at all distances); arguments in degrees."""
    a, b, d = F.radians(dec1), F.radians(dec2), F.radians(ra2 - ra1)
    x = F.cos(b) * F.sin(d)
    y = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)
    z = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(d)
    return F.degrees(F.atan2(F.sqrt(x * x + y * y), z))


def circular_mean(angle: Column) -> Column:
    """Mean direction of angles in degrees, in [0, 360)."""
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(F.radians(angle))), F.avg(F.cos(F.radians(angle))))), F.lit(360.0))


def iau_name(ra: Column, dec: Column, prefix: str = "ZTFJ") -> Column:
    """Sexagesimal designation; NULL outside 0 <= ra < 360, -90 <= dec <= 90.  The sign is taken before rounding down."""
    h, m = F.floor(ra / 15), F.floor(ra * 4) % 60
    s = ra * 240 - h * 3600 - m * 60
    a = F.abs(dec)
    d, arcm = F.floor(a), F.floor(a * 60) % 60
    arcs = a * 3600 - d * 3600 - arcm * 60
    sign = F.when(dec < 0, "-").otherwise("+")
    name = F.concat(F.lit(prefix), F.lpad(h.cast("string"), 2, "0"), F.lpad(m.cast("string"), 2, "0"), F.format_string("%05.2f", s), sign, F.lpad(d.cast("string"), 2, "0"), F.lpad(arcm.cast("string"), 2, "0"), F.format_string("%04.1f", arcs))
    return F.when((ra >= 0) & (ra < 360) & (a <= 90), name)

