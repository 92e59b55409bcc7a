"""Map projections as Column expressions (Snyder, "Map Projections: A Working Manual", 1987)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TransverseMercator:
    """Ellipsoid, central meridian (degrees) and offsets of one zone."""

    a: float
    f: float
    meridian: float
    false_easting: float = 500000.0
    false_northing: float = 0.0
    scale: float = 0.9996

    @property
    def e2(self) -> float:
        return self.f * (2 - self.f)


# Zones of the configured cities by spatial reference code.  No datum shift is made.
WGS72 = (6378135.0, 1 / 298.26)
INDONESIAN_1974 = (6378160.0, 1 / 298.247)
ZONES = {
    32229: TransverseMercator(*WGS72, meridian=-9.0),
    32236: TransverseMercator(*WGS72, meridian=33.0),
    32237: TransverseMercator(*WGS72, meridian=39.0),
    23890: TransverseMercator(*INDONESIAN_1974, meridian=117.0, false_northing=10000000.0),
}

MOLLWEIDE_RADIUS = 6378137.0


def _meridian_arc(zone: TransverseMercator, phi: Column) -> Column:
    e2, e4, e6 = zone.e2, zone.e2**2, zone.e2**3
    return zone.a * (
        (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - (35 * e6 / 3072) * F.sin(6 * phi)
    )


def to_transverse_mercator(zone: TransverseMercator, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres (Snyder eqs 8-9, 8-10)."""
    phi = F.radians(lat)
    ep2 = zone.e2 / (1 - zone.e2)
    n = zone.a / F.sqrt(1 - zone.e2 * F.sin(phi) * F.sin(phi))
    t = F.tan(phi) * F.tan(phi)
    c = ep2 * F.cos(phi) * F.cos(phi)
    a = F.radians(lon - zone.meridian) * F.cos(phi)
    a2 = a * a
    x = zone.scale * n * a * (
        1 + a2 * ((1 - t + c) / 6 + a2 * (5 - 18 * t + t * t + 72 * c - 58 * ep2) / 120)
    )
    y = zone.scale * (
        _meridian_arc(zone, phi)
        + n * F.tan(phi) * a2
        * (0.5 + a2 * ((5 - t + 9 * c + 4 * c * c) / 24
                       + a2 * (61 - 58 * t + t * t + 600 * c - 330 * ep2) / 720))
    )
    return x + zone.false_easting, y + zone.false_northing


def with_geographic(df: DataFrame, zone: TransverseMercator, x: str, y: str, lon: str, lat: str) -> DataFrame:
    """Add degrees for metres (Snyder eqs 8-17 to 8-25).

    Built up over several column steps, so that shared terms are computed once per row.
    """
    e2 = zone.e2
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu, phi1, w = F.col("_mu"), F.col("_phi1"), F.col("_w")
    n1, r1, t1, c1, d = (F.col(c) for c in ("_n1", "_r1", "_t1", "_c1", "_d"))
    d2 = d * d
    steps = [
        {"_mu": ((F.col(y) - zone.false_northing) / zone.scale)
            / (zone.a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))},
        {"_phi1": mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu)
            + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu)
            + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)},
        {"_w": 1 - e2 * F.sin(phi1) * F.sin(phi1), "_t1": F.tan(phi1) * F.tan(phi1),
         "_c1": ep2 * F.cos(phi1) * F.cos(phi1)},
        {"_n1": zone.a / F.sqrt(w), "_r1": zone.a * (1 - e2) / (w * F.sqrt(w))},
        {"_d": (F.col(x) - zone.false_easting) / (n1 * zone.scale)},
        {lat: F.degrees(phi1 - (n1 * F.tan(phi1) / r1) * d2 * (0.5 - d2 * (
            (5 + 3 * t1 + 10 * c1 - 4 * c1 * c1 - 9 * ep2) / 24
            - d2 * (61 + 90 * t1 + 298 * c1 + 45 * t1 * t1 - 252 * ep2 - 3 * c1 * c1) / 720))),
         lon: zone.meridian + F.degrees(d * (1 - d2 * (
            (1 + 2 * t1 + c1) / 6
            - d2 * (5 - 2 * c1 + 28 * t1 - 3 * c1 * c1 + 8 * ep2 + 24 * t1 * t1) / 120)) / F.cos(phi1))},
    ]
    for step in steps:
        df = df.withColumns(step)
    return df.drop("_mu", "_phi1", "_w", "_n1", "_r1", "_t1", "_c1", "_d")


def project_by_zone(srid: Column, lon: Column, lat: Column, zones=None) -> tuple[Column, Column]:
    """Project with the zone named by the ``srid`` column; NULL for an unknown code."""
    zones = zones or ZONES
    x = y = F.lit(None).cast("double")
    for code, zone in zones.items():
        zx, zy = to_transverse_mercator(zone, lon, lat)
        x, y = F.when(srid == code, zx).otherwise(x), F.when(srid == code, zy).otherwise(y)
    return x, y


def from_mollweide(x: Column, y: Column) -> tuple[Column, Column]:
    """Metres to degrees, closed form."""
    theta = F.asin(y / (math.sqrt(2) * MOLLWEIDE_RADIUS))
    lat = F.degrees(F.asin((2 * theta + F.sin(2 * theta)) / math.pi))
    lon = F.degrees(math.pi * x / (2 * math.sqrt(2) * MOLLWEIDE_RADIUS * F.cos(theta)))
    return lon, lat


def to_mollweide(lon: Column, lat: Column, steps: int = 12) -> tuple[Column, Column]:
    """Degrees to metres; the auxiliary angle by a fixed number of Newton steps."""
    target = math.pi * F.sin(F.radians(lat))
    theta = F.aggregate(
        F.array_repeat(F.lit(0), steps),
        F.radians(lat),
        lambda t, _: t - F.coalesce(
            F.try_divide(2 * t + F.sin(2 * t) - target, 2 + 2 * F.cos(2 * t)), F.lit(0.0)
        ),
    )
    x = (2 * math.sqrt(2) / math.pi) * MOLLWEIDE_RADIUS * F.radians(lon) * F.cos(theta)
    y = math.sqrt(2) * MOLLWEIDE_RADIUS * F.sin(theta)
    return x, y
