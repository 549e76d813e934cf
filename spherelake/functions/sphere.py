"""Scalar expressions on the sphere.  Angles are degrees unless said otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Radian axes hold no finite value beyond this (fixed values: the general rule, and the diagnostic variant).
RADIAN_LIMIT = 2 * math.pi + 1e-6
RADIAN_LIMIT_PI = math.pi + 0.01
INF = float("inf")


def valid(v: Column) -> Column:
    """The one missing-value rule: a value counts if it is neither NULL, NaN nor infinite."""
    return v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v) < F.lit(INF))


def finite_or_null(v: Column) -> Column:
    return F.when(valid(v), v.cast("double"))


def canonical_lon(lon: Column) -> Column:
    """Longitudes in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def shift_lon(lon: Column, centre: Column) -> Column:
    """The longitude nearest to a centre, so that a polygon over the date line stays in one piece."""
    return F.pmod(lon - centre + 180.0, F.lit(360.0)) - 180.0 + centre


def in_radians(df: DataFrame, *columns: str, limit: float = RADIAN_LIMIT) -> bool:
    """Whether no finite value exceeds the limit.  One aggregate over the (small) axis table."""
    greatest = [F.max(F.when(valid(F.col(c)), F.abs(F.col(c)))) for c in columns]
    row = df.agg(*greatest).first()
    known = [v for v in row if v is not None]
    return bool(known) and max(known) <= limit


def to_degrees(df: DataFrame, columns: list[str], units: str = "auto") -> DataFrame:
    """Normalise angle columns to degrees; ``units`` is deg, rad or auto."""
    if units not in ("deg", "rad", "auto"):
        raise ValueError(f"unknown units {units!r}; use 'deg', 'rad' or 'auto'")
    if units == "rad" or (units == "auto" and in_radians(df, *columns)):
        return df.withColumns({c: F.degrees(F.col(c)) for c in columns})
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def xyz(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """Unit vector of a point."""
    a, b = F.radians(lon), F.radians(lat)
    return F.cos(b) * F.cos(a), F.cos(b) * F.sin(a), F.sin(b)


def lonlat(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a vector of any length; a zero vector is an error."""
    length = F.sqrt(x * x + y * y + z * z)
    safe = F.when(length > 0, length).otherwise(F.raise_error(F.lit("a zero vector has no direction")).cast("double"))
    sine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z / safe))
    return F.degrees(F.atan2(y, x)), F.degrees(F.asin(sine))


def centroid(lons: Column, lats: Column) -> tuple[Column, Column]:
    """Direction of the mean vector of the points in two arrays."""
    n = F.size(lons).cast("double")

    def mean(f) -> Column:
        return F.aggregate(F.zip_with(lons, lats, f), F.lit(0.0), lambda a, v: a + v) / n

    x = mean(lambda lo, la: F.cos(F.radians(la)) * F.cos(F.radians(lo)))
    y = mean(lambda lo, la: F.cos(F.radians(la)) * F.sin(F.radians(lo)))
    z = mean(lambda lo, la: F.sin(F.radians(la)))
    return lonlat(x, y, z)


def signed_area(lons: Column, lats: Column, clon: Column, clat: Column) -> Column:
    """Twice the signed area of a polygon in the tangent plane at a centre; positive if counter-clockwise."""
    n = F.size(lons)

    def east(i: Column) -> Column:
        return F.cos(F.radians(F.get(lats, i))) * F.sin(F.radians(F.get(lons, i) - clon))

    def north(i: Column) -> Column:
        la, d = F.radians(F.get(lats, i)), F.radians(F.get(lons, i) - clon)
        return F.cos(F.radians(clat)) * F.sin(la) - F.sin(F.radians(clat)) * F.cos(la) * F.cos(d)

    def term(i: Column) -> Column:
        j = (i + 1) % n
        return east(i) * north(j) - east(j) * north(i)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0.0), lambda a, v: a + v)


def counter_clockwise(values: Column, area: Column) -> Column:
    """An array of a polygon's vertices, reversed where the signed area is negative."""
    return F.when(area < 0, F.reverse(values)).otherwise(values)


#: deg(sqrt(4 pi / 12)), rounded as the level rule has it (fixed value).
LEVEL_0_DEGREES = 58.6


def resolution_to_level(resolution: float) -> int:
    """The level whose cells are about as large as a grid's (degrees)."""
    if not resolution > 0:
        raise ValueError(f"resolution must be positive, not {resolution}")
    return max(0, math.floor(math.log2(LEVEL_0_DEGREES / resolution)))


def level_of(resolution: Column) -> Column:
    """The same as an expression; the logarithm is guarded against inexact powers of two."""
    return F.greatest(F.lit(0), F.floor(F.log2(F.lit(LEVEL_0_DEGREES) / resolution))).cast("int")


def nside(level: int) -> int:
    return 1 << level


def npix(level: int) -> int:
    return 12 << (2 * level)
