"""Column expressions for positions: validity, distances, projection, offsets on the ellipsoid."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid (projection and offsets) and GRS80 flattening for EPSG:3035.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
GRS80_F = 1 / 298.257222101
# EPSG:3035 (Lambert azimuthal equal area, Europe).
LAEA_LAT0, LAEA_LON0 = math.radians(52.0), math.radians(10.0)
LAEA_X0, LAEA_Y0 = 4321000.0, 3210000.0

# Area per kW of a roof panel, and where unlocated wind units are put.
PANEL_M2_PER_KW = 5.5
FALLBACK_LON, FALLBACK_LAT = 8.0, 54.0


def valid_position(lon: Column, lat: Column) -> Column:
    """Never NULL, so that it and its negation split a table in two."""
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def _authalic(sin_lat, e: float):
    return (1 - e * e) * (
        sin_lat / (1 - e * e * sin_lat * sin_lat)
        - F.log((1 - e * sin_lat) / (1 + e * sin_lat)) / (2 * e)
    )


def to_laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:4326 degrees to EPSG:3035 metres (published ellipsoidal formulas)."""
    e2 = GRS80_F * (2 - GRS80_F)
    e = math.sqrt(e2)

    def q(sin_lat: float) -> float:
        return (1 - e2) * (
            sin_lat / (1 - e2 * sin_lat**2) - math.log((1 - e * sin_lat) / (1 + e * sin_lat)) / (2 * e)
        )

    q_pole, sin0 = q(1.0), math.sin(LAEA_LAT0)
    beta0 = math.asin(q(sin0) / q_pole)
    r_q = WGS84_A * math.sqrt(q_pole / 2)
    d = WGS84_A * (math.cos(LAEA_LAT0) / math.sqrt(1 - e2 * sin0**2)) / (r_q * math.cos(beta0))
    beta = F.asin(_authalic(F.sin(F.radians(lat)), e) / q_pole)
    turn = F.radians(lon) - LAEA_LON0
    b = r_q * F.sqrt(
        2 / (1 + math.sin(beta0) * F.sin(beta) + math.cos(beta0) * F.cos(beta) * F.cos(turn))
    )
    x = LAEA_X0 + b * d * F.cos(beta) * F.sin(turn)
    y = LAEA_Y0 + b / d * (math.cos(beta0) * F.sin(beta) - math.sin(beta0) * F.cos(beta) * F.cos(turn))
    return x, y


def destination(lon: Column, lat: Column, bearing: Column, metres: Column) -> tuple[Column, Column]:
    """End of a short line from a position; local radii of the ellipsoid keep it exact to
    well under a millimetre for panel and rotor sizes."""
    e2 = WGS84_F * (2 - WGS84_F)
    w2 = 1 - e2 * F.pow(F.sin(F.radians(lat)), F.lit(2.0))
    meridian = WGS84_A * (1 - e2) / F.pow(w2, F.lit(1.5))
    prime_vertical = WGS84_A / F.sqrt(w2)
    new_lat = lat + F.degrees(metres * F.cos(F.radians(bearing)) / meridian)
    new_lon = lon + F.degrees(
        metres * F.sin(F.radians(bearing)) / (prime_vertical * F.cos(F.radians(lat)))
    )
    return new_lon, new_lat


def ring_around(lon: Column, lat: Column, bearings: Column, metres: Column) -> Column:
    """Array of (lat, lon) corners, one per bearing."""

    def corner(bearing: Column) -> Column:
        x, y = destination(lon, lat, bearing.cast("double"), metres)
        return F.struct(y.alias("lat"), x.alias("lon"))

    return F.transform(bearings, corner)


def half_diagonal(power_kw: Column) -> Column:
    """Centre to corner of the square a panel of that power covers, in metres."""
    return F.sqrt(power_kw * PANEL_M2_PER_KW) * math.sqrt(2) / 2


def panel_box(lon: Column, lat: Column, power_kw: Column) -> Column:
    return ring_around(lon, lat, F.sequence(F.lit(45), F.lit(315), F.lit(90)), half_diagonal(power_kw))


def octagon(lon: Column, lat: Column, metres: Column) -> Column:
    return ring_around(lon, lat, F.sequence(F.lit(0), F.lit(315), F.lit(45)), metres)
