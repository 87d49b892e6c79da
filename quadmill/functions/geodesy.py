"""Geodetic and geocentric coordinates on WGS84 (closed forms), local frames, DMS."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import ECCENTRICITY, RADIUS, col

E2 = ECCENTRICITY**2
SEMI_MINOR = RADIUS * math.sqrt(1 - E2)


def ecef(lng, lat, height) -> list[Column]:
    lam, phi = F.radians(col(lng)), F.radians(col(lat))
    n = RADIUS / F.sqrt(1 - E2 * F.sin(phi) * F.sin(phi))
    return [(n + col(height)) * F.cos(phi) * F.cos(lam), (n + col(height)) * F.cos(phi) * F.sin(lam), (n * (1 - E2) + col(height)) * F.sin(phi)]


def geodetic(x, y, z) -> list[Column]:
    """Longitude, latitude and height by Bowring's formula."""
    x, y, z = col(x), col(y), col(z)
    p = F.sqrt(x * x + y * y)
    t = F.atan2(z * RADIUS, p * SEMI_MINOR)
    ep2 = E2 / (1 - E2)
    phi = F.atan2(z + ep2 * SEMI_MINOR * F.pow(F.sin(t), F.lit(3)), p - E2 * RADIUS * F.pow(F.cos(t), F.lit(3)))
    n = RADIUS / F.sqrt(1 - E2 * F.sin(phi) * F.sin(phi))
    return [F.degrees(F.atan2(y, x)), F.degrees(phi), p * F.cos(phi) + z * F.sin(phi) - RADIUS * RADIUS / n]


def frame(lng, lat) -> dict[str, list[Column]]:
    """Unit vectors east, north and up at a place."""
    lam, phi = F.radians(col(lng)), F.radians(col(lat))
    return {
        "east": [-F.sin(lam), F.cos(lam), F.lit(0.0)],
        "north": [-F.sin(phi) * F.cos(lam), -F.sin(phi) * F.sin(lam), F.cos(phi)],
        "up": [F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)],
    }


def great_circle(lng0, lat0, lng1, lat1, radius: float = RADIUS) -> Column:
    a, b = F.radians(col(lat0)), F.radians(col(lat1))
    s = F.pow(F.sin((b - a) / 2), F.lit(2)) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(col(lng1) - col(lng0)) / 2), F.lit(2))
    return F.asin(F.sqrt(F.least(s, F.lit(1.0)))) * (2 * radius)


def azimuth(lng0, lat0, lng1, lat1) -> Column:
    """Initial bearing in degrees, clockwise from north."""
    a, b, d = F.radians(col(lat0)), F.radians(col(lat1)), F.radians(col(lng1) - col(lng0))
    deg = F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))
    return F.when(deg < 0, deg + 360.0).otherwise(deg)


def to_degrees(d, m, s) -> Column:
    sign = F.when(col(d) < 0, -1.0).otherwise(1.0)
    return sign * (F.abs(col(d)) + col(m) / 60.0 + col(s) / 3600.0)


def to_dms(value) -> list[Column]:
    """Sign, degrees, minutes and seconds (to a thousandth), carried over exactly."""
    thousandths = F.floor(F.abs(col(value)) * 3_600_000 + 0.5)
    return [
        F.when(col(value) < 0, -1).otherwise(1), F.floor(thousandths / 3_600_000).cast("int"),
        (F.floor(thousandths / 60_000) % 60).cast("int"), (thousandths % 60_000) / 1000.0,
    ]


def dms_text(value, positive: str, negative: str) -> Column:
    sign, d, m, s = to_dms(value)
    return F.concat(d.cast("string"), F.lit("° "), F.lpad(m.cast("string"), 2, "0"), F.lit("' "), F.format_string('%06.3f"', s), F.when(sign < 0, F.lit(f" {negative}")).otherwise(F.lit(f" {positive}")))


CUBE = 5000.0


def cube_frame(lng: float, lat: float, height: float, scale: float = 1.0) -> np.ndarray:
    """3x4 matrix from ECEF to the unit cube of CUBE metres around a place: east, north, up."""
    lam, phi = math.radians(lng), math.radians(lat)
    n = RADIUS / math.sqrt(1 - E2 * math.sin(phi) ** 2)
    centre = np.array([(n + height) * math.cos(phi) * math.cos(lam), (n + height) * math.cos(phi) * math.sin(lam), (n * (1 - E2) + height) * math.sin(phi)])
    axes = np.array([
        [-math.sin(lam), math.cos(lam), 0.0],
        [-math.sin(phi) * math.cos(lam), -math.sin(phi) * math.sin(lam), math.cos(phi)],
        [math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi)],
    ]) / (CUBE * scale)
    return np.column_stack([axes, 0.5 - axes @ centre])


def to_cube(matrix: np.ndarray, x, y, z) -> list[Column]:
    return [col(x) * float(r[0]) + col(y) * float(r[1]) + col(z) * float(r[2]) + float(r[3]) for r in matrix]


def voxel(u, level: int) -> Column:
    return F.floor(col(u) * float(1 << level)).cast("bigint")
