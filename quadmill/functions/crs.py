"""Transforms between EPSG codes that have a closed form: geographic, the two Mercators
in metres, and all UTM zones. Series are of fourth order in the third flattening, which
is below a millimetre within a zone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import ECCENTRICITY, RADIUS, col, latitude, longitude, mercator_x, mercator_y

GEOGRAPHIC, ELLIPTIC, SPHERICAL = (4326,), (3395,), (3857, 3785, 900913)
SCALE, FALSE_EAST, FALSE_NORTH = 0.9996, 500_000.0, 10_000_000.0
_F = 1 - math.sqrt(1 - ECCENTRICITY**2)
N3 = _F / (2 - _F)
#: Radius of the rectifying sphere, times the scale on the central meridian.
ARC = SCALE * RADIUS / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)


def _series(*rows: tuple[float, ...]) -> list[float]:
    """Row j holds the factors of n**j, n**(j + 1), ..."""
    return [sum(f * N3 ** (j + k) for k, f in enumerate(row)) for j, row in enumerate(rows, 1)]


# The published series of the transverse Mercator projection.
ALPHA = _series((1 / 2, -2 / 3, 5 / 16, 41 / 180), (13 / 48, -3 / 5, 557 / 1440), (61 / 240, -103 / 140), (49561 / 161280,))
BETA = _series((1 / 2, -2 / 3, 37 / 96, -1 / 360), (1 / 48, 1 / 15, -437 / 1440), (17 / 480, -37 / 840), (4397 / 161280,))
DELTA = _series((2, -2 / 3, -2, 116 / 45), (7 / 3, -8 / 5, -227 / 45), (56 / 15, -136 / 35), (4279 / 630,))


def utm_zone(epsg: int) -> tuple[int, bool] | None:
    """(zone, south) of 326zz and 327zz."""
    zone = epsg % 100
    return (zone, epsg // 100 == 327) if epsg // 100 in (326, 327) and 1 <= zone <= 60 else None


def utm_of(lng: float, lat: float) -> int:
    """EPSG code of the zone of a place, without the exceptions around Norway."""
    zone = min(60, int((lng + 180) // 6) + 1)
    return (32700 if lat < 0 else 32600) + zone


def utm(lng, lat, epsg: int) -> list[Column]:
    zone, south = utm_zone(epsg)
    s, lam = F.sin(F.radians(col(lat))), F.radians(col(lng) - (6 * zone - 183))
    t = F.sinh(F.atanh(s) - F.atanh(s * ECCENTRICITY) * ECCENTRICITY)
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(t * t + 1))
    north, east = xi, eta
    for j, a in enumerate(ALPHA, 1):
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
    return [east * ARC + FALSE_EAST, north * ARC + (FALSE_NORTH if south else 0.0)]


def utm_inverse(x, y, epsg: int) -> list[Column]:
    zone, south = utm_zone(epsg)
    north, east = (col(y) - (FALSE_NORTH if south else 0.0)) / ARC, (col(x) - FALSE_EAST) / ARC
    xi, eta = north, east
    for j, b in enumerate(BETA, 1):
        xi = xi - F.sin(north * (2 * j)) * F.cosh(east * (2 * j)) * b
        eta = eta - F.cos(north * (2 * j)) * F.sinh(east * (2 * j)) * b
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, d in enumerate(DELTA, 1):
        phi = phi + F.sin(chi * (2 * j)) * d
    return [F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + (6 * zone - 183), F.degrees(phi)]


def transform(x, y, source: int, target: int, z=None) -> list[Column]:
    """Coordinates of ``source`` in ``target``; a height passes as it is."""
    half = math.pi * RADIUS
    if source == target:
        out = [col(x), col(y)]
    else:
        e = ECCENTRICITY if ELLIPTIC[0] in (source, target) else 0.0
        if source in GEOGRAPHIC:
            lng, lat = col(x), col(y)
        elif source in SPHERICAL + ELLIPTIC:
            lng, lat = longitude(col(x) / half), latitude(col(y) / half, e if source in ELLIPTIC else 0.0)
        elif utm_zone(source):
            lng, lat = utm_inverse(x, y, source)
        else:
            raise ValueError(f"EPSG:{source} has no transform here")
        if target in GEOGRAPHIC:
            out = [lng, lat]
        elif target in SPHERICAL + ELLIPTIC:
            out = [mercator_x(lng) * half, mercator_y(lat, e if target in ELLIPTIC else 0.0) * half]
        elif utm_zone(target):
            out = utm(lng, lat, target)
        else:
            raise ValueError(f"EPSG:{target} has no transform here")
    return out if z is None else [*out, col(z)]
