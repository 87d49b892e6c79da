"""Web-Mercator quadtree and octree functions on columns.

Coordinates are normalised Mercator, x and y in [-1, 1] with y up; pixels and tiles
count from the top left. A pixel is the rounded place on a raster of size - 1, not the
floor of place times size: tile keys depend on it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS = 6378137.0
ECCENTRICITY = 0.08181919084262149  # WGS84
TILE = 256


def col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def clip(x: Column, low, high) -> Column:
    """Between low and high; null stays null, which greatest and least would skip."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, col(high)), col(low)))


# Mercator ------------------------------------------------------------------------


def mercator_x(lng) -> Column:
    return F.radians(col(lng)) / F.pi()


def mercator_y(lat, e: float = 0.0) -> Column:
    """Sphere by default; e: eccentricity of the ellipsoid."""
    phi = F.radians(col(lat))
    t = F.tan(F.pi() / 4 + phi / 2)
    if e:
        s = F.sin(phi) * e
        t = t * F.pow((1 - s) / (1 + s), F.lit(e / 2))
    return F.log(t) / F.pi()


def longitude(x) -> Column:
    """Wrapped to [-180, 180]."""
    deg = F.degrees(col(x) * F.pi())
    return deg - F.lit(360.0) * F.floor((deg + 180.0) / 360.0) * (F.abs(deg) > 180.0).cast("int")


def latitude(y, e: float = 0.0, rounds: int = 10) -> Column:
    t = F.exp(-col(y) * F.pi())
    phi = F.pi() / 2 - F.atan(t) * 2
    for _ in range(rounds if e else 0):
        s = F.sin(phi) * e
        phi = F.pi() / 2 - F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2))) * 2
    return F.degrees(phi)


MAX_LATITUDE = math.degrees(2 * math.atan(math.exp(math.pi)) - math.pi / 2)


def world_latitude(lat) -> Column:
    """On the square map, which ends before the poles."""
    return clip(col(lat), -MAX_LATITUDE, MAX_LATITUDE)


def ground_resolution(lat, lod) -> Column:
    """Metres per pixel."""
    return F.cos(F.radians(world_latitude(lat))) * (2 * math.pi * RADIUS) / map_size(lod)


def map_size(lod) -> Column:
    if isinstance(lod, int):
        return F.lit(TILE << lod).cast("bigint")
    return F.expr(f"shiftleft(cast({TILE} as bigint), {lod})") if isinstance(lod, str) else F.call_function("shiftleft", F.lit(TILE).cast("bigint"), lod)


# Pixels and tiles ------------------------------------------------------------------


def pixel_x(x, lod) -> Column:
    last = map_size(lod) - 1
    return clip(F.floor((col(x) + 1) / 2 * last + 0.5), 0, last).cast("bigint")


def pixel_y(y, lod) -> Column:
    return map_size(lod) - 1 - pixel_x(y, lod)


def tile_of(pixel) -> Column:
    return F.shiftright(col(pixel), 8)


def with_tiles(df, lod: int, lng="lng", lat="lat"):
    """df with px, py, tx and ty at a level of detail."""
    df = df.withColumn("px", pixel_x(mercator_x(lng), lod)).withColumn("py", pixel_y(mercator_y(world_latitude(lat)), lod))
    return df.withColumn("tx", tile_of("px")).withColumn("ty", tile_of("py"))


def tile_bbox(x, y, lod) -> list[Column]:
    """x0, y0 (top), x1, y1 (bottom) in Mercator; exact, as only halves are taken."""
    n = F.pow(F.lit(2.0), col(lod))
    edge = lambda v: col(v) * 2 / n
    return [edge(x) - 1, 1 - edge(y), edge(col(x) + 1) - 1, 1 - edge(col(y) + 1)]


def ancestor(v, levels) -> Column:
    return F.shiftright(col(v), levels) if isinstance(levels, int) else F.call_function("shiftright", col(v), levels)


# Quadkeys --------------------------------------------------------------------------


def bits(v) -> Column:
    return F.bin(col(v)).cast("decimal(38,0)")


def quadkey(x, y, lod) -> Column:
    """Digits bit(x) + 2 bit(y), most significant first; valid to level 37."""
    key = (bits(x) + bits(y) * 2).cast("decimal(38,0)").cast("string")
    return F.lpad(key, lod, "0") if isinstance(lod, int) else F.call_function("lpad", key, col(lod), F.lit("0"))


def quadkey_x(key) -> Column:
    return F.conv(F.translate(col(key), "0123", "0101"), 2, 10).cast("bigint")


def quadkey_y(key) -> Column:
    return F.conv(F.translate(col(key), "0123", "0011"), 2, 10).cast("bigint")


def quadkey_parent(key) -> Column:
    return F.expr(f"left({key}, length({key}) - 1)")


def quadkey_child(key, digit) -> Column:
    return F.concat(col(key), col(digit).cast("string"))


def quadkey_digit(key) -> Column:
    """Which child of its parent it is."""
    return F.right(col(key), F.lit(1)).cast("int")


def quadkey_ranges(x0: int, y0: int, x1: int, y1: int, lod: int, most: int = 16) -> list[tuple[str, str]]:
    """A few [low, high] ranges of quadkeys that cover a tile extent, so that a filter
    on it becomes BETWEEN predicates that reach sorted files."""

    def key(x: int, y: int, level: int) -> str:
        return "".join(str((x >> b & 1) + 2 * (y >> b & 1)) for b in range(level - 1, -1, -1))

    level = lod
    while level and ((x1 >> lod - level) - (x0 >> lod - level) + 1) * ((y1 >> lod - level) - (y0 >> lod - level) + 1) > most:
        level -= 1
    down = lod - level
    keys = sorted(key(x, y, level) for x in range(x0 >> down, (x1 >> down) + 1) for y in range(y0 >> down, (y1 >> down) + 1))
    out: list[tuple[str, str]] = []
    for k in keys:
        low, high = k + "0" * down, k + "3" * down
        if out and int(out[-1][1] or "0", 4) + 1 == int(low or "0", 4):
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def in_extent(key, x0: int, y0: int, x1: int, y1: int, lod: int) -> Column:
    """The rewrite of a box predicate on quadkeys of one level; exact with the tile test."""
    cond = F.lit(False)
    for low, high in quadkey_ranges(x0, y0, x1, y1, lod):
        cond = cond | col(key).between(low, high)
    return cond & quadkey_x(key).between(x0, x1) & quadkey_y(key).between(y0, y1)


# Octree ----------------------------------------------------------------------------


def octocode(i, j, k, level) -> Column:
    key = (bits(i) + bits(j) * 2 + bits(k) * 4).cast("decimal(38,0)").cast("string")
    return F.lpad(key, level, "0")


def octocode_axis(code, axis: int) -> Column:
    digits = "".join(str(d >> axis & 1) for d in range(8))
    return F.conv(F.translate(col(code), "01234567", digits), 2, 10).cast("bigint")


def octree_index(i, j, k, level: int) -> Column:
    n = 1 << level
    return col(k) * (n * n) + col(j) * n + col(i)


def octree_unpack(index, level: int) -> list[Column]:
    n = 1 << level
    return [col(index) % n, F.floor(col(index) / n).cast("bigint") % n, F.floor(col(index) / (n * n)).cast("bigint")]


def octree_box(i, j, k, level: int) -> list[Column]:
    """Lower corner and edge length in the unit cube."""
    n = float(1 << level)
    return [col(i) / n, col(j) / n, col(k) / n, F.lit(1 / n)]


# Extents ---------------------------------------------------------------------------


def box_tiles(lng0, lat0, lng1, lat1, lod) -> list[Column]:
    """x0, y0, x1, y1: the tiles of the box's corners."""
    return [
        tile_of(pixel_x(mercator_x(lng0), lod)), tile_of(pixel_y(mercator_y(world_latitude(lat1)), lod)),
        tile_of(pixel_x(mercator_x(lng1), lod)), tile_of(pixel_y(mercator_y(world_latitude(lat0)), lod)),
    ]


def box_tiles_py(lng0: float, lat0: float, lng1: float, lat1: float, lod: int) -> tuple[int, int, int, int]:
    """The same for constants."""
    last = (TILE << lod) - 1
    px = lambda v: min(max(math.floor((v + 1) / 2 * last + 0.5), 0), last)
    y = lambda lat: math.log(math.tan(math.pi / 4 + math.radians(min(max(lat, -MAX_LATITUDE), MAX_LATITUDE)) / 2)) / math.pi
    return px(lng0 / 180) >> 8, last - px(y(lat1)) >> 8, px(lng1 / 180) >> 8, last - px(y(lat0)) >> 8


SAMPLES = {"elevation": 22, "image": 256}


def recommend_lod(pixelsize: float, lat0: float, lat1: float, kind: str, fix: bool = False) -> int:
    """The level whose samples are just finer than pixelsize metres; 0 if none is.

    fix: take the mean latitude; else half the difference, as published results do.
    """
    lat = 0.5 * (lat0 + lat1) if fix else 0.5 * (lat1 - lat0)
    v = lambda l: math.cos(math.radians(lat)) * 2 * math.pi * RADIUS / (1 << l) / SAMPLES[kind]
    return max((l for l in range(20) if v(l + 1) < pixelsize < v(l)), default=0)


def recommended_lod(pixelsize, lat, kind: str) -> Column:
    """recommend_lod on columns, for a latitude."""
    levels = F.sequence(F.lit(0), F.lit(19))
    v = lambda l: F.cos(F.radians(col(lat))) * (2 * math.pi * RADIUS / SAMPLES[kind]) / F.pow(F.lit(2.0), l)
    fit = F.filter(levels, lambda l: (v(l + 1) < col(pixelsize)) & (col(pixelsize) < v(l)))
    return F.coalesce(F.array_max(fit), F.lit(0))


# Affine transforms and the renderer's projection ------------------------------------


def affine_apply(a: list, x, y) -> list[Column]:
    """a0 + a1 x + a2 y, a3 + a4 x + a5 y."""
    a = [col(v) for v in a]
    return [a[0] + a[1] * col(x) + a[2] * col(y), a[3] + a[4] * col(x) + a[5] * col(y)]


def affine_inverse(a: list) -> list[Column]:
    a = [col(v) for v in a]
    det = a[1] * a[5] - a[2] * a[4]
    return [
        (a[2] * a[3] - a[0] * a[5]) / det, a[5] / det, -a[2] / det,
        (a[0] * a[4] - a[1] * a[3]) / det, -a[4] / det, a[1] / det,
    ]


def render_pixel(lng, lat, zoom: int) -> list[Column]:
    """The map renderer's own projection: sine of latitude clipped, rounded pixels."""
    size = TILE << zoom
    f = clip(F.sin(F.radians(col(lat))), -0.9999, 0.9999)
    return [
        F.floor(size / 2 + col(lng) * (size / 360) + 0.5),
        F.floor(size / 2 - F.log((1 + f) / (1 - f)) * 0.5 * (size / (2 * math.pi)) + 0.5),
    ]


def render_lnglat(px, py, zoom: int) -> list[Column]:
    size = TILE << zoom
    g = (col(py) - size / 2) / -(size / (2 * math.pi))
    return [(col(px) - size / 2) / (size / 360), F.degrees(F.atan(F.exp(g)) * 2 - F.pi() / 2)]


def tile_path(base: str, lod, x, y, extension: str) -> Column:
    return F.concat(F.lit(base), F.concat_ws("/", col(lod).cast("string"), col(x).cast("string"), col(y).cast("string")), F.lit(extension))
