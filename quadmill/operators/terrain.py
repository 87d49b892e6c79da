"""Focal operators on elevation: 3x3 and 5x5 windows, shading, relief colors."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.color import byte, hsv_to_rgb
from ..functions.grid import clip

#: Weights of the 5x5 filter by distance class, fixed.
GAUSS = (
    (0.0037, 0.0147, 0.0256, 0.0147, 0.0037),
    (0.0147, 0.0586, 0.0952, 0.0586, 0.0147),
    (0.0256, 0.0952, 0.1502, 0.0952, 0.0256),
    (0.0147, 0.0586, 0.0952, 0.0586, 0.0147),
    (0.0037, 0.0147, 0.0256, 0.0147, 0.0037),
)
EQUATOR = 20037508.34


def spread(cells: DataFrame, radius: int) -> DataFrame:
    """Each cell's value sent to the cells whose window holds it, with its place k there."""
    side = 2 * radius + 1
    places = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit((radius - j) * side + radius - i).alias("k")) for j in range(-radius, radius + 1) for i in range(-radius, radius + 1)]
    out = cells.withColumn("_o", F.explode(F.array(*places)))
    return out.select((F.col("px") + F.col("_o.i")).alias("px"), (F.col("py") + F.col("_o.j")).alias("py"), F.col("_o.k").alias("k"), "v")


def windows(cells: DataFrame) -> DataFrame:
    """px, py and w0..w8 (row-major) of each cell whose nine cells all exist.

    Nine aggregates over the sent values: one exchange, combined before it.
    """
    picks = [F.max(F.when(F.col("k") == k, F.col("v"))).alias(f"w{k}") for k in range(9)]
    grouped = spread(cells, 1).groupBy("px", "py").agg(F.count("*").alias("_n"), *picks)
    return grouped.where("_n = 9").drop("_n")


def w(k: int) -> Column:
    return F.col(f"w{k}")


def resolution(xmin: float, xmax: float, ymin: float, ymax: float, width: int, height: int) -> tuple[float, float]:
    """East-west and north-south metres a pixel; the latter is negative."""
    return abs(xmax - xmin) * EQUATOR / width, -abs(ymax - ymin) * EQUATOR / height


def shaded(x: Column, y: Column, k: float, azimuth: float, altitude: float, scale: float) -> Column:
    alt, az = math.radians(altitude), math.radians(azimuth)
    xx = x * x + y * y
    c = (math.sin(alt) - math.cos(alt) * k * F.sqrt(xx) * F.sin(F.atan2(y, x) - az)) / F.sqrt(1 + k * k * xx)
    return F.when(c <= 0, F.lit(1)).otherwise(F.floor(1 + scale * c)).cast("int")


def hillshade(ew: float, ns: float, z: float = 1.0, azimuth: float = 315.0, altitude: float = 45.0, scale: float = 1.0) -> Column:
    """Zevenbergen and Thorne: the four neighbours, in 1..255."""
    return shaded((w(3) - w(5)) / ew, (w(7) - w(1)) / ns, z / (2 * scale), azimuth, altitude, 254.0)


def hillshade_horn(ew: float, ns: float, z: float = 1.0, azimuth: float = 315.0, altitude: float = 45.0, scale: float = 1.0) -> Column:
    """Horn: all eight neighbours."""
    x, y = horn(ew, ns)
    return F.least(shaded(x, y, z / (8 * scale), azimuth, altitude, 255.0), F.lit(255))


def horn(ew: float, ns: float) -> tuple[Column, Column]:
    return ((w(0) + w(3) * 2 + w(6)) - (w(2) + w(5) * 2 + w(8))) / ew, ((w(6) + w(7) * 2 + w(8)) - (w(0) + w(1) * 2 + w(2))) / ns


def slope(ew: float, ns: float, scale: float = 1.0, degrees: bool = False) -> Column:
    x, y = horn(ew, ns)
    rise = F.sqrt(x * x + y * y) / (8 * scale)
    return F.degrees(F.atan(rise)) if degrees else rise * 100


def normal(z: float = 1.0) -> list[Column]:
    """Normalised Sobel gradient as bytes (n + 1) * 127.5."""
    dx = (w(2) + w(5) * 2 + w(8)) - (w(0) + w(3) * 2 + w(6))
    dy = (w(6) + w(7) * 2 + w(8)) - (w(0) + w(1) * 2 + w(2))
    dz = F.lit(1.0 / z)
    n = F.sqrt(dx * dx + dy * dy + dz * dz)
    return [F.floor((v / n + 1) * 127.5).cast("int") for v in (dx, dy, dz)]


def slope_shade(slope_value: Column, shade: Column) -> Column:
    """Darker where steep and where shaded; 180 is the pivot of the shade."""
    t = (255 - slope_value) * 0.8
    return F.when(shade < 180, F.greatest(F.lit(0.0), t - (180 - shade) / 2.0)).otherwise(F.least(F.lit(255.0), t + shade - 180.0))


def relief_hsv(e: Column) -> list[Column]:
    h = F.when(e < 400, 65 + 65 * e / 400.0).when(e < 2000, 130 - 100 * (e - 400) / 1600.0).otherwise(30.0)
    s = F.when(e < 2000, 0.45).otherwise(0.45 + 0.55 * e / 9000.0)
    return [h, s, F.lit(0.5)]


def relief_rgb(e: Column) -> list[Column]:
    return [byte(c * 255) for c in hsv_to_rgb(*relief_hsv(e))]


#: Breaks of the textured relief: height and the texture that is full there.
TEXTURES = ("desert", "ground", "grass", "snow")


def texture_weights(e: Column) -> list[Column]:
    """Shares of TEXTURES at a height; they add up to one."""
    t1, t2, t3 = clip(e / 200.0, 0.0, 1.0), clip((e - 200) / 400.0, 0.0, 1.0), clip((e - 1300) / 900.0, 0.0, 1.0)
    return [1 - t1, t1 - t2, t2 - t3, t3]


def relief_blend(pattern: Column, shade: Column) -> Column:
    return F.greatest(F.lit(0.0), pattern - (255 - shade) * 0.7)


def transparent() -> Column:
    """Any of the nine is nodata."""
    return reduce(lambda a, b: F.least(a, b), [w(k) for k in range(9)]) < -1000


def gaussian(cells: DataFrame) -> DataFrame:
    """px, py, v: the weighted sum of the 25 cells; the border of two is left as it was."""
    weights = F.array(*[F.lit(x) for row in GAUSS for x in row])
    each = spread(cells, 2).withColumn("m", F.element_at(weights, F.col("k") + 1))
    own = F.max(F.when(F.col("k") == 12, F.col("v")))
    total = F.sum((F.col("m") * 10000).cast("decimal(20,0)") * F.col("v").cast("decimal(18,2)")).cast("double") / 10000.0
    out = each.groupBy("px", "py").agg(own.alias("own"), total.alias("total"), F.count("*").alias("n")).where("own is not null")
    return out.select("px", "py", F.when(F.col("n") == 25, F.col("total")).otherwise(F.col("own").cast("double")).alias("v"))


# Blob form ---------------------------------------------------------------------------


def shade_kernel(e: np.ndarray, ew: float, ns: float, z: float = 1.0, azimuth: float = 315.0, altitude: float = 45.0) -> np.ndarray:
    """hillshade on an array with a margin of one; NaN is nodata, and 0 is transparent."""
    x, y = (e[1:-1, :-2] - e[1:-1, 2:]) / ew, (e[2:, 1:-1] - e[:-2, 1:-1]) / ns
    alt, az, k = math.radians(altitude), math.radians(azimuth), z / 2
    xx = x * x + y * y
    c = (math.sin(alt) - math.cos(alt) * k * np.sqrt(xx) * np.sin(np.arctan2(y, x) - az)) / np.sqrt(1 + k * k * xx)
    out = np.where(c <= 0, 1, np.floor(1 + 254 * c))
    full = np.ones(out.shape, bool)
    for j in range(3):
        for i in range(3):
            full &= ~np.isnan(e[j : j + out.shape[0], i : i + out.shape[1]])
    return np.where(full, np.nan_to_num(out), 0).astype(np.uint8)


def hillshade_tiles(cells: DataFrame, ew: float, ns: float, size: int = 64, **options) -> DataFrame:
    """(tx, ty, shade): a tile is computed from its cells and a margin of one cell, which
    alone is sent to neighbours."""
    x, y = F.col("px"), F.col("py")
    tile = [F.floor(c / size) for c in (x, y)]
    edge = lambda c: F.when(F.pmod(c, F.lit(size)) == 0, F.array(F.lit(0), F.lit(-1))).when(F.pmod(c, F.lit(size)) == size - 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = cells.withColumn("_i", F.explode(edge(x))).withColumn("_j", F.explode(edge(y)))
    sent = sent.select((tile[0] + F.col("_i")).alias("tx"), (tile[1] + F.col("_j")).alias("ty"), "px", "py", F.col("v").cast("double").alias("v"))

    def shade(key, rows: pd.DataFrame) -> pd.DataFrame:
        e = np.full((size + 2, size + 2), np.nan)
        e[rows["py"].to_numpy() - key[1] * size + 1, rows["px"].to_numpy() - key[0] * size + 1] = rows["v"].to_numpy()
        return pd.DataFrame({"tx": [key[0]], "ty": [key[1]], "shade": [shade_kernel(e, ew, ns, **options).tobytes()]})

    return sent.groupBy("tx", "ty").applyInPandas(shade, "tx bigint, ty bigint, shade binary")


def shade_cells(tiles: DataFrame, size: int = 64) -> DataFrame:
    """(px, py, shade) of the shaded cells of tiles (tx, ty, shade); 0 is transparent."""

    def cells(batches):
        for batch in batches:
            for tx, ty, blob in zip(batch["tx"], batch["ty"], batch["shade"]):
                grid = np.frombuffer(blob, np.uint8).reshape(size, size)
                j, i = np.nonzero(grid)
                yield pd.DataFrame({"px": tx * size + i, "py": ty * size + j, "shade": grid[j, i].astype(np.int32)})

    return tiles.mapInPandas(cells, "px bigint, py bigint, shade int")
