"""Merges, sampling and warping of rasters in the cell-row encoding, and tile blobs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.general import bilinear, cubic

CHANNELS = ("r", "g", "b", "a")


def merged(df: DataFrame, priority: Column, keys: tuple[str, ...] = ("px", "py"), values: tuple[str, ...] = CHANNELS) -> DataFrame:
    """One row per cell: that of the least priority among rows with alpha; one exchange."""
    best = F.min_by(F.struct(*values), F.struct(F.when(F.col("a") > 0, 0).otherwise(1), priority))
    return df.groupBy(*keys).agg(best.alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def fill(old: DataFrame, new: DataFrame) -> DataFrame:
    """New pixels only where the old are empty."""
    return merged(old.withColumn("_p", F.lit(0)).unionByName(new.withColumn("_p", F.lit(1))), F.col("_p"))


def overwrite(old: DataFrame, new: DataFrame) -> DataFrame:
    """New pixels wherever they aren't empty."""
    return merged(old.withColumn("_p", F.lit(1)).unionByName(new.withColumn("_p", F.lit(0))), F.col("_p"))


def raw_merge(old: DataFrame, new: DataFrame, mode: str, nodata: float = -9000) -> DataFrame:
    """fill: where the old value is absent or below ``nodata``; overwrite: wherever a new one is."""
    both = old.select("px", "py", F.col("v").alias("v0")).join(new.select("px", "py", F.col("v").alias("v1")), ["px", "py"], "full")
    kept = F.when(F.col("v0").isNull() | (F.col("v0") < nodata), F.coalesce("v1", "v0")).otherwise(F.col("v0"))
    return both.select("px", "py", (kept if mode == "fill" else F.coalesce("v1", "v0")).alias("v"))


def sample(points: DataFrame, cells: DataFrame, kind: str = "bilinear") -> DataFrame:
    """Values of ``cells`` (px, py, v) at distinct points (id, x, y): each point asks for
    its 4 or 16 cells, which come by one equi-join; points that lack any are dropped."""
    reach = (0, 1) if kind == "bilinear" else (-1, 0, 1, 2)
    asks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for j in reach for i in reach])
    asked = points.withColumn("_o", F.explode(asks)).select(
        "id", "x", "y", "_o.i", "_o.j", (F.floor("x") + F.col("_o.i")).alias("px"), (F.floor("y") + F.col("_o.j")).alias("py")
    )
    at = lambda i, j: F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("v"))).alias(f"v{i + 1}{j + 1}")
    got = asked.join(cells, ["px", "py"]).groupBy("id", "x", "y").agg(F.count("*").alias("_n"), *[at(i, j) for j in reach for i in reach])
    got = got.where(F.col("_n") == len(reach) ** 2)
    u, w = F.col("x") - F.floor("x"), F.col("y") - F.floor("y")
    c = lambda i, j: F.col(f"v{i + 1}{j + 1}")
    if kind == "bilinear":
        value = bilinear(c(0, 0), c(1, 0), c(0, 1), c(1, 1), u, w)
    else:
        value = cubic(*[cubic(*[c(i, j) for i in reach], u) for j in reach], w)
    return got.select("id", value.alias("value"))


def warp_anchor(tx: Column, ty: Column, anchors: list[tuple[Column, Column]]) -> list[Column]:
    """Source place of a tile's pixel from its corners' (NW, NE, SE, SW), without a
    reprojection of each pixel."""
    dx, dy = tx / 255.0, ty / 255.0
    return [bilinear(anchors[0][k], anchors[1][k], anchors[3][k], anchors[2][k], dx, dy) for k in (0, 1)]


# Tile blobs: one row per tile, row-major bytes ---------------------------------------


def to_blobs(cells: DataFrame, size: int = 256) -> DataFrame:
    """(tx, ty, rgba) from cells (px, py, r, g, b, a)."""

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        tile = np.zeros((size, size, 4), np.uint8)
        tile[rows["py"].to_numpy() % size, rows["px"].to_numpy() % size] = rows[list(CHANNELS)].to_numpy(np.uint8)
        return pd.DataFrame({"tx": [key[0]], "ty": [key[1]], "rgba": [tile.tobytes()]})

    keyed = cells.withColumn("tx", F.floor(F.col("px") / size)).withColumn("ty", F.floor(F.col("py") / size))
    return keyed.groupBy("tx", "ty").applyInPandas(pack, "tx bigint, ty bigint, rgba binary")


def to_cells(blobs: DataFrame, size: int = 256) -> DataFrame:
    def unpack(batches):
        for batch in batches:
            for x, y, blob in zip(batch["tx"], batch["ty"], batch["rgba"]):
                tile = np.frombuffer(blob, np.uint8).reshape(size, size, 4)
                j, i = np.nonzero(tile.any(axis=2))
                out = pd.DataFrame(tile[j, i].astype(np.int64), columns=list(CHANNELS))
                yield out.assign(px=x * size + i, py=y * size + j)

    return blobs.mapInPandas(unpack, "r bigint, g bigint, b bigint, a bigint, px bigint, py bigint")


def halve_blobs(blobs: DataFrame, size: int = 256) -> DataFrame:
    """Parents from four children: the color mean on blobs."""

    def reduce(key, rows: pd.DataFrame) -> pd.DataFrame:
        four = np.zeros((2 * size, 2 * size, 4), np.int64)
        for x, y, blob in zip(rows["tx"], rows["ty"], rows["rgba"]):
            j, i = y % 2 * size, x % 2 * size
            four[j : j + size, i : i + size] = np.frombuffer(blob, np.uint8).reshape(size, size, 4)
        seen = (four[..., 3:] > 0).astype(np.int64)
        cut = lambda a: a.reshape(size, 2, size, 2, -1).sum(axis=(1, 3))
        n = cut(seen)
        mean = cut(four * seen) // np.maximum(n, 1)
        return pd.DataFrame({"tx": [key[0]], "ty": [key[1]], "rgba": [mean.astype(np.uint8).tobytes()]})

    parent = [F.shiftright("tx", 1).alias("_x"), F.shiftright("ty", 1).alias("_y")]
    return blobs.groupBy(*parent).applyInPandas(reduce, "tx bigint, ty bigint, rgba binary")
