"""Tile and job enumeration, composition of layers, and map styles."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import box_tiles_py


def expand(df: DataFrame, x0="x0", y0="y0", x1="x1", y1="y1") -> DataFrame:
    """A row for each tile (tx, ty) of each inclusive extent."""
    rows = df.withColumn("tx", F.explode(F.sequence(x0, x1)))
    return rows.withColumn("ty", F.explode(F.sequence(y0, y1)))


class TilesOf:
    """Table function: tiles (tx, ty) of an inclusive extent; none if a bound is null."""

    def eval(self, x0: int, y0: int, x1: int, y1: int):
        if None not in (x0, y0, x1, y1):
            for tx in range(x0, x1 + 1):
                for ty in range(y0, y1 + 1):
                    yield tx, ty


def register(spark: SparkSession) -> None:
    """Make ``tiles_of(x0, y0, x1, y1)`` known to SQL. ``expand`` does the same inside the JVM."""
    spark.udtf.register("tiles_of", F.udtf(TilesOf, returnType="tx bigint, ty bigint"))


def layer_tiles(spark: SparkSession, x0: int, y0: int, x1: int, y1: int, top: int, lowest: int = 1) -> DataFrame:
    """Tiles of an extent at ``top`` and of its ancestors on each level."""
    levels = spark.range(lowest, top + 1).withColumnRenamed("id", "lod")
    up = lambda v: F.call_function("shiftright", F.lit(v).cast("bigint"), (F.lit(top) - F.col("lod")).cast("int"))
    ext = levels.select(F.col("lod").cast("int").alias("lod"), *[up(v).alias(n) for n, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))])
    return expand(ext).select("lod", "tx", "ty")


def render_jobs(spark: SparkSession, bounds: tuple[float, float, float, float], zooms: range) -> DataFrame:
    """Tiles that a box touches, one more on the far sides, within the world."""
    rows = [(z, *box_tiles_py(*bounds, z)) for z in zooms]
    df = spark.createDataFrame(rows, "lod int, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    out = expand(df.withColumn("x1", F.col("x1") + 1).withColumn("y1", F.col("y1") + 1))
    return valid(out.select("lod", "tx", "ty"))


def valid(tiles: DataFrame) -> DataFrame:
    n = F.pow(F.lit(2.0), F.col("lod"))
    return tiles.where((F.col("tx") >= 0) & (F.col("ty") >= 0) & (F.col("tx") < n) & (F.col("ty") < n))


def shade_jobs(spark: SparkSession, extent: tuple[int, int, int, int], level: int, lowest: int, highest: int, borders: bool = False) -> DataFrame:
    """Tiles to shade: ancestors below the layer's level, all descendants above it."""
    rows = []
    for z in range(lowest, highest + 1):
        x0, y0, x1, y1 = extent
        if z <= level:
            ext = [v >> level - z for v in extent]
        else:
            k = 1 << z - level
            ext = [x0 * k, y0 * k, x1 * k + k - 1, y1 * k + k - 1]
        if not borders:
            ext = [ext[0] + 1, ext[1] + 1, ext[2] - 1, ext[3] - 1]
        if ext[0] <= ext[2] and ext[1] <= ext[3]:
            rows.append((z, *ext))
    df = spark.createDataFrame(rows, "lod int, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    return expand(df).select("lod", "tx", "ty")


def missing(jobs: DataFrame, existing: DataFrame, keys=("lod", "tx", "ty")) -> DataFrame:
    """Jobs whose result isn't there yet."""
    return jobs.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def nearest_ancestor(tiles: DataFrame, existing: DataFrame) -> DataFrame:
    """For each tile the deepest existing tile that holds it: ancestors are looked up by
    an equi-join, and the deepest is kept. Adds found, up and sub_x, sub_y in 0..1."""
    up = F.explode(F.sequence(F.lit(0), F.col("lod"))).alias("up")
    asked = tiles.select("lod", "tx", "ty", up)
    at = lambda c: F.call_function("shiftright", F.col(c), F.col("up"))
    asked = asked.select("lod", "tx", "ty", "up", (F.col("lod") - F.col("up")).alias("alod"), at("tx").alias("ax"), at("ty").alias("ay"))
    have = existing.select(F.col("lod").alias("alod"), F.col("tx").alias("ax"), F.col("ty").alias("ay")).distinct()
    best = asked.join(have, ["alod", "ax", "ay"]).groupBy("lod", "tx", "ty").agg(F.min("up").alias("up"))
    n = F.pow(F.lit(2.0), F.col("up"))
    return best.select("lod", "tx", "ty", "up", (F.col("tx") / n - F.floor(F.col("tx") / n)).alias("sub_x"), (F.col("ty") / n - F.floor(F.col("ty") / n)).alias("sub_y"))


def composed(top: list[Column], top_alpha: Column, base: list[Column], base_alpha: Column, mode: str) -> list[Column]:
    """Channels 0..255. unify: by the top's alpha; unifyopaque: the top wherever it isn't
    empty; overlay: by the base's alpha, so that the top shows where the base is empty."""
    if mode == "unify":
        share = top_alpha / 255.0
    elif mode == "unifyopaque":
        share = F.when(top_alpha > 0, 1.0).otherwise(0.0)
    else:
        share = 1 - base_alpha / 255.0
    return [F.floor(t * share + b * (1 - share) + 0.5).cast("int") for t, b in zip(top, base)]


# Map styles ----------------------------------------------------------------------------


def rule_filter(text: str) -> Column:
    """A map rule such as "[CLASS] = 3 or [CLASS] = 4" as a predicate."""
    return F.expr(re.sub(r"\[([^\]]+)\]", r"`\1`", text)) if text.strip() else F.lit(True)


def scale_denominator(zoom: int) -> float:
    """Of a zoom level of 256-pixel tiles, with pixels of 0.28 mm."""
    return 559082264.028 / (1 << zoom)


def visible_zooms(least: float, most: float, zooms: range = range(0, 24)) -> list[int]:
    """Zooms whose scale denominator is in [least, most)."""
    return [z for z in zooms if least <= scale_denominator(z) < most]


def features_by_rule(features: DataFrame, rules: list[dict]) -> DataFrame:
    """(feature, rule, zoom): features that pass a rule's filter, at each zoom it shows."""
    shown = []
    for rule in rules:
        zooms = F.array(*[F.lit(z) for z in visible_zooms(rule.get("min", 0.0), rule.get("max", 1e12))]).cast("array<int>")
        fits = F.when(rule_filter(rule.get("filter", "")), zooms).otherwise(F.array().cast("array<int>"))
        shown.append(F.arrays_zip(F.array_repeat(F.lit(rule["name"]), F.size(fits)).alias("rule"), fits.alias("zoom")))
    # One scan for all rules.
    return features.select("*", F.inline(F.concat(*shown)))
