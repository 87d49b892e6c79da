"""Filters, clips, and bins of points into tiles and voxels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOWEST, HIGHEST = -8000, 12000


def valid_elevation(df: DataFrame, value="elevation", nodata=None) -> DataFrame:
    v = F.col(value)
    df = df if nodata is None else df.where(v != nodata)
    return df.where(v.between(LOWEST, HIGHEST))


def overlaps(a: list[str], b: list[str]) -> Column:
    """Boxes x0, y0, x1, y1 meet."""
    a, b = [F.col(c) for c in a], [F.col(c) for c in b]
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def clipped(a: list[str], b: list[str]) -> list[Column]:
    return [F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])]


def inside(x, y, x0, y0, x1, y1) -> Column:
    """In the open box."""
    return (F.col(x) > x0) & (F.col(x) < x1) & (F.col(y) > y0) & (F.col(y) < y1)


def interior_tiles(df: DataFrame, x0: int, y0: int, x1: int, y1: int) -> DataFrame:
    """Without the border of one tile; extents below 3 by 3 have none."""
    return df.where(F.col("tx").between(x0 + 1, x1 - 1) & F.col("ty").between(y0 + 1, y1 - 1))


def in_polygon(x: Column, y: Column, polygon: Column) -> Column:
    """Ray crossing; polygon: array of structs x, y in order."""
    edges = F.zip_with(polygon, F.concat(F.slice(polygon, 2, F.size(polygon) - 1), F.slice(polygon, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    crosses = lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"])
    return F.size(F.filter(edges, crosses)) % 2 == 1


def orientation(ax, ay, bx, by, cx, cy) -> Column:
    """Positive if counter-clockwise: twice the signed area."""
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def triangle_relation(p: list[Column], a: list[Column], b: list[Column], c: list[Column]) -> Column:
    """invalid, outside, vertex0-2, edge0-2 (opposite the vertex of that number) or inside."""
    whole = orientation(*a, *b, *c)
    s = [orientation(*b, *c, *p), orientation(*c, *a, *p), orientation(*a, *b, *p)]
    s = [F.signum(v) * F.signum(whole) for v in s]
    zero = [v == 0 for v in s]
    rel = F.when(whole == 0, "invalid").when((s[0] < 0) | (s[1] < 0) | (s[2] < 0), "outside")
    rel = rel.when(zero[1] & zero[2], "vertex0").when(zero[0] & zero[2], "vertex1").when(zero[0] & zero[1], "vertex2")
    return rel.when(zero[0], "edge0").when(zero[1], "edge1").when(zero[2], "edge2").otherwise("inside")


def barycentric(p: list[Column], a: list[Column], b: list[Column], c: list[Column]) -> list[Column]:
    whole = orientation(*a, *b, *c)
    r, s = orientation(*p, *b, *c) / whole, orientation(*a, *p, *c) / whole
    return [r, s, 1 - r - s]


def tile_stats(df: DataFrame, value: str) -> DataFrame:
    """Count, exact sum, mean, least and greatest of an integer column by tile."""
    v = F.col(value)
    return df.groupBy("tx", "ty").agg(
        F.count("*").alias("n"), F.sum(v).cast("bigint").alias("total"),
        (F.sum(v).cast("double") / F.count("*")).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"),
    )


def bounds(df: DataFrame, *columns: str) -> DataFrame:
    """Least and greatest of each column and the number of rows."""
    return df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))], F.count("*").alias("n"))


def voxel_stats(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Means of integer columns by voxel, from exact sums and the true count."""
    means = [(F.sum(v).cast("double") / F.count("*")).alias(f"mean_{v}") for v in values]
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *means)


def first_points(df: DataFrame, x: str, y: str, order: list[str], tolerance: float = 1e-12) -> DataFrame:
    """One row of those at the same place (to the tolerance), the first by ``order``."""
    key = [F.floor(F.col(c) / tolerance + 0.5) for c in (x, y)]
    row = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_row", row).where("_row = 1").drop("_row")


def cap_points(df: DataFrame, most: int, order: list[Column]) -> DataFrame:
    """At most ``most`` rows a tile."""
    row = F.row_number().over(Window.partitionBy("tx", "ty").orderBy(*order))
    return df.withColumn("rank", row).where(F.col("rank") <= most)


def thinned(values: Column, distance: float) -> Column:
    """Of a sorted array, the elements farther than ``distance`` from the last kept."""
    keep = lambda kept, v: F.when((F.size(kept) == 0) | (v - F.element_at(kept, -1) > distance), F.concat(kept, F.array(v))).otherwise(kept)
    return F.aggregate(values, F.array().cast("array<double>"), keep)


def halo(df: DataFrame, margin: Column | None = None, x="tx", y="ty") -> DataFrame:
    """Rows of each tile and its eight neighbours under the tile's key (cx, cy).

    A row is sent to the neighbours instead of joining tiles with tiles: one exchange.
    margin: a condition on dx, dy under which a neighbour needs the row.
    """
    offsets = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    out = df.withColumn("_o", F.explode(offsets)).select("*", "_o.dx", "_o.dy").drop("_o")
    if margin is not None:
        out = out.where(margin)
    return out.withColumn("cx", F.col(x) + F.col("dx")).withColumn("cy", F.col(y) + F.col("dy"))
