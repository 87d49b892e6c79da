"""Elevation files of any supported format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .raster import ascii_grids
from .text import elevation_points, lines


def elevation(spark: SparkSession, path: str, columns: int = 3) -> DataFrame:
    """Points (x, y, elevation) of a folder's files: .xyz are texts of ``columns`` columns, .asc and
    .grd are grids, others are left alone."""
    grids = ascii_grids(spark, path, "*.{asc,grd}").select("x", "y", "v").withColumnRenamed("v", "elevation")
    return elevation_points(lines(spark, path, "*.xyz"), columns).unionByName(grids)
