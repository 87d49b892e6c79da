"""Text sources. Malformed lines are dropped, not raised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).text(path)


def elevation_points(text: DataFrame, columns: int, keep: list[str] | None = None) -> DataFrame:
    """x y z, space separated; every line must have as many columns as the first one has."""
    parts = F.split(F.trim("value"), " +")
    rows = text.select(*(keep or []), parts.alias("_p")).where(F.size("_p") == columns)
    number = lambda i: F.get("_p", F.lit(i)).try_cast("double")
    return rows.select(*(keep or []), number(0).alias("x"), number(1).alias("y"), number(2).alias("elevation")).dropna(subset=["x", "y", "elevation"])


def cloud_points(text: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """XYZ, XYZI, XYZRGB or XYZIRGB by the number of columns; separators: blank , ; tab."""
    parts = F.split(F.trim("value"), "[ ,;\t]+")
    rows = text.select(*(keep or []), parts.alias("_p"), F.size(parts).alias("_n")).where("_n in (3, 4, 6, 7)")
    number = lambda i, t: F.get("_p", i if not isinstance(i, int) else F.lit(i)).try_cast(t)
    rgb = [F.when(F.col("_n") >= 6, number(F.col("_n") - 3 + k, "int")).otherwise(255).alias(c) for k, c in enumerate("rgb")]
    out = rows.select(
        *(keep or []), number(0, "double").alias("x"), number(1, "double").alias("y"), number(2, "double").alias("elevation"),
        F.when(F.col("_n").isin(4, 7), number(3, "int")).alias("intensity"), *rgb,
    )
    return out.dropna(subset=["x", "y", "elevation", "r", "g", "b"])


def expire_list(text: DataFrame) -> DataFrame:
    """lod, tx, ty from lines z/x/y; blank and malformed lines are skipped."""
    parts = F.split(F.trim("value"), "/")
    rows = text.select(parts.alias("_p")).where(F.size("_p") == 3)
    number = lambda i, t: F.get("_p", F.lit(i)).try_cast(t)
    return rows.select(number(0, "int").alias("lod"), number(1, "bigint").alias("tx"), number(2, "bigint").alias("ty")).dropna()
