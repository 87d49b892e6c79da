"""Text encodings of points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def converted(points: DataFrame) -> DataFrame:
    """Lines x,y,z,r,g,b,1, with colors in 0..1."""
    place = [F.regexp_replace(F.col(c).cast("string"), r"\.0$", "") for c in ("x", "y", "elevation")]
    rgb = [F.format_string("%.3f", F.col(c) / 255.0) for c in "rgb"]
    return points.withColumn("line", F.concat_ws(",", *place, *rgb, F.lit("1"), F.lit("")))
