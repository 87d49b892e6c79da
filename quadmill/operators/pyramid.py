"""Roll-ups of tiles and pixels, level by level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_all_levels(df: DataFrame, top: int, lowest: int = 1, value: str | None = None) -> DataFrame:
    """Counts (and exact sums) for all levels from ``top`` to ``lowest`` in one pass:
    they add up, so that tiles of ``top`` are summed first and then sent to each level."""
    sums = [F.sum(value).cast("bigint").alias("total")] if value else []
    base = df.groupBy("tx", "ty").agg(F.count("*").alias("n"), *sums)
    each = base.withColumn("lod", F.explode(F.sequence(F.lit(lowest), F.lit(top))))
    up = lambda c: F.call_function("shiftright", F.col(c), F.lit(top) - F.col("lod")).alias(c)
    each = each.select("lod", up("tx"), up("ty"), "n", *(["total"] if value else []))
    again = [F.sum("total").cast("bigint").alias("total")] if value else []
    return each.groupBy("lod", "tx", "ty").agg(F.sum("n").cast("bigint").alias("n"), *again)


def halved(df: DataFrame, aggregates: list[Column], keys: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys, F.shiftright("px", 1).alias("px"), F.shiftright("py", 1).alias("py")).agg(*aggregates)


def color_level(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean of the up to four texels that have alpha; truncated; none: all zero."""
    seen = F.col("a") > 0
    n = F.sum(F.when(seen, 1).otherwise(0))
    mean = lambda c: F.coalesce(F.floor(F.sum(F.when(seen, F.col(c)).otherwise(0)) / F.when(n > 0, n)), F.lit(0)).cast("bigint").alias(c)
    return halved(df, [mean(c) for c in "rgba"], keys)


def raw_level(df: DataFrame, strict: bool = False, nodata: float = -9999.0) -> DataFrame:
    """Mean of the texels there are; strict: absent ones count as ``nodata``."""
    if strict:
        total = F.sum("v") + (F.lit(4) - F.count("*")) * nodata
        return halved(df, [(total / 4.0).alias("v")])
    return halved(df, [(F.sum("v") / F.count("*")).alias("v")])


def iterate(df: DataFrame, top: int, level, lowest: int = 1, every: int = 4) -> DataFrame:
    """All levels, for means that are truncated and can't be taken in one pass. Lineage
    is cut every few levels where the session names a checkpoint folder."""
    out, now = df.withColumn("lod", F.lit(top)), df
    cut = bool(df.sparkSession.sparkContext.getConf().get("spark.checkpoint.dir", ""))
    for lod in range(top - 1, lowest - 1, -1):
        now = level(now)
        if cut and (top - lod) % every == 0:
            now = now.checkpoint()
        out = out.unionByName(now.withColumn("lod", F.lit(lod)))
    return out


def children(df: DataFrame) -> DataFrame:
    """Parents with which of their four children there are (0 NW, 1 NE, 2 SW, 3 SE)."""
    which = F.col("tx") % 2 + F.col("ty") % 2 * 2
    return df.groupBy(F.shiftright("tx", 1).alias("tx"), F.shiftright("ty", 1).alias("ty")).agg(
        F.count("*").alias("n_children"), F.sum(F.pow(F.lit(2.0), which)).cast("int").alias("mask")
    )
