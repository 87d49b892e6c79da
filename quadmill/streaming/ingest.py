"""Streams of arriving cells: each micro-batch is reduced and written once, and readers
merge. A batch's folder is named by its number, so that a repeated batch replaces itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value), F.max(order).alias(order))


def ingest(stream: DataFrame, path: str, keys: list[str], order: str, value: str):
    """Run what is available of ``stream`` into ``path``; returns the finished query."""

    def write(batch: DataFrame, number: int) -> None:
        newest(batch, keys, order, value).write.mode("overwrite").parquet(f"{path}/data/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def merged(spark: SparkSession, path: str, keys: list[str], order: str, value: str) -> DataFrame:
    """The newest value of each key over all batches."""
    return newest(spark.read.parquet(f"{path}/data"), keys, order, value).select(*keys, value)
