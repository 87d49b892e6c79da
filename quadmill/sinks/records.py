"""Writers of what sources.records reads, and layers of points that grow."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mesh import tile_box
from ..sources.records import LISTS, VOXEL, bounded_batches, pieces


def voxel_records(points: DataFrame) -> DataFrame:
    """lod, i, j, k, data of points with the columns of a voxel file, in order of place; a voxel's
    points meet in one task, so its level has to suit their density."""

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(len(rows), VOXEL)
        rows = rows.sort_values(list(VOXEL.names))
        for n in VOXEL.names:
            out[n] = rows[n].to_numpy()
        return pd.DataFrame([[*key, out.tobytes()]], columns=["lod", "i", "j", "k", "data"])

    return points.select("lod", "i", "j", "k", *VOXEL.names).groupBy("lod", "i", "j", "k").applyInPandas(pack, "lod int, i bigint, j bigint, k bigint, data binary")


def mesh_record(box, parts: dict) -> bytes:
    """A mesh file of its box and parts: the four corners from the north-west clockwise, then each list
    with its length. Points are x, y, elevation; their weight is one."""
    full = lambda ps: np.column_stack([np.asarray(ps, "<f8").reshape(-1, 3), np.ones(len(ps))]).astype("<f8").tobytes()
    return np.asarray(box, "<f8").tobytes() + full(parts["corners"]) + b"".join(len(parts[n]).to_bytes(4, "little") + full(parts[n]) for n in LISTS)


def coordinates(lists: pa.ListArray) -> list[np.ndarray]:
    """Rows x, y, z of each list of points; a null number is NaN."""
    points = lists.flatten()
    if lists.null_count or points.null_count:
        raise ValueError("a list of points or a point in it is null")
    rows = np.column_stack([points.field(n).to_numpy(zero_copy_only=False).astype("<f8") for n in "xyz"])
    ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
    return [rows[a:b] for a, b in zip(ends, ends[1:])]


def mesh_records(tiles: DataFrame) -> DataFrame:
    """lod, tx, ty, data of mesh tiles (lod, tx, ty and the parts). Points stay in Arrow's columns."""
    place, parts = ["lod", "tx", "ty"], ["corners", *LISTS]

    def pack(batches):
        for batch in batches:
            lengths = sum(pc.list_value_length(batch[n]).fill_null(0).to_numpy(zero_copy_only=False).astype(int) for n in parts)
            for first, n in pieces((32 * lengths + 52).tolist()):
                piece = batch.slice(first, n)
                lods, txs, tys = (piece[n].to_numpy(zero_copy_only=False).tolist() for n in place)
                lists = zip(*(coordinates(piece[n]) for n in parts))
                out = [mesh_record(tile_box(tx, ty, lod), dict(zip(parts, own))) for lod, tx, ty, own in zip(lods, txs, tys, lists)]
                yield pa.RecordBatch.from_arrays([*piece.select(place).columns, pa.array(out, pa.binary())], names=[*place, "data"])

    bounded_batches(tiles.sparkSession)
    rows = tiles.select(F.col("lod").cast("int"), F.col("tx").cast("bigint"), F.col("ty").cast("bigint"), *parts)
    return rows.mapInArrow(pack, "lod int, tx bigint, ty bigint, data binary")


def append_points(points: DataFrame, path: str, keys: list[str] = ["tx", "ty"], block: int = 3) -> None:  # noqa: B006
    """Add points (lod, ``keys`` and any other columns) to a layer. Files lie by lod and by blocks
    of 2^block cells a side; crowded blocks are split into several files and small ones share a
    task. A failed run leaves nothing behind, a repeated one adds its points again: keep a ledger."""
    blocks = [f"block_{k}" for k in keys]
    rows = points.withColumns({b: F.shiftright(k, block) for b, k in zip(blocks, keys)})
    rows.hint("rebalance", "lod", *blocks).write.mode("append").partitionBy("lod", *blocks).parquet(path)


def layer_points(spark: SparkSession, path: str, lod: int, box: dict[str, tuple[int, int]], block: int = 3) -> DataFrame:
    """Points of a layer within inclusive ranges of its keys; only their blocks are listed and read."""
    rows = spark.read.parquet(path).where(F.col("lod") == lod)
    for k, (low, high) in box.items():
        rows = rows.where(F.col(f"block_{k}").between(low >> block, high >> block) & F.col(k).between(low, high))
    return rows.drop(*[c for c in rows.columns if c.startswith("block_")])
