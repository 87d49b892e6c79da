"""Binary tiles of fixed records: voxels of colored points, and parts of meshes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed layout of a point in a voxel file: 31 bytes.
VOXEL = np.dtype([("x", "<f8"), ("y", "<f8"), ("elevation", "<f8"), ("r", "u1"), ("g", "u1"), ("b", "u1"), ("intensity", "<i4")])
VOXEL_PATH = r"(\d+)/(\d+)/(\d+)-(\d+)\.dat$"
#: Lists of a mesh file, in their order there.
LISTS = ("north", "east", "south", "west", "middle")
PARTS = ", ".join(f"{p} array<struct<x:double,y:double,z:double>>" for p in ("corners", *LISTS))
#: Bytes of mesh files that a Python worker converts at once, and of the batches that it gets.
PIECE = 1 << 22


def voxel_files(spark: SparkSession, path: str) -> DataFrame:
    """lod, i, j, k, data of files {lod}/{i}/{j}-{k}.dat."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.dat").load(path)
    part = lambda k, t: F.regexp_extract("path", VOXEL_PATH, k).try_cast(t)
    return files.select(part(1, "int").alias("lod"), *[part(n + 2, "bigint").alias(c) for n, c in enumerate("ijk")], F.col("content").alias("data")).dropna()


def voxel_points(files: DataFrame) -> DataFrame:
    """Points of voxels (lod, i, j, k, data); a record that was cut off is dropped."""

    def read(batches):
        for batch in batches:
            for lod, i, j, k, data in zip(*(batch[n] for n in ("lod", "i", "j", "k", "data"))):
                rows = np.frombuffer(data, VOXEL, len(data) // VOXEL.itemsize)
                yield pd.DataFrame({n: rows[n] for n in VOXEL.names}).assign(lod=lod, i=i, j=j, k=k)

    schema = "lod int, i bigint, j bigint, k bigint, x double, y double, elevation double, r int, g int, b int, intensity int"
    return files.select("lod", "i", "j", "k", "data").mapInPandas(read, schema)


def mesh_parts(data: bytes) -> tuple[tuple[float, ...], dict[str, np.ndarray]] | None:
    """The box and the parts (rows x, y, elevation, weight) of a mesh file; None if it is cut off."""
    if len(data) < 160:
        return None
    numbers = np.frombuffer(data, "<f8", 20)
    parts, at = {"corners": numbers[4:].reshape(4, 4)}, 160
    for name in LISTS:
        n = int.from_bytes(data[at : at + 4], "little", signed=True)
        if len(data) < at + 4 or n < 0 or len(data) < at + 4 + 32 * n:
            return None
        parts[name] = np.frombuffer(data, "<f8", 4 * n, at + 4).reshape(n, 4)
        at += 4 + 32 * n
    return tuple(numbers[:4].tolist()), parts


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's limit of an Arrow batch to PIECE bytes (and a row): several batches of
    64 MB, which is Spark's limit, would lie in an executor and its workers at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", PIECE)


def pieces(sizes: Iterable[int], most: int = PIECE) -> Iterator[tuple[int, int]]:
    """First row and number of rows of pieces of at most ``most`` bytes; a larger row is one alone."""
    first = n = held = 0
    for size in sizes:
        if n and held + size > most:
            yield first, n
            first, n, held = first + n, 0, 0
        n, held = n + 1, held + size
    if n:
        yield first, n


def point_lists(parts: list[np.ndarray]) -> pa.ListArray:
    """A list of points for each array of rows; NaN is null, as mesh_records writes null."""
    rows = np.concatenate([np.empty((0, 4)), *parts])
    points = pa.StructArray.from_arrays([pa.array(rows[:, k].copy(), from_pandas=True) for k in range(3)], names=list("xyz"))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), points)


def mesh_tiles(files: DataFrame) -> DataFrame:
    """lod, tx, ty and the parts of mesh files (lod, tx, ty, data), as elevation_level takes
    them; a file that is cut off gives no row. Points stay in Arrow's columns."""
    place, parts = ["lod", "tx", "ty"], ["corners", *LISTS]

    def read(batches):
        for batch in batches:
            for first, n in pieces(pc.binary_length(batch["data"]).to_pylist()):
                piece = batch.slice(first, n)
                found = [mesh_parts(data) for data in piece["data"].to_pylist()]
                whole = piece.select(place).filter(pa.array([f is not None for f in found]))
                lists = [point_lists([f[1][name] for f in found if f]) for name in parts]
                yield pa.RecordBatch.from_arrays([*whole.columns, *lists], names=[*place, *parts])

    bounded_batches(files.sparkSession)
    rows = files.select(F.col("lod").cast("int"), F.col("tx").cast("bigint"), F.col("ty").cast("bigint"), "data")
    return rows.mapInArrow(read, f"lod int, tx bigint, ty bigint, {PARTS}")
