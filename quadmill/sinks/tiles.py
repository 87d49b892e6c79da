"""Tile files and archives. Writers run on executors, a partition at a time, and put
files below a path that all of them see; a retry writes the same bytes again."""

from __future__ import annotations

import io
import os
import struct
import tarfile
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def png(rgba: bytes, width: int, height: int) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = np.frombuffer(rgba, np.uint8).reshape(height, width * 4)
    raw = np.hstack([np.zeros((height, 1), np.uint8), rows]).tobytes()
    head = struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def ppm(rgba: bytes, width: int, height: int) -> bytes:
    return f"P6\n{width} {height}\n255\n".encode() + np.frombuffer(rgba, np.uint8).reshape(-1, 4)[:, :3].tobytes()


def raw32(values) -> bytes:
    return np.asarray(values, "<f4").tobytes()


def point_records(points) -> bytes:
    """Rows x, y, elevation, weight as records of a point tile."""
    return np.asarray(points, "<f8").reshape(-1, 4).tobytes()


def png_column(rgba: str, size: int = 256) -> Column:
    @F.pandas_udf("binary")
    def encode(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: png(b, size, size))

    return encode(F.col(rgba))


def unpacked(packed: DataFrame) -> DataFrame:
    """lod, tx, ty, data of the files of archives (data)."""

    def read(batches):
        for batch in batches:
            for blob in batch["data"]:
                with tarfile.open(fileobj=io.BytesIO(blob)) as tar:
                    for info in tar:
                        lod, tx, ty = info.name.partition(".")[0].split("/")
                        yield pd.DataFrame({"lod": [int(lod)], "tx": [int(tx)], "ty": [int(ty)], "data": [tar.extractfile(info).read()]})

    return packed.select("data").mapInPandas(read, "lod int, tx bigint, ty bigint, data binary")


def write_files(tiles: DataFrame, base: str, extension: str, data: str = "data") -> None:
    """{base}/{lod}/{x}/{y}{extension} for rows lod, tx, ty, data."""

    def write(rows) -> None:
        for r in rows:
            folder = f"{base}/{r['lod']}/{r['tx']}"
            os.makedirs(folder, exist_ok=True)
            part = f"{folder}/.{r['ty']}.{os.getpid()}"
            with open(part, "wb") as f:
                f.write(bytes(r[data]))
            os.replace(part, f"{folder}/{r['ty']}{extension}")

    tiles.select("lod", "tx", "ty", data).foreachPartition(write)


def archives(tiles: DataFrame, extension: str, n: int, data: str = "data") -> DataFrame:
    """(archive, data): ``n`` ustar archives of tiles, dealt out by key."""
    key = F.pmod(F.xxhash64("lod", "tx", "ty"), F.lit(n)).alias("archive")

    def pack(pieces):
        for rows in pieces:
            out = io.BytesIO()
            with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as tar:
                for r in rows.sort_values(["lod", "tx", "ty"]).itertuples():
                    info = tarfile.TarInfo(f"{r.lod}/{r.tx}/{r.ty}{extension}")
                    blob = bytes(getattr(r, data))
                    info.size, info.mode = len(blob), 0o644
                    tar.addfile(info, io.BytesIO(blob))
            yield pd.DataFrame({"archive": [int(rows["archive"].iloc[0])], "data": [out.getvalue()]})

    rows = tiles.select(key, "lod", "tx", "ty", data)
    return rows.groupBy("archive").applyInPandas(lambda g: next(pack([g])), "archive bigint, data binary")
