"""Raster sources: tile files, raw float grids, ASCII grids, images."""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file in which its header is looked for.
HEADER = 1 << 16
TILE_PATH = r"(\d+)/(-?\d+)/(-?\d+)\.[A-Za-z0-9]+$"


def tile_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """lod, tx, ty, data of files {lod}/{x}/{y}.ext."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    part = lambda k, t: F.regexp_extract("path", TILE_PATH, k).try_cast(t)
    return files.select(part(1, "int").alias("lod"), part(2, "bigint").alias("tx"), part(3, "bigint").alias("ty"), F.col("content").alias("data")).dropna()


def raw_cells(tiles: DataFrame, size: int = 256, nodata: float = -9999.0) -> DataFrame:
    """Cells (lod, px, py, v) of little-endian float32 tiles; nodata cells are absent."""

    def read(batches):
        for batch in batches:
            for lod, x, y, data in zip(batch["lod"], batch["tx"], batch["ty"], batch["data"]):
                grid = np.frombuffer(data, "<f4").reshape(size, size)
                j, i = np.nonzero(grid != nodata)
                yield pd.DataFrame({"lod": np.full(len(i), lod, np.int32), "px": x * size + i, "py": y * size + j, "v": grid[j, i]})

    return tiles.mapInPandas(read, "lod int, px bigint, py bigint, v float")


def point_tiles(tiles: DataFrame) -> DataFrame:
    """Points (lod, tx, ty, x, y, elevation, weight) of tiles of records of four little-endian
    doubles; what is left of a record that was cut off is dropped."""

    def read(batches):
        for batch in batches:
            for lod, tx, ty, data in zip(batch["lod"], batch["tx"], batch["ty"], batch["data"]):
                rows = np.frombuffer(data, "<f8", len(data) // 32 * 4).reshape(-1, 4)
                yield pd.DataFrame(rows, columns=["x", "y", "elevation", "weight"]).assign(lod=lod, tx=tx, ty=ty)

    return tiles.select("lod", "tx", "ty", "data").mapInPandas(read, "lod int, tx bigint, ty bigint, x double, y double, elevation double, weight double")


def ascii_grids(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Cells (file, px, py, x, y, v) of ESRI ASCII grids, rows from the top; bad files give none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")

    def read(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    words = bytes(content).decode("ascii").split()
                    head, at = {}, 0
                    while at < len(words) and words[at][0].isalpha():
                        head[words[at].lower()] = float(words[at + 1])
                        at += 2
                    n, m, size = int(head["ncols"]), int(head["nrows"]), head["cellsize"]
                    grid = np.array(words[at : at + n * m], dtype=float).reshape(m, n)
                except (KeyError, ValueError, IndexError):
                    continue
                j, i = np.nonzero(grid != head.get("nodata_value", -9999.0))
                left, bottom = head.get("xllcorner", 0.0), head.get("yllcorner", 0.0)
                yield pd.DataFrame({"file": name, "px": i, "py": j, "x": left + (i + 0.5) * size, "y": bottom + (m - j - 0.5) * size, "v": grid[j, i]})

    return files.mapInPandas(read, "file string, px bigint, py bigint, x double, y double, v double")


def images(spark: SparkSession, path: str) -> DataFrame:
    """file, width, height, rgba of PNG and JPEG files; channels are brought into order."""
    rows = spark.read.format("image").option("dropInvalid", "true").load(path).select("image.*")

    def order(batches):
        for batch in batches:
            out = []
            for w, h, n, data in zip(batch["width"], batch["height"], batch["nChannels"], batch["data"]):
                a = np.frombuffer(data, np.uint8).reshape(h * w, n)
                rgb = a[:, [2, 1, 0]] if n >= 3 else np.repeat(a[:, :1], 3, axis=1)
                alpha = a[:, 3:4] if n == 4 else np.full((h * w, 1), 255, np.uint8)
                out.append(np.hstack([rgb, alpha]).astype(np.uint8).tobytes())
            yield pd.DataFrame({"file": batch["origin"], "width": batch["width"], "height": batch["height"], "rgba": out})

    return rows.mapInPandas(order, "file string, width int, height int, rgba binary")


def png_pixels(content: bytes) -> tuple[int, int, bytes]:
    """Width, height and RGBA of an 8-bit PNG that isn't interlaced; all filters of rows."""
    width, height = struct.unpack(">II", content[16:24])
    bands = {0: 1, 2: 3, 4: 2, 6: 4}[content[25]]
    at, data = 8, b""
    while at < len(content):
        size = int.from_bytes(content[at : at + 4], "big")
        if content[at + 4 : at + 8] == b"IDAT":
            data += content[at + 8 : at + 8 + size]
        at += size + 12
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, width * bands + 1)
    rows, above = np.zeros((height, width, bands), np.uint8), np.zeros((width, bands), np.int64)
    for y in range(height):
        kind, line = int(raw[y, 0]), raw[y, 1:].reshape(width, bands).astype(np.int64)
        if kind == 1:
            line = np.cumsum(line, axis=0)
        elif kind == 2:
            line = line + above
        elif kind > 2:
            left, corner = np.zeros(bands, np.int64), np.zeros(bands, np.int64)
            for x in range(width):
                up = above[x]
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                line[x] = (line[x] + guess) & 255
                left, corner = line[x], up
        above = line & 255
        rows[y] = above
    order = {1: "G", 2: "GA", 3: "RGB", 4: "RGBA"}[bands]
    return width, height, rows.tobytes() if bands == 4 else converted(rows.tobytes(), order, "RGBA") if bands == 3 else grey_pixels(rows)


def grey_pixels(rows: np.ndarray) -> bytes:
    grey = rows.reshape(-1, rows.shape[2])
    alpha = grey[:, 1:] if grey.shape[1] == 2 else np.full((len(grey), 1), 255, np.uint8)
    return np.hstack([np.repeat(grey[:, :1], 3, axis=1), alpha]).astype(np.uint8).tobytes()


def png_tiles(files: DataFrame) -> DataFrame:
    """lod, tx, ty, rgba of PNG files (lod, tx, ty, data)."""

    def read(batches):
        for batch in batches:
            yield batch[["lod", "tx", "ty"]].assign(rgba=[png_pixels(bytes(d))[2] for d in batch["data"]])

    return files.select("lod", "tx", "ty", "data").mapInPandas(read, "lod int, tx bigint, ty bigint, rgba binary")


def converted(pixels: bytes, source: str, target: str) -> bytes:
    """Pixels with their channels in another order, such as BGR to RGBA; a new A is 255."""
    a = np.frombuffer(pixels, np.uint8).reshape(-1, len(source))
    full = np.full(len(a), 255, np.uint8)
    return np.column_stack([a[:, source.index(c)] if c in source else full for c in target]).tobytes()


def described(content: bytes) -> tuple[int, int, int] | None:
    """Width, height and bands from the header of a PNG, JPEG or ASCII grid; None if it has none."""
    if content[:8] == b"\x89PNG\r\n\x1a\n" and len(content) >= 26:
        width, height = struct.unpack(">II", content[16:24])
        return width, height, {0: 1, 2: 3, 3: 3, 4: 2, 6: 4}.get(content[25], 0)
    if content[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(content) and content[at] == 0xFF:
            if 0xC0 <= content[at + 1] <= 0xCF and content[at + 1] not in (0xC4, 0xC8, 0xCC):
                height, width, bands = struct.unpack(">HHB", content[at + 5 : at + 10])
                return width, height, bands
            at += 2 + int.from_bytes(content[at + 2 : at + 4], "big")
        return None
    head = dict(re.findall(rb"(?im)^\s*(ncols|nrows)\s+(\d+)\s*$", content[:1000]))
    head = {k.lower(): int(v) for k, v in head.items()}
    return (head[b"ncols"], head[b"nrows"], 1) if len(head) == 2 else None


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """file, width, height, bands, good of raster files; a file that can't be read isn't good."""
    files = spark.read.format("binaryFile").load(path).select("path", F.substring("content", 1, HEADER).alias("head"))

    def read(batches):
        for batch in batches:
            found = [described(bytes(h)) for h in batch["head"]]
            size = np.array([f or (0, 0, 0) for f in found]).reshape(-1, 3)
            yield pd.DataFrame({"file": batch["path"], "width": size[:, 0], "height": size[:, 1], "bands": size[:, 2], "good": [f is not None for f in found]})

    return files.mapInPandas(read, "file string, width int, height int, bands int, good boolean")


def world_files(spark: SparkSession, path: str) -> DataFrame:
    """file (without extension) and affine, six numbers in the order of grid.affine_apply:
    origin x, step x, shear x, origin y, shear y, step y. Files state the centre of the first
    pixel; the origin is its corner."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\s+").alias("w")).where("size(w) = 6")
    n = [F.element_at("w", k).try_cast("double") for k in range(1, 7)]
    corner = [n[4] - n[0] / 2 - n[2] / 2, n[0], n[2], n[5] - n[1] / 2 - n[3] / 2, n[1], n[3]]
    return text.select(F.regexp_replace("file", r"\.[^./]*$", "").alias("file"), F.array(*corner).alias("affine")).where("not exists(affine, x -> x is null)")
