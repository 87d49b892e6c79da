import io
import struct
import tarfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadmill.operators import pyramid, raster, terrain
from quadmill.sinks import tiles
from quadmill.sources import raster as source
from quadmill.sources.text import cloud_points, elevation_points, expire_list
from quadmill.streaming.ingest import ingest, merged


@pytest.fixture(scope="module")
def image(spark):
    rng = np.random.default_rng(3)
    rows = [(x, y, *map(int, rng.integers(0, 256, 3)), int(rng.integers(0, 3) > 0) * 255) for x in range(64) for y in range(64)]
    rows = [(x, y, *((r, g, b) if a else (0, 0, 0)), a) for x, y, r, g, b, a in rows]
    return spark.createDataFrame(rows, "px bigint, py bigint, r bigint, g bigint, b bigint, a bigint").cache()


def as_set(df):
    return {(r.px, r.py, r.r, r.g, r.b, r.a) for r in df.where("a > 0").collect()}


def test_blob_and_cell_pyramids_agree(image):
    cells = pyramid.color_level(image)
    blobs = raster.to_cells(raster.halve_blobs(raster.to_blobs(image, 16), 16), 16)
    assert as_set(cells) == as_set(blobs)


def test_fill_is_overwrite_reversed_and_idempotent(image):
    other = image.withColumn("r", 255 - F.col("r")).withColumn("a", 255 - F.col("a")).where("px < 40")
    assert as_set(raster.fill(image, other)) == as_set(raster.overwrite(other, image))
    assert as_set(raster.fill(image, image)) == as_set(image)


def test_shade_blob_equals_cells(spark):
    rng = np.random.default_rng(4)
    e = rng.integers(0, 3000, (40, 40))
    rows = [(x, y, float(e[y, x])) for x in range(40) for y in range(40) if (x, y) != (7, 9)]
    cells = spark.createDataFrame(rows, "px bigint, py bigint, v double")
    want = {(r.px, r.py): r.s for r in terrain.windows(cells).select("px", "py", terrain.hillshade(30, -30).alias("s")).collect()}
    got = {}
    for r in terrain.hillshade_tiles(cells, 30, -30, size=16).collect():
        a = np.frombuffer(r.shade, np.uint8).reshape(16, 16)
        got |= {(int(r.tx * 16 + i), int(r.ty * 16 + j)): int(a[j, i]) for j, i in zip(*np.nonzero(a))}
    assert got == want


def test_png_round_trip(spark, image, tmp_path):
    rows = raster.to_blobs(image, 16).select(F.lit(2).alias("lod"), "tx", "ty", "rgba", tiles.png_column("rgba", 16).alias("data"))
    tiles.write_files(rows, str(tmp_path), ".png")
    want = {(r.tx, r.ty): bytes(r.rgba) for r in rows.collect()}
    found = source.images(spark, f"{tmp_path}/2/*").collect()
    assert len(found) == len(want)
    for r in found:
        x, y = r.file.removesuffix(".png").split("/")[-2:]
        assert bytes(r.rgba) == want[int(x), int(y)]
    assert source.tile_files(spark, str(tmp_path), "*.png").count() == len(want)


def test_png_and_ppm_bytes():
    blob = bytes(range(16))
    data = tiles.png(blob, 2, 2)
    n = struct.unpack(">I", data[33:37])[0]
    assert zlib.decompress(data[41 : 41 + n]) == b"\0" + blob[:8] + b"\0" + blob[8:]
    assert tiles.ppm(blob, 2, 2) == b"P6\n2 2\n255\n" + bytes([0, 1, 2, 4, 5, 6, 8, 9, 10, 12, 13, 14])


def test_archives_hold_every_tile_once(image):
    rows = raster.to_blobs(image, 16).select(F.lit(2).alias("lod"), "tx", "ty", F.col("rgba").alias("data"))
    names = []
    for r in tiles.archives(rows, ".bin", 3).collect():
        names += tarfile.open(fileobj=io.BytesIO(bytes(r.data))).getnames()
    assert sorted(names) == sorted(f"2/{r.tx}/{r.ty}.bin" for r in rows.collect())


def test_raw_and_ascii(spark, tmp_path):
    grid = np.full((4, 4), -9999.0, "<f4")
    grid[1, 2] = 7.5
    t = spark.createDataFrame([(3, 1, 2, bytearray(tiles.raw32(grid)))], "lod int, tx bigint, ty bigint, data binary")
    assert [tuple(r) for r in source.raw_cells(t, 4).collect()] == [(3, 6, 9, 7.5)]
    (tmp_path / "a.asc").write_text("ncols 2\nnrows 2\nxllcorner 10\nyllcorner 20\ncellsize 5\nNODATA_value -1\n1 -1\n3 4\n")
    (tmp_path / "b.asc").write_text("ncols 2\nbroken")
    got = sorted((r.px, r.py, r.x, r.y, r.v) for r in source.ascii_grids(spark, str(tmp_path)).collect())
    assert got == [(0, 0, 12.5, 27.5, 1.0), (0, 1, 12.5, 22.5, 3.0), (1, 1, 17.5, 22.5, 4.0)]


def test_text_sources_drop_bad_lines(spark):
    text = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    cloud = cloud_points(text("1 2 3", "1,2,3,9", "1;2;3;4;5;6", "1\t2\t3\t9\t4\t5\t6", "1 2", "a b c", "")).collect()
    assert sorted((r.x, r.intensity, r.r) for r in cloud if r.intensity is None) == [(1.0, None, 4), (1.0, None, 255)]
    assert sorted((r.intensity, r.b) for r in cloud if r.intensity is not None) == [(9, 6), (9, 255)]
    assert elevation_points(text("1 2 3", "1 2", "x 1 2"), 3).count() == 1
    assert [tuple(r) for r in expire_list(text("3/1/2", "", "3/x/1")).collect()] == [(3, 1, 2)]


def test_stream_is_idempotent(spark, tmp_path):
    schema = "px int, py int, t int, v int"
    for k in range(3):
        spark.createDataFrame([(1, 1, k, 10 + k), (2, k, k, k)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        ingest(stream, str(tmp_path / "out"), ["px", "py"], "t", "v")
    got = {(r.px, r.py): r.v for r in merged(spark, str(tmp_path / "out"), ["px", "py"], "t", "v").collect()}
    assert got == {(1, 1): 12, (2, 0): 0, (2, 1): 1, (2, 2): 2}


def test_pyramid_conserves_counts(spark):
    pts = spark.range(1000).select((F.col("id") * 7 % 256).alias("tx"), (F.col("id") * 13 % 256).alias("ty"))
    sums = pyramid.counts_all_levels(pts, 8).groupBy("lod").agg(F.sum("n").alias("n")).collect()
    assert {r.lod: r.n for r in sums} == dict.fromkeys(range(1, 9), 1000)


def test_metadata_and_world_files(spark, tmp_path):
    from quadmill.functions import grid
    from quadmill.sinks.jpeg import jpeg

    blob = bytes(range(24)) * 2
    (tmp_path / "a.png").write_bytes(tiles.png(blob, 4, 3))
    (tmp_path / "b.jpg").write_bytes(jpeg(blob, 3, 4))
    (tmp_path / "c.asc").write_text("ncols 5\nnrows 2\n")
    (tmp_path / "d.png").write_bytes(b"broken")
    got = {r.file[-5:]: tuple(r)[1:] for r in source.metadata(spark, str(tmp_path)).collect()}
    assert got == {"a.png": (4, 3, 4, True), "b.jpg": (3, 4, 3, True), "c.asc": (5, 2, 1, True), "d.png": (0, 0, 0, False)}
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.pgw").write_text("2\n0\n0\n-2\n101\n199\n")
    (tmp_path / "w" / "b.pgw").write_text("2 x")
    rows = source.world_files(spark, str(tmp_path / "w")).collect()
    assert len(rows) == 1 and rows[0].file.endswith("/w/a") and rows[0].affine == [100, 2, 0, 200, 0, -2]
    assert tuple(spark.range(1).select(*grid.affine_apply(rows[0].affine, F.lit(0.5), F.lit(0.5))).first()) == (101, 199)


def test_channel_orders():
    assert source.converted(bytes([1, 2, 3, 4, 5, 6]), "RGB", "BGRA") == bytes([3, 2, 1, 255, 6, 5, 4, 255])
    assert source.converted(bytes([1, 2, 3, 4]), "RGBA", "RGB") == bytes([1, 2, 3])


def test_png_of_any_filter_is_read():
    """Row filters 0 to 4, and grey, grey with alpha, RGB and RGBA."""
    import struct
    import zlib

    from quadmill.sources.raster import png_pixels

    rng, height, width = np.random.default_rng(4), 10, 7
    for kind, bands in ((0, 1), (4, 2), (2, 3), (6, 4)):
        image = rng.integers(0, 256, (height, width, bands), dtype=np.int64)
        raw = b""
        for y in range(height):
            f, out = y % 5, np.zeros((width, bands), np.uint8)
            for x in range(width):
                left = image[y, x - 1] if x else np.zeros(bands, int)
                up = image[y - 1, x] if y else np.zeros(bands, int)
                corner = image[y - 1, x - 1] if x and y else np.zeros(bands, int)
                p = left + up - corner
                near = [min(((abs(int(p[b]) - int(v[b])), i) for i, v in enumerate((left, up, corner))))[1] for b in range(bands)]
                paeth = np.array([(left, up, corner)[near[b]][b] for b in range(bands)])
                out[x] = (image[y, x] - (0, left, up, (left + up) // 2, paeth)[f]) & 255
            raw += bytes([f]) + out.tobytes()
        chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + b"\0\0\0\0"
        content = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)[:20]) + chunk(b"IDAT", zlib.compress(raw)[20:]) + chunk(b"IEND", b"")
        w, h, pixels = png_pixels(content)
        got = np.frombuffer(pixels, np.uint8).reshape(h, w, 4)
        alpha = image[..., -1:] if bands in (2, 4) else np.full((height, width, 1), 255)
        colour = image[..., :3] if bands >= 3 else np.repeat(image[..., :1], 3, axis=2)
        assert (w, h) == (width, height) and (got == np.concatenate([colour, alpha], axis=2)).all()


def test_a_layer_is_seen_by_other_catalogs(spark, tmp_path):
    import pytest

    from quadmill.plans.catalog import Catalog, Layer

    layer = Layer("a", "image", 3, [0.0, 0.0, 1.0, 1.0])
    Catalog(spark, str(tmp_path)).create_layer(layer)
    with pytest.raises(ValueError, match="exists"):
        Catalog(spark, str(tmp_path)).create_layer(layer)
    Catalog(spark, str(tmp_path)).create_layer(Layer("a", "image", 5, [0.0, 0.0, 1.0, 1.0]), force=True)
    assert [r.maxlod for r in Catalog(spark, str(tmp_path)).layers().collect()] == [5]


def test_point_tiles_round_trip(spark):
    """Records of points come back; an empty tile has none, and a record that was cut off is dropped."""
    points = [(0.25, -0.5, 12.5, 1.0), (0.125, 0.75, -3.0, 0.0)]
    whole = tiles.point_records(points)
    rows = [(3, 1, 2, whole), (3, 1, 3, b""), (3, 2, 2, whole[:40])]
    got = source.point_tiles(spark.createDataFrame(rows, "lod int, tx bigint, ty bigint, data binary")).collect()
    assert sorted(map(tuple, got)) == sorted([(3, 1, 2, *p) for p in points] + [(3, 2, 2, *points[0])])
