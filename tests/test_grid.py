"""Published results of the coordinate model, and round trips."""

import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quadmill.functions import grid

IMAGE = (-117.1613064234173, 50.25377317536166, -116.0036274154166, 51.00368256032537)


def quadkey(x, y, lod):
    return "".join(str((x >> b & 1) + 2 * (y >> b & 1)) for b in range(lod - 1, -1, -1))


def test_published_extents():
    assert grid.box_tiles_py(7.6, 45.0, 8.1, 46.1, 15) == (17075, 11644, 17121, 11787)
    assert grid.box_tiles_py(*IMAGE, 16) == (11439, 21938, 11650, 22154)
    dem = (-117.1612355761003, 50.25308139584989, -116.0025682999319, 51.00363702834048)
    assert grid.box_tiles_py(*dem, 22) == (732124, 1404091, 745624, 1417876)


@pytest.mark.parametrize("size, elevation, image", [(9.882724674077332, 17, 13), (39.53005418648766, 15, 11)])
def test_published_recommendations(size, elevation, image):
    assert grid.recommend_lod(size, IMAGE[1], IMAGE[3], "elevation") == elevation
    assert grid.recommend_lod(size, IMAGE[1], IMAGE[3], "image") == image


def test_columns_agree_with_constants(spark):
    row = spark.createDataFrame([IMAGE], "a double, b double, c double, d double")
    got = row.select(*[v.alias(n) for v, n in zip(grid.box_tiles("a", "b", "c", "d", 16), "wxyz")]).first()
    assert tuple(got) == (11439, 21938, 11650, 22154)
    keys = spark.createDataFrame([(11439, 21938), (11650, 22154)], "x bigint, y bigint").select(grid.quadkey("x", "y", 16).alias("k"))
    assert [r.k for r in keys.collect()] == ["0212130230321131", "0212132130002030"]
    back = keys.select(grid.quadkey_x("k").alias("x"), grid.quadkey_y("k").alias("y")).collect()
    assert [tuple(r) for r in back] == [(11439, 21938), (11650, 22154)]


def test_latitude_bound():
    assert math.isclose(grid.MAX_LATITUDE, 85.0511287798066, rel_tol=1e-12)


@given(st.integers(1, 10), st.data())
def test_quadkey_ranges_cover(lod, data):
    n = (1 << lod) - 1
    x0, x1 = sorted((data.draw(st.integers(0, n)), data.draw(st.integers(0, n))))
    y0, y1 = sorted((data.draw(st.integers(0, n)), data.draw(st.integers(0, n))))
    ranges = grid.quadkey_ranges(x0, y0, x1, y1, lod)
    for x in (x0, x1, (x0 + x1) // 2):
        for y in (y0, y1, (y0 + y1) // 2):
            assert any(a <= quadkey(x, y, lod) <= b for a, b in ranges)


def test_ranges_reach_the_scan(spark, tmp_path):
    df = spark.range(4096).select(grid.quadkey(F.col("id") % 64, F.floor(F.col("id") / 64).cast("bigint"), 6).alias("k"))
    df.write.parquet(str(tmp_path / "t"))
    hit = spark.read.parquet(str(tmp_path / "t")).where(grid.in_extent("k", 3, 5, 9, 8, 6))
    assert hit.count() == 7 * 4
    assert "GreaterThanOrEqual(k" in hit._jdf.queryExecution().toString()


def test_poles_and_nulls(spark):
    """Beyond the map's latitudes points fall into its first and last row; null stays null."""
    rows = [(0, 0.0, 90.0), (1, 0.0, -90.0), (2, 0.0, -91.0), (3, 0.0, 85.06), (4, None, 10.0), (5, 10.0, None), (6, 0.0, 0.0)]
    df = grid.with_tiles(spark.createDataFrame(rows, "id int, lng double, lat double"), 3)
    got = {r.id: (r.px, r.py, r.ty) for r in df.collect()}
    assert got[0][1:] == got[3][1:] == (0, 0) and got[1][1:] == got[2][1:] == (2047, 7)
    assert got[4][0] is None and got[4][1] is not None and got[5][1:] == (None, None)
    metres = {r.id: r.m for r in df.select("id", grid.ground_resolution("lat", 3).alias("m")).collect()}
    assert metres[0] == metres[1] == metres[2] and 0 < metres[0] < metres[6] and metres[5] is None
    assert grid.box_tiles_py(-180, -90, 180, 90, 3) == (0, 0, 7, 7)
