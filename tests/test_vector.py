import io
import math
import xml.etree.ElementTree as xml

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadmill.functions import crs, linear
from quadmill.operators import vector
from quadmill.sinks import jpeg, tiles
from quadmill.sources import raster as source


def picture(width, height):
    y, x = np.mgrid[:height, :width]
    out = np.stack([x * 255 // width, y * 255 // height, (np.sin(x / 5) * np.cos(y / 7) * 100 + 128).astype(int), np.full_like(x, 255)], axis=2)
    return out.astype(np.uint8)


@pytest.mark.parametrize("size", [(16, 16), (40, 24), (33, 19), (1, 1)])
def test_jpeg_is_read_by_others(spark, tmp_path, size):
    want = picture(*size)
    for quality in (100, 80, 5):
        folder = tmp_path / str(quality)
        folder.mkdir()
        (folder / "a.jpg").write_bytes(jpeg.jpeg(want.tobytes(), *size, quality))
        r = source.images(spark, str(folder)).first()
        assert (r.width, r.height) == size
        got = np.frombuffer(bytes(r.rgba), np.uint8).reshape(want.shape).astype(float)
        assert np.abs(got - want).mean() < {100: 2, 80: 6, 5: 40}[quality]


def test_jpeg_of_noise_and_of_one_color(spark, tmp_path):
    noise = np.random.default_rng(1).integers(0, 256, (64, 64, 4), dtype=np.uint8)
    for k, blob in enumerate((noise, np.full((64, 64, 4), 77, np.uint8))):
        (tmp_path / f"{k}.jpg").write_bytes(jpeg.jpeg(blob.tobytes(), 64, 64, 100))
    got = {r.file[-5]: np.frombuffer(bytes(r.rgba), np.uint8).reshape(64, 64, 4)[:, :, :3].astype(int) for r in source.images(spark, str(tmp_path)).collect()}
    assert np.abs(got["0"] - noise[:, :, :3]).mean() < 3 and np.abs(got["1"] - 77).max() <= 1


def test_code_lengths_are_bounded():
    counts = np.zeros(256, np.int64)
    counts[:40] = np.cumprod([1] + [2] * 39, dtype=np.int64)
    depth = jpeg.code_lengths(counts)
    assert max(depth.values()) <= 16 and sum(2.0**-d for d in depth.values()) <= 1


def test_utm(spark):
    rows = [(9.0, 45.0), (9.0, 0.0), (6.5, 61.25), (11.9, -33.1)]
    df = spark.createDataFrame(rows, "lng double, lat double")
    got = df.select(*crs.transform("lng", "lat", 4326, 32632)).collect()
    assert got[0][0] == pytest.approx(500000, abs=1e-6) and got[0][1] == pytest.approx(4982950.4002, abs=1e-3)
    assert got[1][1] == pytest.approx(0, abs=1e-6)
    for target in (32632, 32732, 3857, 3395, 4326):
        x, y = crs.transform("lng", "lat", 4326, target)
        for r in df.select("lng", "lat", x.alias("x"), y.alias("y")).select("lng", "lat", *crs.transform("x", "y", target, 4326)).collect():
            assert r[2] == pytest.approx(r[0], abs=1e-9) and r[3] == pytest.approx(r[1], abs=1e-9)
    assert (crs.utm_of(9, 45), crs.utm_of(180, -1), crs.utm_zone(32661)) == (32632, 32760, None)
    with pytest.raises(ValueError):
        crs.transform("lng", "lat", 4326, 2056)


def test_linear(spark):
    m = linear.view((3, 4, 5), (0, 0, 0), (0, 0, 1))
    one = spark.range(1).select(*linear.applied(m, [F.lit(0.0)] * 3), *linear.cross([F.lit(1.0), F.lit(0.0), F.lit(0.0)], [F.lit(0.0), F.lit(1.0), F.lit(0.0)])).first()
    assert tuple(one) == pytest.approx((0, 0, -math.sqrt(50), 0, 0, 1))
    assert np.allclose(linear.rotation("z", 90) @ [1, 0, 0, 1], [0, 1, 0, 1])


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0)):
            if (ay <= y) != (by <= y) and x >= ax + (y - ay) * (bx - ax) / (by - ay):
                odd = not odd
    return odd


def test_fill_and_stroke_match_each_pixel():
    rng = np.random.default_rng(5)
    for _ in range(8):
        rings = [rng.uniform(-8, 32, (rng.integers(3, 8), 2)) for _ in range(2)]
        got = vector.covered(rings, 24, 20)
        assert got.tolist() == [[inside(rings, i + 0.5, j + 0.5) for i in range(24)] for j in range(20)]
        line = vector.stroked(rings[:1], 3.0, 24, 20)
        for j in range(20):
            for i in range(24):
                near = []
                for a, b in zip(rings[0][:-1], rings[0][1:]):
                    t = np.clip(np.dot([i + 0.5 - a[0], j + 0.5 - a[1]], b - a) / np.dot(b - a, b - a), 0, 1)
                    near.append(np.hypot(*(a + t * (b - a) - [i + 0.5, j + 0.5])))
                assert line[j, i] == (min(near) <= 1.5)


def box(w, s, e, n):
    return [[(w, s), (e, s), (e, n), (w, n), (w, s)]]


def test_tiles_join_without_seams(spark):
    features = spark.createDataFrame([(1, 5, box(-100.0, -50.0, 80.0, 60.0)), (2, 6, box(-10.0, -10.0, 30.0, 20.0))], f"feature int, class int, rings array<array<{vector.POINT}>>")
    rules = [{"filter": "[class] = 5", "fill": (255, 0, 0, 255)}, {"filter": "[class] = 6", "fill": (0, 0, 255, 128), "stroke": (0, 0, 0, 255), "width": 2}, {"filter": "[class] = 9", "fill": (9, 9, 9, 255)}]
    out = np.zeros((512, 512, 4), np.uint8)
    for r in vector.render_tiles(features, rules, range(2, 3), 128).collect():
        out[r.ty * 128 : r.ty * 128 + 128, r.tx * 128 : r.tx * 128 + 128] = np.frombuffer(bytes(r.rgba), np.uint8).reshape(128, 128, 4)
    whole = vector.render_box(features, rules, (-180.0, -85.0511287798066, 180.0, 85.0511287798066), 512, 512, 2).collect()
    assert len(whole) == 1
    assert np.abs(out.astype(int) - np.frombuffer(bytes(whole[0].rgba), np.uint8).reshape(512, 512, 4)).max() == 0
    assert tuple(out[256, 150]) == (255, 0, 0, 255) and tuple(out[250, 260]) == (127, 0, 128, 255) and tuple(out[0, 0]) == (0, 0, 0, 0)


def test_style_xml():
    style = {
        "srs": "+proj=merc", "bgcolor": "white", "zooms": [1000, 500, 200, 100],
        "layers": [{"name": "a", "srs": "x", "status": "on", "styleId": "s", "type": "db", "params": {"dbtype": "postgis", "dbname": "d"}}],
        "styles": [{"name": "s", "rules": [{"filter": "[n] < 3", "maxzoom": 1, "minzoom": 2, "symbolizers": [{"type": "line", "params": {"stroke": "grey"}}, {"type": "text", "params": {"name": "N"}}]}]}],
    }
    root = xml.parse(io.StringIO(vector.style_xml(style))).getroot()
    rule = root.find("Style/Rule")
    assert (rule.findtext("Filter"), rule.findtext("MaxScaleDenominator"), rule.findtext("MinScaleDenominator")) == ("[n] < 3", "500", "100")
    assert rule.find("LineSymbolizer/CssParameter").attrib == {"name": "stroke"} and rule.find("TextSymbolizer").attrib == {"name": "N"}
    assert [(p.attrib["name"], p.text) for p in root.iter("Parameter")] == [("type", "postgis"), ("dbname", "d")]


def test_jpeg_tiles_in_archives(spark):
    rows = spark.createDataFrame([(1, 0, 0, bytearray(picture(16, 16).tobytes()))], "lod int, tx bigint, ty bigint, rgba binary")
    done = tiles.archives(rows.select("lod", "tx", "ty", jpeg.jpeg_column("rgba", 16).alias("data")), ".jpg", 1).collect()
    assert b"1/0/0.jpg" in bytes(done[0].data)
