"""Files of records against what was written, growing layers, logs, times and mixed folders."""

import glob

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from quadmill.functions import times
from quadmill.operators import jobs
from quadmill.operators.mesh import Delaunay
from quadmill.plans.log import logger
from quadmill.sinks import records as sink
from quadmill.sources import records as source
from quadmill.sources.elevation import elevation

CLOUD = "lod int, i bigint, j bigint, k bigint, x double, y double, elevation double, r int, g int, b int, intensity int"


def test_voxels_round_trip_through_files(spark, tmp_path):
    rows = [(4, 1, 2, 3, 0.25, 0.5, 0.125, 0, 255, 7, -1), (4, 1, 2, 3, 0.25, 0.5, 0.125, 0, 255, 7, -1), (4, 0, 15, 9, 0.1, 0.2, 0.3, 1, 2, 3, 1 << 30)]
    for r in sink.voxel_records(spark.createDataFrame(rows, CLOUD)).collect():
        folder = tmp_path / str(r.lod) / str(r.i)
        folder.mkdir(parents=True)
        (folder / f"{r.j}-{r.k}.dat").write_bytes(r.data + (b"cut" if r.i else b""))
        assert len(r.data) % 31 == 0
    assert sorted(map(tuple, source.voxel_points(source.voxel_files(spark, str(tmp_path))).collect())) == sorted(rows)


def test_mesh_files_round_trip(spark):
    rng = np.random.default_rng(3)
    parts = {n: rng.random((k, 3)).tolist() for n, k in (("corners", 4), ("north", 2), ("east", 0), ("south", 1), ("west", 3), ("middle", 40))}
    blob = sink.mesh_record((0.0, -0.5, 0.5, 0.0), parts)
    assert len(blob) == 32 + 4 * 32 + 5 * 4 + 46 * 32
    box, got = source.mesh_parts(blob)
    assert box == (0.0, -0.5, 0.5, 0.0) and all(got[n][:, :3].tolist() == parts[n] and (got[n][:, 3] == 1).all() for n in parts)
    assert all(source.mesh_parts(blob[:k]) is None for k in range(len(blob)))
    frame = spark.createDataFrame([(2, 1, 1, blob), (2, 1, 2, blob[:-1]), (2, 0, 0, b"")], "lod int, tx bigint, ty bigint, data binary")
    rows = source.mesh_tiles(frame).collect()
    assert [(r.lod, r.tx, r.ty) for r in rows] == [(2, 1, 1)] and [tuple(p) for p in rows[0].middle] == [tuple(p) for p in parts["middle"]]
    again = sink.mesh_records(source.mesh_tiles(frame)).collect()
    assert again[0].data[32:] == blob[32:]


def test_mesh_points_do_not_become_python_objects(spark, tmp_path, monkeypatch):
    def noted(f):
        def call(*args):  # local, so that it goes to the workers whole
            import sys
            import uuid

            (tmp_path / uuid.uuid4().hex).write_text(str(sys.getallocatedblocks()))
            return f(*args)

        return call

    monkeypatch.setattr(sink, "tile_box", noted(sink.tile_box))
    monkeypatch.setattr(source, "mesh_parts", noted(source.mesh_parts))
    point = "struct(cast(id * 1000 + k as double) as x, k / 8D as y, if(k = 5, null, id + 0.5D) as z)"
    others = [f"cast(array() as array<struct<x:double,y:double,z:double>>) as {n}" for n in source.LISTS[:-1]]
    tiles = spark.range(0, 500, 1, 1).selectExpr("9 as lod", "id as tx", "id % 7 as ty", "array_repeat(struct(0D as x, 0D as y, 0D as z), 4) as corners", *others, f"transform(sequence(0, 999 * int(id % 2 = 0)), k -> {point}) as middle")
    back = source.mesh_tiles(sink.mesh_records(tiles))
    of_points = lambda df: df.selectExpr("lod", "tx", "ty", "inline(middle)")
    want, got = of_points(tiles), of_points(back)
    assert got.count() == 250 * 1001 and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
    assert back.where("size(corners) = 4 and size(north) + size(east) + size(south) + size(west) = 0").count() == 500
    seen = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert len(seen) >= 1000 and max(seen) < 1_000_000  # a point made a dict and three floats at least, in either direction


def test_pieces_cover_all_rows_within_their_size():
    assert list(source.pieces([])) == []
    assert list(source.pieces([3, 3, 3, 9, 1, 0, 0], 6)) == [(0, 2), (2, 1), (3, 1), (4, 3)]
    assert list(source.pieces([0, 0], 0)) == [(0, 2)]
    assert list(source.pieces([7], 6)) == [(0, 1)]


@pytest.mark.parametrize("middle", [None, [None, (1.0, 2.0, 3.0)]])
def test_null_lists_and_points_are_not_passed_over(spark, middle):
    frame = spark.createDataFrame([(2, 1, 1, [], [], [], [], [], middle)], f"lod int, tx bigint, ty bigint, {source.PARTS}")
    with pytest.raises(PythonException):
        sink.mesh_records(frame).collect()


def test_appended_points_are_found_by_box(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = spark.range(4000).selectExpr("5 as lod", "id % 32 as tx", "(id div 32) % 32 as ty", "id as n")
    sink.append_points(rows.where("n < 2500"), path)
    sink.append_points(rows.where("n >= 2500"), path)
    sink.append_points(rows.where("false"), path)
    box = {"tx": (3, 9), "ty": (8, 20)}
    got = sink.layer_points(spark, path, 5, box)
    assert "PartitionFilters" in got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    want = rows.where("tx between 3 and 9 and ty between 8 and 20")
    assert sorted(r.n for r in got.collect()) == sorted(r.n for r in want.collect())
    assert sink.layer_points(spark, path, 4, box).count() == 0


def test_folder_of_several_formats(spark, tmp_path):
    (tmp_path / "a.xyz").write_text("1 2 3\n4 5 x\n7 8 9.5\n")
    (tmp_path / "b.asc").write_text("ncols 2\nnrows 1\nxllcorner 0\nyllcorner 0\ncellsize 1\nnodata_value -1\n5 -1\n")
    (tmp_path / "c.txt").write_text("1 1 1\n")
    assert sorted(map(tuple, elevation(spark, str(tmp_path)).collect())) == [(0.5, 0.5, 5.0), (1.0, 2.0, 3.0), (7.0, 8.0, 9.5)]


def test_table_function_gives_what_expand_gives(spark):
    jobs.register(spark)
    boxes = spark.createDataFrame([(1, 2, 3, 2), (5, 5, 4, 5), (None, 0, 1, 1)], "x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    got = spark.sql("select tx, ty from {b}, lateral tiles_of(x0, y0, x1, y1)", b=boxes).collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 2), (3, 2)]
    assert sorted(map(tuple, jobs.expand(boxes.where("x0 = 1")).select("tx", "ty").collect())) == sorted(map(tuple, got))


def test_times(spark):
    df = spark.sql("select timestamp'2024-01-31 10:00:01' as a, timestamp'2024-01-31 10:00:02.00025' as b, cast(null as timestamp) as n")
    row = df.select(times.iso("a"), times.iso("b"), times.iso("n"), times.stamp("b"), times.seconds_between("a", "b")).first()
    assert tuple(row) == ("20240131T100001", "20240131T100002.000250", None, "2024-Jan-31 10:00:02", 1.00025)
    back = df.select(times.from_iso(times.iso("a")) == F.col("a"), times.from_iso(F.lit("20240131T100002,000250")) == F.col("b"), times.from_iso(F.lit("soon")).isNull()).first()
    assert tuple(back) == (True, True, True)


def test_log_and_echo(tmp_path, capsys):
    log = logger(str(tmp_path / "logs"), "run", echo=True)
    log.info("begins")
    log.error("stops")
    logger(str(tmp_path / "logs"), "run")
    text = "".join(open(f).read() for f in glob.glob(str(tmp_path / "logs" / "run_*.log")))
    assert [line.split("] ")[1] for line in text.splitlines()] == ["INFO: begins", "ERROR: stops"]
    assert "ERROR: stops" in capsys.readouterr().out


@pytest.mark.parametrize("place, gone", [((0.5, 0.55), (0.5, 0.5)), ((0.24, 0.3), (0.25, 0.25))])
def test_nearest_vertex_is_removed(place, gone):
    mesh = Delaunay(0, 0, 1, 1)
    for p in [(0, 0), (1, 0), (0, 1), (1, 1), (0.5, 0.5), (0.25, 0.25)]:
        mesh.insert(*p, 1.0)
    v = mesh.remove_nearest(*place)
    assert mesh.points[v][:2] == gone and all(v not in t for t in mesh.triangles())
    area = sum(abs((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])) / 2 for a, b, c in ([mesh.points[i] for i in t] for t in mesh.triangles()))
    assert area == pytest.approx(1.0)
