import json
import math

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from quadmill.operators import mesh
from quadmill.operators.mesh import Delaunay, build, cut, in_circle, mesh_json, orient, reduce, thin, tile_box, triangulate

place = st.tuples(st.integers(0, 12), st.integers(0, 12), st.integers(0, 50))


def made(points):
    mesh = Delaunay(0, 0, 12, 12)
    for x, y, z in points:
        mesh.insert(float(x), float(y), float(z))
    return mesh


@settings(max_examples=40, deadline=None)
@given(st.lists(place, min_size=4, max_size=40, unique_by=lambda p: p[:2]))
def test_circles_are_empty(points):
    mesh = made(points)
    P = mesh.points
    tri = mesh.triangles()
    for a, b, c in tri:
        assert orient(P[a], P[b], P[c]) > 0
        assert all(in_circle(P[a], P[b], P[c], P[d]) <= 0 for d in range(3, len(P)) if d not in (a, b, c))


def test_exact_predicates():
    assert orient((0.1, 0.1), (0.3, 0.3), (0.7, 0.7)) == (0.7 - 0.7)
    assert in_circle((0, 0), (1, 0), (1, 1), (0, 1)) == 0


def test_grid_has_all_triangles_and_reduces():
    mesh = made([(x, y, 5 if (x, y) == (4, 4) else 0) for x in range(9) for y in range(9)])
    assert len(mesh.triangles()) == 2 * 81 - 2 - 32
    fixed = {v for v in range(3, len(mesh.points)) if mesh.points[v][0] in (0, 8) or mesh.points[v][1] in (0, 8)}
    assert reduce(mesh, fixed, 34) == 34
    alive = {v for t in mesh.triangles() for v in t}
    assert any(mesh.points[v][:2] == (4, 4) for v in alive)  # the peak stays
    assert fixed <= alive


def test_neighbours_share_borders():
    pts = [(x + 0.1 * math.sin(y), y + 0.1 * math.cos(x), (x * 7 + y * 3) % 11) for x in range(13) for y in range(13)]
    mesh = made(pts)
    west, east = cut(mesh, 2, 4, 6, 8), cut(mesh, 6, 4, 10, 8)
    assert west["east"] == east["west"] and west["east"]
    assert west["corners"][1] == east["corners"][0]
    tile, fixed = build(west, 2, 4, 6, 8)
    n = reduce(tile, fixed, 20)
    out = json.loads(mesh_json(tile, 2, 4, 6, 8))
    assert len(out["Vertices"]) % 5 == 0 and max(out["Indices"]) < len(out["Vertices"]) // 5 and out["CurtainIndex"] == n


def test_thinning():
    assert [p[0] for p in thin([(5, 0, 0), (0, 0, 0), (1, 0, 0), (2.5, 0, 0)], 0, 2)] == [0, 2.5, 5]


def test_all_points_of_a_dense_tile_count(spark):
    """A peak in the east of a tile with more than 4 * max_points points stays."""
    x0, y0, x1, y1 = tile_box(3, 3, 3)
    at = [(x0 + (x1 - x0) * (i + 0.5) / 20, y0 + (y1 - y0) * (j + 0.5) / 20, 50.0 if (i, j) == (17, 10) else 0.0) for i in range(20) for j in range(20)]
    rows = spark.createDataFrame([(*p, 3, 3) for p in at], "x double, y double, elevation double, tx int, ty int")
    (tile,) = triangulate(rows, 3, 64).collect()
    assert any(p.z == 50.0 for p in tile.middle) and tile.n_points <= 64


def test_surface_follows_all_points(spark):
    """Dense tiles at sf0.1's density: the surface is near the points across the whole tile, and
    neighbours that saw a margin alone agree where they meet."""
    rng = np.random.default_rng(3)
    x, y = rng.uniform(-1, 1, 24_000), rng.uniform(-1, 1, 24_000)
    z = 50 * np.sin(3 * x) + 40 * np.cos(4 * y)
    side = 2.0 / 4
    rows = pd.DataFrame({"x": x, "y": y, "elevation": z, "tx": ((x + 1) / side).astype(int), "ty": ((1 - y) / side).astype(int)})
    tiles = {(r.tx, r.ty): r for r in mesh.triangulate(spark.createDataFrame(rows), 2, 128, (0, 0, 3, 3)).collect()}
    assert set(tiles) == {(i, j) for i in (1, 2) for j in (1, 2)}
    for (tx, ty), r in tiles.items():
        box = mesh.tile_box(tx, ty, 2)
        parts = {k: [tuple(p) for p in getattr(r, k)] for k in ("corners", "north", "east", "south", "west", "middle")}
        surface, _ = mesh.build(parts, *box)
        own = rows[(rows.tx == tx) & (rows.ty == ty)]
        off = [abs(surface.height(a, b) - c) for a, b, c in own[["x", "y", "elevation"]].itertuples(index=False) if surface.height(a, b) is not None]
        assert len(off) > 0.95 * len(own) and np.mean(off) < 1 and max(off) < 8
        xs = np.array([p[0] for p in parts["middle"]])
        assert xs.max() - xs.min() > 0.8 * (box[2] - box[0])
    near = lambda a, b: all(min(np.abs(np.array(p) - np.array(q)).max() for q in b) < 1e-6 for p in a)
    assert near(tiles[1, 1].east, tiles[2, 1].west) and near(tiles[1, 1].south, tiles[1, 2].north)
