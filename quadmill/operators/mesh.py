"""Terrain meshes: Delaunay triangulation, cuts at tile borders, reduction, mesh tiles.

A triangulation lives inside one task: it covers a tile and a margin of its neighbours,
all of whose points are used. Triangles are kept as a map from each directed edge to the vertex on its left.
Signs of predicates are exact: a float filter comes first, rationals decide what is
too close to call. Points are (x, y, z) with x, y normalised Mercator.
"""

from __future__ import annotations

import heapq
import json
import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import E2
from ..functions.grid import RADIUS
from .binning import halo

SAME = 1e-12
CORNER_CLEARANCE, EDGE_SPACING = 1 / 34, 1 / 17
#: Of the neighbours, mean distances of points that a tile's triangulation reaches into them.
MARGIN_SPACINGS = 24
SKIRT = 1000.0


def orient(a, b, c) -> int:
    """1 if a, b, c turn left, -1 if right, 0 if they are collinear."""
    left, right = (b[0] - a[0]) * (c[1] - a[1]), (b[1] - a[1]) * (c[0] - a[0])
    det = left - right
    if abs(det) > 4e-16 * (abs(left) + abs(right)):
        return 1 if det > 0 else -1
    ax, ay, bx, by, cx, cy = map(Fraction, (*a[:2], *b[:2], *c[:2]))
    det = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    return (det > 0) - (det < 0)


def in_circle(a, b, c, d) -> int:
    """1 if d is inside the circle through a, b, c (counter-clockwise)."""

    def det(rows, size=None):
        (ax, ay), (bx, by), (cx, cy) = rows
        al, bl, cl = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        return al * (bx * cy - by * cx) - bl * (ax * cy - ay * cx) + cl * (ax * by - ay * bx), (al + bl + cl) ** 2

    value, size = det([(p[0] - d[0], p[1] - d[1]) for p in (a, b, c)])
    if abs(value) > 1e-14 * size:
        return 1 if value > 0 else -1
    dx, dy = Fraction(d[0]), Fraction(d[1])
    value, _ = det([(Fraction(p[0]) - dx, Fraction(p[1]) - dy) for p in (a, b, c)])
    return (value > 0) - (value < 0)


def height_in(a, b, c, x: float, y: float) -> float:
    whole = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    r = ((b[0] - x) * (c[1] - y) - (b[1] - y) * (c[0] - x)) / whole
    s = ((c[0] - x) * (a[1] - y) - (c[1] - y) * (a[0] - x)) / whole
    return r * a[2] + s * b[2] + (1 - r - s) * c[2]


class Delaunay:
    """Vertices 0 to 2 are far outside; data vertices follow."""

    def __init__(self, x0: float, y0: float, x1: float, y1: float):
        far = 1e5 * max(x1 - x0, y1 - y0, 1e-9)
        mx, my = (x0 + x1) / 2, (y0 + y1) / 2
        self.points = [(mx - far, my - far, 0.0), (mx + far, my - far, 0.0), (mx, my + far, 0.0)]
        self.left: dict[tuple[int, int], int] = {}
        self.around: dict[int, int] = {}  # a vertex on some edge from each vertex
        self._add(0, 1, 2)
        self.last = (0, 1)

    def _add(self, a: int, b: int, c: int) -> None:
        self.left[a, b] = c
        self.left[b, c] = a
        self.left[c, a] = b
        self.around[a], self.around[b], self.around[c] = b, c, a
        self.last = (a, b)

    def _drop(self, a: int, b: int, c: int) -> None:
        for e in ((a, b), (b, c), (c, a)):
            self.left.pop(e, None)

    def locate(self, p) -> tuple[int, int, int]:
        """A triangle that holds p (or has it on an edge), by walking towards it."""
        a, b = self.last if self.last in self.left else next(iter(self.left))
        if orient(self.points[a], self.points[b], p) < 0:
            a, b = b, a
        for _ in range(4 * len(self.left) + 16):
            c = self.left.get((a, b))
            if c is None:
                a, b = next(iter(self.left))
                continue
            if orient(self.points[b], self.points[c], p) < 0:
                a, b = c, b
            elif orient(self.points[c], self.points[a], p) < 0:
                a, b = a, c
            else:
                return a, b, c
        raise ValueError("point outside the triangulation")

    def insert(self, x: float, y: float, z: float) -> int:
        """Number of the vertex; of points at the same place the first counts."""
        p = (x, y, z)
        a, b, c = self.locate(p)
        for v in (a, b, c):
            if abs(self.points[v][0] - x) < SAME and abs(self.points[v][1] - y) < SAME:
                return v
        n = len(self.points)
        self.points.append(p)
        self._drop(a, b, c)
        border = [(a, b), (b, c), (c, a)]
        while border:
            u, v = border.pop()
            w = self.left.get((v, u))
            if w is not None and in_circle(self.points[v], self.points[u], self.points[w], p) > 0 or w is not None and orient(self.points[u], self.points[v], p) == 0:
                self._drop(v, u, w)
                border += [(u, w), (w, v)]
            else:
                self._add(u, v, n)
        return n

    def ring(self, v: int) -> list[int] | None:
        """Neighbours in counter-clockwise order; None if they don't close."""
        first = self.around.get(v)
        if first is None or (v, first) not in self.left:
            first = next((b for a, b in self.left if a == v), None)
            if first is None:
                return None
        out, u = [first], self.left[v, first]
        while u != first:
            out.append(u)
            u = self.left.get((v, u))
            if u is None or len(out) > len(self.points):
                return None
        return out

    def ears(self, ring: list[int]) -> list[tuple[int, int, int]]:
        """Delaunay triangles of a star-shaped ring without what is inside."""
        ring, out, P = list(ring), [], self.points
        while len(ring) > 3:
            for i in range(len(ring)):
                a, b, c = ring[i - 1], ring[i], ring[(i + 1) % len(ring)]
                if orient(P[a], P[b], P[c]) > 0 and all(in_circle(P[a], P[b], P[c], P[d]) <= 0 for d in ring if d not in (a, b, c)):
                    break
            else:
                i = next((i for i in range(len(ring)) if orient(P[ring[i - 1]], P[ring[i]], P[ring[(i + 1) % len(ring)]]) > 0), None)
                if i is None:
                    return []
                a, b, c = ring[i - 1], ring[i], ring[(i + 1) % len(ring)]
            out.append((a, b, c))
            del ring[i]
        return [*out, tuple(ring)]

    def error(self, v: int) -> float:
        """How far v is from the surface without it; infinite next to the outside."""
        ring = self.ring(v)
        if ring is None or min(ring) < 3:
            return math.inf
        x, y, z = self.points[v]
        for a, b, c in self.ears(ring):
            tri = [self.points[i] for i in (a, b, c)]
            if all(orient(tri[i - 1], tri[i], (x, y)) >= 0 for i in range(3)) and orient(*tri):
                return abs(z - height_in(*tri, x, y))
        return math.inf

    def remove(self, v: int) -> list[int]:
        """Take v away and close the hole; returns the ring."""
        ring = self.ring(v)
        ears = self.ears(ring)
        if not ears:
            return []
        for i, u in enumerate(ring):
            self._drop(v, u, ring[(i + 1) % len(ring)])
        self.around.pop(v, None)
        for t in ears:
            self._add(*t)
        return ring

    def remove_nearest(self, x: float, y: float) -> int | None:
        """Take away the nearest vertex of the triangle at a place, the lowest number at a tie;
        None if there is no such vertex."""
        near = [v for v in self.locate((x, y)) if v > 2]
        if not near:
            return None
        v = min(near, key=lambda v: (math.hypot(self.points[v][0] - x, self.points[v][1] - y), v))
        return v if self.remove(v) else None

    def triangles(self) -> list[tuple[int, int, int]]:
        """Each once, without the outside."""
        return [(a, b, c) for (a, b), c in self.left.items() if 2 < a < b and a < c]

    def height(self, x: float, y: float) -> float | None:
        a, b, c = self.locate((x, y))
        return None if min(a, b, c) < 3 else height_in(*[self.points[i] for i in (a, b, c)], x, y)


def thin(values: list[tuple], axis: int, distance: float) -> list[tuple]:
    kept: list[tuple] = []
    for v in sorted(values, key=lambda p: p[axis]):
        if not kept or v[axis] - kept[-1][axis] > distance:
            kept.append(v)
    return kept


def cut(mesh: Delaunay, x0: float, y0: float, x1: float, y1: float) -> dict[str, list[tuple]]:
    """Corners, border points and inner points of the surface within a box (y0 < y1).

    Border points are where edges cross the box; both tiles at a border see the same
    surface there, so that their meshes meet.
    """
    corners = [(x, y, mesh.height(x, y) or 0.0) for x, y in ((x0, y1), (x1, y1), (x1, y0), (x0, y0))]
    sides: dict[str, list[tuple]] = {"north": [], "east": [], "south": [], "west": []}
    for (a, b), c in mesh.left.items():
        if a > b and (b, a) in mesh.left or min(a, b) < 3:
            continue
        p, q = mesh.points[a], mesh.points[b]
        for name, axis, at in (("north", 1, y1), ("south", 1, y0), ("east", 0, x1), ("west", 0, x0)):
            if (p[axis] - at) * (q[axis] - at) < 0:
                t = (at - p[axis]) / (q[axis] - p[axis])
                other = p[1 - axis] + t * (q[1 - axis] - p[1 - axis])
                z = p[2] + t * (q[2] - p[2])
                sides[name].append((other, at, z) if axis else (at, other, z))
    for name, axis, low, high in (("north", 0, x0, x1), ("south", 0, x0, x1), ("east", 1, y0, y1), ("west", 1, y0, y1)):
        gap = (high - low) * CORNER_CLEARANCE
        sides[name] = thin([p for p in sides[name] if low + gap < p[axis] < high - gap], axis, (high - low) * EDGE_SPACING)
    middle = [p for p in mesh.points[3:] if x0 < p[0] < x1 and y0 < p[1] < y1]
    gx, gy = (x1 - x0) * CORNER_CLEARANCE, (y1 - y0) * CORNER_CLEARANCE
    middle = [p for p in middle if not any(abs(p[0] - q[0]) < gx and abs(p[1] - q[1]) < gy for q in corners)]
    if not middle:
        sides = {k: [] for k in sides}
    return {"corners": corners, **sides, "middle": middle}


def build(parts: dict[str, list[tuple]], x0: float, y0: float, x1: float, y1: float) -> tuple[Delaunay, set[int]]:
    """The tile's triangulation, and its border vertices."""
    mesh = Delaunay(x0, y0, x1, y1)
    fixed = {mesh.insert(*p) for k in ("corners", "north", "east", "south", "west") for p in parts[k]}
    middle = np.array(parts["middle"], dtype=float).reshape(-1, 3)
    for x, y, z in middle[snake(middle)].tolist():
        mesh.insert(x, y, z)
    return mesh, fixed


def reduce(mesh: Delaunay, fixed: set[int], most: int, tolerance: float | None = None) -> int:
    """Remove the inner vertices of least error until ``most`` are left (or the least is
    above ``tolerance``). Ties go by place."""
    alive = {v for v in range(3, len(mesh.points))}
    key = lambda v, e: (e, mesh.points[v][0], mesh.points[v][1], v)
    now = {v: mesh.error(v) for v in alive - fixed}
    heap = [key(v, e) for v, e in now.items() if math.isfinite(e)]
    heapq.heapify(heap)
    while heap and len(alive) > most:
        e, _, _, v = heapq.heappop(heap)
        if v not in alive or now.get(v) != e:
            continue
        if tolerance is not None and e > tolerance:
            break
        ring = mesh.remove(v)
        if not ring:
            continue
        alive.discard(v)
        for u in ring:
            if u in now and u in alive:
                now[u] = mesh.error(u)
                if math.isfinite(now[u]):
                    heapq.heappush(heap, key(u, now[u]))
    return len(alive)


def ecef_of(points: np.ndarray) -> np.ndarray:
    lam, phi = points[:, 0] * np.pi, 2 * np.arctan(np.exp(points[:, 1] * np.pi)) - np.pi / 2
    n = RADIUS / np.sqrt(1 - E2 * np.sin(phi) ** 2)
    h = points[:, 2]
    return np.column_stack([(n + h) * np.cos(phi) * np.cos(lam), (n + h) * np.cos(phi) * np.sin(lam), (n * (1 - E2) + h) * np.sin(phi)])


def mesh_json(mesh: Delaunay, x0: float, y0: float, x1: float, y1: float, skirt: bool = True) -> str:
    """Vertices relative to the south-west corner, texture places, triangles, and a skirt
    below the border that hides gaps between levels."""
    tri = mesh.triangles()
    used = sorted({v for t in tri for v in t})
    at = {v: i for i, v in enumerate(used)}
    p = np.array([mesh.points[v] for v in used]).reshape(-1, 3)
    index = [[at[v] for v in t] for t in tri]
    surface = len(used)
    xyz = ecef_of(p)
    box = [xyz.min(axis=0).tolist(), xyz.max(axis=0).tolist()] if surface else [[0.0] * 3] * 2
    if skirt and surface:
        low = p[:, 2].min() - SKIRT
        extra, below = [], {}
        for (a, b), _ in mesh.left.items():
            outer = mesh.left.get((b, a))
            if min(a, b) > 2 and a in at and b in at and mesh.left[a, b] > 2 and (outer is None or outer < 3):
                for v in (a, b):
                    if v not in below:
                        below[v] = surface + len(extra)
                        extra.append((*mesh.points[v][:2], low))
                index += [[at[b], at[a], below[a]], [at[b], below[a], below[b]]]
        p = np.vstack([p, extra]) if extra else p
        xyz = ecef_of(p)
    offset = ecef_of(np.array([[x0, y0, 0.0]]))[0]
    local = (xyz - offset).astype(np.float32)
    uv = np.column_stack([(p[:, 0] - x0) / (x1 - x0), (p[:, 1] - y0) / (y1 - y0)])
    vertices = [float(f"{v:.6g}") for v in np.hstack([local, uv]).ravel()]
    return json.dumps({
        "VertexSemantic": "pt", "Vertices": vertices, "IndexSemantic": "TRIANGLES", "Indices": [i for t in index for i in t],
        "Offset": offset.tolist(), "BoundingBox": box, "CurtainIndex": surface,
    })


def wavefront(mesh: Delaunay) -> str:
    """The surface as a Wavefront OBJ text."""
    tri = mesh.triangles()
    used = sorted({v for t in tri for v in t})
    at = {v: i + 1 for i, v in enumerate(used)}
    return "\n".join([*(f"v {x!r} {y!r} {z!r}" for x, y, z in (mesh.points[v] for v in used)), *("f " + " ".join(str(at[v]) for v in t) for t in tri)]) + "\n"


POINT = "struct<x:double,y:double,z:double>"
TILE = "tx bigint, ty bigint, n_points int, n_triangles int, corners array<%s>, north array<%s>, east array<%s>, south array<%s>, west array<%s>, middle array<%s>, mesh string" % ((POINT,) * 6)


def tile_box(tx: int, ty: int, lod: int) -> tuple[float, float, float, float]:
    n = 2.0**lod
    return 2 * tx / n - 1, 1 - 2 * (ty + 1) / n, 2 * (tx + 1) / n - 1, 1 - 2 * ty / n


def tile_row(tx: int, ty: int, lod: int, parts: dict, most: int) -> pd.DataFrame:
    box = tile_box(tx, ty, lod)
    mesh, fixed = build(parts, *box)
    n = reduce(mesh, fixed, most)
    alive = {v for t in mesh.triangles() for v in t}
    inner = [mesh.points[v] for v in sorted(alive - fixed)]
    as_rows = lambda ps: [{"x": float(x), "y": float(y), "z": float(z)} for x, y, z in ps]
    row = {"tx": tx, "ty": ty, "n_points": n, "n_triangles": len(mesh.triangles()), **{k: as_rows(parts[k]) for k in ("corners", "north", "east", "south", "west")}}
    return pd.DataFrame([{**row, "middle": as_rows(inner), "mesh": mesh_json(mesh, *box)}])


def snake(points: np.ndarray) -> np.ndarray:
    """An order along strips, up and down in turn: neighbours in it are close, so that each
    insertion finds its triangle in a few steps."""
    if not len(points):
        return np.zeros(0, np.int64)
    low, high = points[:, 0].min(), points[:, 0].max()
    strips = max(1, math.isqrt(len(points) // 4))
    strip = np.minimum((points[:, 0] - low) / ((high - low) or 1.0) * strips, strips - 1).astype(np.int64)
    return np.lexsort((points[:, 0], np.where(strip % 2, -points[:, 1], points[:, 1]), strip))


def near_border(lod: int, margin: float) -> Column:
    """Of rows (x, y, tx, ty) sent by dx, dy: whether that neighbour is within ``margin`` of a tile."""
    side = 2.0 / 2**lod
    fx = (F.col("x") + 1) / side - F.col("tx")
    fy = (1 - F.col("y")) / side - F.col("ty")
    near = lambda d, f: (F.col(d) == 0) | (F.col(d) == -1) & (f <= margin) | (F.col(d) == 1) & (f >= 1 - margin)
    return near("dx", fx) & near("dy", fy)


def triangulate(points: DataFrame, lod: int, max_points: int = 512, extent: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Mesh tiles of points (x, y, elevation, tx, ty): each tile's points and those of its
    neighbours within a margin meet in one task, are all triangulated, and reduced by least
    error. The margin is MARGIN_SPACINGS mean distances of points, a whole tile at most. A task
    holds the points of one tile and its margin: choose ``lod`` by their density."""
    if not 32 < max_points < 2048:
        raise ValueError("max_points must be in 33..2047")
    mean = points.groupBy("tx", "ty").agg(F.count("*").alias("n")).agg(F.avg("n").alias("mean")).first()["mean"] or 1.0
    margin = min(1.0, MARGIN_SPACINGS / math.sqrt(mean))
    near = halo(points.select("x", "y", "elevation", "tx", "ty"), near_border(lod, margin) if margin < 1 else None)
    if extent:
        x0, y0, x1, y1 = extent
        near = near.where(near["cx"].between(x0 + 1, x1 - 1) & near["cy"].between(y0 + 1, y1 - 1))

    def mesh(key, rows: pd.DataFrame) -> pd.DataFrame:
        tx, ty = int(key[0]), int(key[1])
        if not ((rows["tx"] == tx) & (rows["ty"] == ty)).any():
            return pd.DataFrame(columns=[c.strip().split(" ")[0] for c in "tx, ty, n_points, n_triangles, corners, north, east, south, west, middle, mesh".split(",")])
        x0, y0, x1, y1 = tile_box(tx, ty, lod)
        whole = Delaunay(2 * x0 - x1, 2 * y0 - y1, 2 * x1 - x0, 2 * y1 - y0)
        own = rows[["x", "y", "elevation"]].sort_values(["x", "y", "elevation"]).drop_duplicates(["x", "y"]).to_numpy(float)
        for x, y, z in own[snake(own)].tolist():
            whole.insert(x, y, z)
        return tile_row(tx, ty, lod, cut(whole, x0, y0, x1, y1), max_points)

    # Tiles are few bytes but much work: a fixed number of partitions isn't coalesced.
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return near.repartition(parts, "cx", "cy").groupBy("cx", "cy").applyInPandas(mesh, TILE)


def elevation_level(tiles: DataFrame, lod: int, max_points: int = 512) -> DataFrame:
    """Mesh tiles of the level above ``lod``: corners of the outer children, their outer
    borders, all inner points, reduced again."""

    def merge(key, rows: pd.DataFrame) -> pd.DataFrame:
        tx, ty = int(key[0]), int(key[1])
        x0, y0, x1, y1 = tile_box(tx, ty, lod - 1)
        parts: dict[str, list[tuple]] = {k: [] for k in ("north", "east", "south", "west", "middle")}
        corners = {(x0, y1): 0.0, (x1, y1): 0.0, (x1, y0): 0.0, (x0, y0): 0.0}
        tup = lambda ps: [(p["x"], p["y"], p["z"]) for p in ps]
        for r in rows.to_dict("records"):
            i, j = r["tx"] % 2, r["ty"] % 2
            for k, mine in (("north", j == 0), ("south", j == 1), ("west", i == 0), ("east", i == 1)):
                parts[k] += tup(r[k]) if mine else []
            parts["middle"] += tup(r["middle"])
            for x, y, z in tup(r["corners"]):
                if (x, y) in corners:
                    corners[x, y] = z
        return tile_row(tx, ty, lod - 1, {"corners": [(x, y, z) for (x, y), z in corners.items()], **parts}, max_points)

    return tiles.groupBy(F.shiftright("tx", 1), F.shiftright("ty", 1)).applyInPandas(merge, TILE)
