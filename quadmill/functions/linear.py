"""Vectors as lists of columns, and matrices of numbers that are applied to them."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import col

Vector = list[Column]


def dot(a: Vector, b: Vector) -> Column:
    return reduce(lambda s, t: s + t, [col(x) * col(y) for x, y in zip(a, b)])


def length(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Vector, b: Vector) -> Vector | Column:
    """Three columns for vectors of three, one for vectors of two."""
    a, b = [col(x) for x in a], [col(x) for x in b]
    if len(a) == 2:
        return a[0] * b[1] - a[1] * b[0]
    return [a[(i + 1) % 3] * b[(i + 2) % 3] - a[(i + 2) % 3] * b[(i + 1) % 3] for i in range(3)]


def normalised(a: Vector) -> Vector:
    """Of length one; a vector of length zero stays."""
    n = length(a)
    return [F.when(n > 0, col(x) / n).otherwise(F.lit(0.0)) for x in a]


def reflected(a: Vector, normal: Vector) -> Vector:
    """``a`` mirrored at the plane whose unit normal is given."""
    twice = dot(a, normal) * 2
    return [col(x) - twice * col(n) for x, n in zip(a, normal)]


def lerp(a: Vector, b: Vector, t) -> Vector:
    return [col(x) + (col(y) - col(x)) * col(t) for x, y in zip(a, b)]


def rotation(axis: str, degrees: float) -> np.ndarray:
    out, (i, j), a = np.eye(4), {"x": (1, 2), "y": (2, 0), "z": (0, 1)}[axis], np.radians(degrees)
    out[i, i] = out[j, j] = np.cos(a)
    out[i, j], out[j, i] = -np.sin(a), np.sin(a)
    return out


def translation(x: float, y: float, z: float) -> np.ndarray:
    out = np.eye(4)
    out[:3, 3] = x, y, z
    return out


def scaling(x: float, y: float, z: float) -> np.ndarray:
    return np.diag([x, y, z, 1.0])


def view(eye, target, up) -> np.ndarray:
    """World to eye space, looking down the negative z axis."""
    eye, target, up = (np.asarray(v, float) for v in (eye, target, up))
    back = (eye - target) / np.linalg.norm(eye - target)
    right = np.cross(up, back)
    right /= np.linalg.norm(right)
    turn = np.eye(4)
    turn[:3, :3] = right, np.cross(back, right), back
    return turn @ translation(*-eye)


def applied(matrix: np.ndarray, v: Vector) -> Vector:
    """A point (three columns) under an affine matrix of 4 by 4."""
    return [dot([F.lit(float(m)) for m in row[:3]], v) + float(row[3]) for row in np.asarray(matrix)[:3]]
