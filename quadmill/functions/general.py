"""Shaping functions and string and path functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import clip, col


def fract(x) -> Column:
    return col(x) - F.floor(col(x))


def floored_mod(x, n) -> Column:
    """Has the sign of the divisor."""
    return col(x) - col(n) * F.floor(col(x) / col(n))


def clamp(x) -> Column:
    return clip(col(x), 0.0, 1.0)


def mix(a, b, t) -> Column:
    return col(a) * (1 - col(t)) + col(b) * col(t)


def step(edge, x) -> Column:
    return F.when(col(x) < col(edge), 0.0).otherwise(1.0)


def pulse(a, b, x) -> Column:
    return step(a, x) - step(b, x)


def smoothstep(a, b, x) -> Column:
    t = clamp((col(x) - col(a)) / (col(b) - col(a)))
    return t * t * (3 - t * 2)


def scurve(t) -> Column:
    return col(t) * col(t) * (3 - col(t) * 2)


def bias(b, x) -> Column:
    return F.pow(col(x), F.log(col(b)) / F.log(F.lit(0.5)))


def gain(g, x) -> Column:
    return F.when(col(x) < 0.5, bias(1 - col(g), col(x) * 2) / 2).otherwise(1 - bias(1 - col(g), 2 - col(x) * 2) / 2)


def gamma(g, x) -> Column:
    return F.pow(col(x), 1 / col(g))


def bilinear(v00, v10, v01, v11, u, v) -> Column:
    return mix(mix(v00, v10, u), mix(v01, v11, u), v)


def cubic(a, b, c, d, t) -> Column:
    """Catmull-Rom through b and c."""
    a, b, c, d, t = map(col, (a, b, c, d, t))
    return b + (c - a + (a * 2 - b * 5 + c * 4 - d + (b * 3 - c * 3 + d - a) * t) * t) * t * 0.5


def is_power_of_two(x) -> Column:
    return (col(x) > 0) & (col(x).bitwiseAND(col(x) - 1) == 0)


def next_power_of_two(x) -> Column:
    return F.when(col(x) <= 1, F.lit(1)).otherwise(F.pow(F.lit(2.0), F.length(F.bin(col(x) - 1)))).cast("bigint")


def to_base(x, base: int) -> Column:
    return F.lower(F.conv(col(x).cast("string"), 10, base))


def from_base(text, base: int) -> Column:
    return F.conv(col(text), base, 10).cast("bigint")


def unify(path) -> Column:
    """Slashes only, none repeated."""
    return F.regexp_replace(F.translate(col(path), "\\", "/"), "(?<!:)/+", "/")


def file_name(path) -> Column:
    return F.element_at(F.split(unify(path), "/"), -1)


def extension(path) -> Column:
    return F.regexp_extract(file_name(path), r"\.([^.]*)$", 1)


def base_name(path) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def directory(path) -> Column:
    return F.regexp_extract(unify(path), r"^(.*/)[^/]*$", 1)


def is_web(path) -> Column:
    return F.lower(col(path)).rlike("^https?://")


def is_relative(path) -> Column:
    return ~unify(path).rlike("^(/|[A-Za-z]:|[A-Za-z]+://)")


def clamp_zero(x) -> Column:
    return F.greatest(col(x), F.lit(0.0))


def b_curve(x) -> Column:
    """The cubic B-spline's weight at a distance."""
    cube = lambda k: F.pow(clamp_zero(col(x) + k), F.lit(3.0))
    return (cube(2) - cube(1) * 4 + cube(0) * 6 - cube(-1) * 4 + cube(-2)) / 6


def is_zero(x) -> Column:
    return F.abs(col(x)) < F.lit(2.0**-52)


def middle(text, start, n) -> Column:
    """n characters from ``start``, which counts from 0."""
    return F.substr(col(text), col(start) + 1, col(n))


def tokens(text, separators: str = " \t\n") -> Column:
    """The non-empty parts between any of the separators."""
    marks = "".join(f"\\x{ord(s):02x}" for s in separators)
    return F.filter(F.split(col(text), f"[{marks}]"), lambda t: t != "")


def delimited(path) -> Column:
    """Ends with one slash, unless it is empty."""
    return F.when(unify(path) == "", "").otherwise(F.concat(F.rtrim(unify(path), F.lit("/")), F.lit("/")))


def url_host(url) -> Column:
    return F.regexp_extract(col(url), r"^[A-Za-z]+://([^/]*)", 1)


def url_file(url) -> Column:
    return F.regexp_extract(col(url), r"^[A-Za-z]+://[^/]*(/.*)?$", 1)


def absolute(root, path) -> Column:
    """``path`` below ``root`` if it is relative; dots at its front go up."""
    up = F.size(F.filter(F.split(unify(path), "/"), lambda t: t == ".."))
    rest = F.filter(F.split(unify(path), "/"), lambda t: (t != "..") & (t != ".") & (t != ""))
    stem = F.split(F.rtrim(delimited(root), F.lit("/")), "/")
    joined = F.array_join(F.concat(F.slice(stem, F.lit(1), F.greatest(F.size(stem) - up, F.lit(0))), rest), "/")
    return F.when(is_relative(path), joined).otherwise(unify(path))


def relative(path, folder) -> Column:
    """``path`` as seen from ``folder``, both absolute."""
    a = F.filter(F.split(unify(folder), "/"), lambda t: t != "")
    b = F.filter(F.split(unify(path), "/"), lambda t: t != "")
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    common = F.aggregate(same, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, e: F.struct((s["n"] + (s["on"] & e).cast("int")).alias("n"), (s["on"] & e).alias("on")), lambda s: s["n"])
    return F.array_join(F.concat(F.array_repeat(F.lit(".."), F.size(a) - common), F.slice(b, common + 1, F.size(b))), "/")
