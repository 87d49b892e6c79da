"""Color spaces and blends. Channels are numbers; r, g, b, s and v in 0..1 unless said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import clip, col


def rgb_to_hsv(r, g, b) -> list[Column]:
    """Hue in degrees; grey has hue and saturation 0."""
    r, g, b = col(r), col(g), col(b)
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    d = high - low
    h = F.when(d == 0, 0.0).when(high == r, (g - b) / d).when(high == g, (b - r) / d + 2.0).otherwise((r - g) / d + 4.0) * 60.0
    return [F.when(h < 0, h + 360.0).otherwise(h), F.when(high == 0, 0.0).otherwise(d / high), high]


def hsv_to_rgb(h, s, v) -> list[Column]:
    h, s, v = col(h), col(s), col(v)
    sector = F.floor(h / 60.0)
    f = h / 60.0 - sector
    p, q, t = v * (1 - s), v * (1 - s * f), v * (1 - s * (1 - f))
    i = F.pmod(sector, F.lit(6))
    pick = lambda *c: F.when(i == 0, c[0]).when(i == 1, c[1]).when(i == 2, c[2]).when(i == 3, c[3]).when(i == 4, c[4]).otherwise(c[5])
    return [pick(v, q, p, p, t, v), pick(t, v, v, q, p, p), pick(p, p, t, v, v, q)]


def byte(x) -> Column:
    """0..255, truncated."""
    return F.floor(clip(col(x), 0.0, 255.0)).cast("int")


def blend(top, base, alpha) -> Column:
    """Linear: alpha in 0..1 is the share of top."""
    return col(top) * col(alpha) + col(base) * (1 - col(alpha))


def over(top: list, top_alpha, base: list, base_alpha) -> list[Column]:
    """RGBA of top over base, all in 0..1; the last is alpha."""
    a, b = col(top_alpha), col(base_alpha)
    alpha = a + b * (1 - a)
    mix = [F.when(alpha == 0, 0.0).otherwise((col(t) * a + col(u) * b * (1 - a)) / alpha) for t, u in zip(top, base)]
    return [*mix, alpha]
