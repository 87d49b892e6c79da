"""Vector features to tiles: a join of features with the tiles they touch, and a painter.

A feature has ``rings``, an array of arrays of struct<x, y> in degrees, and a style. Its
pixels and its tiles are columns; one exchange brings a tile's features together in
paint order, and a painter streams through them with one tile's buffer in memory,
however many features a tile has. Labels are not drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grid import mercator_x, mercator_y
from .jobs import expand, rule_filter, visible_zooms

POINT = "struct<x:double,y:double>"
CLEAR = [0, 0, 0, 0]
STYLE = ("fill", "stroke", "width")


def moved(rings, x, y) -> Column:
    """Rings with each point put through x(p) and y(p)."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(x(p).alias("x"), y(p).alias("y"))))


def places(points, axis: str) -> Column:
    return F.transform(points, lambda p: p[axis])


def pixel_rings(rings, zoom: Column, size: int = 256) -> Column:
    """Rings in pixels of the world at a zoom, with fractions; y down."""
    world = F.pow(F.lit(2.0), zoom) * size
    return moved(rings, lambda p: (mercator_x(p["x"]) + 1) / 2 * world, lambda p: (1 - mercator_y(p["y"])) / 2 * world)


def styled(features: DataFrame, rules: list[dict], zooms: range) -> DataFrame:
    """A row for each feature, rule and zoom at which the rule shows it, in paint order."""
    shown = []
    for k, rule in enumerate(rules):
        color = lambda n: F.array(*[F.lit(int(v)) for v in rule.get(n, CLEAR)]).alias(n)  # noqa: E731, B023
        style = (color("fill"), color("stroke"), F.lit(float(rule.get("width", 0.0))).alias("width"))
        for z in visible_zooms(rule.get("min", 0.0), rule.get("max", 1e12)):
            if z in zooms:
                shown.append(F.when(rule_filter(rule.get("filter", "")), F.struct(F.lit(z).alias("zoom"), F.lit(k).alias("rule"), *style)))
    if not shown:
        raise ValueError("no rule shows at these zooms")
    # One scan, whatever the number of rules.
    return features.select("feature", "rings", F.explode(F.array_compact(F.array(*shown))).alias("as")).select("feature", "rings", "as.*")


def in_tiles(rows: DataFrame, size: int = 256) -> DataFrame:
    """``rows`` once for each tile their pixels touch, moved to the tile's corner."""
    rows = rows.withColumn("rings", pixel_rings("rings", F.col("zoom"), size))
    points = F.flatten("rings")
    last = F.pow(F.lit(2.0), "zoom").cast("bigint") - 1
    for axis, name in (("x", "tx"), ("y", "ty")):
        at, edge = places(points, axis), F.col("width") / 2
        rows = rows.withColumn(f"{axis}0", F.greatest(F.floor((F.array_min(at) - edge) / size), F.lit(0)))
        rows = rows.withColumn(f"{axis}1", F.least(F.floor((F.array_max(at) + edge) / size), last))
    rows = expand(rows.where("x0 <= x1 and y0 <= y1"))
    near = moved("rings", lambda p: p["x"] - F.col("tx") * size, lambda p: p["y"] - F.col("ty") * size)
    return rows.select("zoom", "tx", "ty", "rule", "feature", near.alias("rings"), *STYLE)


def covered(rings: list[np.ndarray], width: int, height: int) -> np.ndarray:
    """Pixels whose centre is inside by the even-odd rule.

    An edge toggles each row that it crosses, from the first centre right of it on.
    """
    toggle = np.zeros((height, width + 1), np.int32)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0)):
            low, high = min(ay, by), max(ay, by)
            rows = np.arange(max(0, int(np.ceil(low - 0.5))), min(height, int(np.ceil(high - 0.5))))
            if len(rows):
                x = ax + (rows + 0.5 - ay) * (bx - ax) / (by - ay)
                toggle[rows, np.clip(np.ceil(x - 0.5), 0, width).astype(int)] += 1
    return np.cumsum(toggle[:, :width], axis=1) % 2 == 1


def stroked(rings: list[np.ndarray], wide: float, width: int, height: int) -> np.ndarray:
    """Pixels whose centre is within half of ``wide`` of a line; ends are round."""
    out, half = np.zeros((height, width), bool), wide / 2
    for ring in rings:
        for a, b in zip(ring[:-1], ring[1:]):
            (x0, y0), (x1, y1) = np.minimum(a, b) - half - 0.5, np.maximum(a, b) + half - 0.5
            i0, i1 = max(0, int(np.ceil(x0))), min(width, int(np.floor(x1)) + 1)
            j0, j1 = max(0, int(np.ceil(y0))), min(height, int(np.floor(y1)) + 1)
            if i0 >= i1 or j0 >= j1:
                continue
            x, y = np.arange(i0, i1)[None, :] + 0.5 - a[0], np.arange(j0, j1)[:, None] + 0.5 - a[1]
            d = b - a
            t = np.clip((x * d[0] + y * d[1]) / (d @ d), 0, 1) if d @ d else 0.0
            out[j0:j1, i0:i1] |= (x - t * d[0]) ** 2 + (y - t * d[1]) ** 2 <= half * half
    return out


def laid_over(canvas: np.ndarray, mask: np.ndarray, color: np.ndarray) -> None:
    """A color over the canvas (rgba, 0..1, not premultiplied) where the mask is set."""
    top, base = color[3], canvas[mask, 3:]
    alpha = top + base * (1 - top)
    canvas[mask, :3] = (color[:3] * top + canvas[mask, :3] * base * (1 - top)) / np.maximum(alpha, 1e-12)
    canvas[mask, 3:] = alpha


def draw(canvas: np.ndarray, rings: list[np.ndarray], fill, stroke, wide: float) -> None:
    """A feature over the canvas; only the window that it touches is worked on."""
    rings = [r for r in rings if len(r)]
    if not rings:
        return
    height, width = canvas.shape[:2]
    points = np.concatenate(rings)
    low, high = np.floor(points.min(axis=0) - wide / 2), np.ceil(points.max(axis=0) + wide / 2)
    (i0, j0), (i1, j1) = np.maximum(low, 0).astype(int), np.minimum(high, (width, height)).astype(int)
    if i0 >= i1 or j0 >= j1:
        return
    window, rings = canvas[j0:j1, i0:i1], [r - (i0, j0) for r in rings]
    for color, mask in ((fill, covered), (stroke, lambda r, w, h: stroked(r, wide, w, h))):
        if color[3]:
            laid_over(window, mask(rings, i1 - i0, j1 - j0), np.asarray(color, float) / 255)


def painted(rows: DataFrame, keys: list[str], width: int = 256, height: int = 256) -> DataFrame:
    """``keys`` and rgba of each picture, whose rows are painted by rule, then feature."""

    def finish(canvas: np.ndarray) -> bytes:
        return np.floor(canvas * 255 + 0.5).astype(np.uint8).tobytes()

    def paint(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, canvas = None, None
        for batch in batches:
            done = []
            for row in batch.itertuples(index=False):
                key = tuple(getattr(row, k) for k in keys)
                if key != now:
                    if canvas is not None:
                        done.append((*now, finish(canvas)))
                    now, canvas = key, np.zeros((height, width, 4))
                rings = [np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2) for ring in row.rings]
                draw(canvas, rings, row.fill, row.stroke, row.width)
            if done:
                yield pd.DataFrame(done, columns=[*keys, "rgba"])
        if canvas is not None:
            yield pd.DataFrame([(*now, finish(canvas))], columns=[*keys, "rgba"])

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    # A number of partitions is given since painting costs more than its bytes tell.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, *keys).sortWithinPartitions(*keys, "rule", "feature")
    return ordered.select(*keys, "rings", *STYLE).mapInPandas(paint, f"{kinds}, rgba binary")


def render_tiles(features: DataFrame, rules: list[dict], zooms: range, size: int = 256) -> DataFrame:
    """Tiles (zoom, tx, ty, rgba) of features (feature, rings, and what filters name)."""
    return painted(in_tiles(styled(features, rules, zooms), size), ["zoom", "tx", "ty"], size, size)


def render_box(features: DataFrame, rules: list[dict], box: tuple[float, float, float, float], width: int, height: int, zoom: int) -> DataFrame:
    """One picture (zoom, rgba) of a box of degrees (west, south, east, north), with the
    styles of a zoom. Features outside the box are dropped before the exchange."""
    rows = styled(features, rules, range(zoom, zoom + 1))
    x = lambda v: (mercator_x(v) - mercator_x(F.lit(box[0]))) / (mercator_x(F.lit(box[2])) - mercator_x(F.lit(box[0]))) * width
    y = lambda v: (mercator_y(F.lit(box[3])) - mercator_y(v)) / (mercator_y(F.lit(box[3])) - mercator_y(F.lit(box[1]))) * height
    rows = rows.withColumn("rings", moved("rings", lambda p: x(p["x"]), lambda p: y(p["y"])))
    points, edge = F.flatten("rings"), F.col("width") / 2
    for axis, most in (("x", width), ("y", height)):
        at = places(points, axis)
        rows = rows.where((F.array_max(at) + edge >= 0) & (F.array_min(at) - edge <= most))
    return painted(rows, ["zoom"], width, height)


#: Names of a database layer's parameters in the map, and in a style.
DATABASE = {"type": "dbtype", "host": "dbhost", "port": "dbport", "dbname": "dbname", "user": "dbuser", "password": "dbpass", "estimate_extent": "dbestimate", "table": "dbtable"}
SYMBOLIZERS = {"polygon": "PolygonSymbolizer", "polygonpattern": "PolygonPatternSymbolizer", "line": "LineSymbolizer", "text": "TextSymbolizer"}


def scale_range(rule: dict, zooms: list[float]) -> tuple[float, float]:
    """Least and most scale denominator of a rule: maxzoom names the place of the most in
    ``zooms``, minzoom the place before that of the least."""
    least = zooms[rule["minzoom"] + 1] if "minzoom" in rule and rule["minzoom"] + 1 < len(zooms) else 0.0
    return least, zooms[rule["maxzoom"]] if "maxzoom" in rule else float("inf")


def style_xml(style: dict) -> str:
    """A style of JSON (srs, bgcolor, zooms, layers, styles) as a map description in XML."""
    import xml.etree.ElementTree as xml

    root = xml.Element("Map", {"bgcolor": style.get("bgcolor", ""), "srs": style.get("srs", "")})
    for s in style.get("styles", []):
        node = xml.SubElement(root, "Style", {"name": s["name"]})
        for rule in s["rules"]:
            at, (least, most) = xml.SubElement(node, "Rule"), scale_range(rule, style.get("zooms", []))
            if "filter" in rule:
                xml.SubElement(at, "Filter").text = rule["filter"]
            if most != float("inf"):
                xml.SubElement(at, "MaxScaleDenominator").text = str(most)
            if least:
                xml.SubElement(at, "MinScaleDenominator").text = str(least)
            for symbol in rule["symbolizers"]:
                params, mark = symbol["params"], xml.SubElement(at, SYMBOLIZERS[symbol["type"]])
                if symbol["type"] in ("polygon", "line"):
                    for k, v in params.items():
                        xml.SubElement(mark, "CssParameter", {"name": k}).text = str(v)
                else:
                    mark.attrib.update({k: str(v) for k, v in params.items()})
    for layer in style.get("layers", []):
        given = {k: layer[k] for k in ("name", "srs", "status") if k in layer}
        node = xml.SubElement(root, "Layer", given)
        xml.SubElement(node, "StyleName").text = layer["styleId"]
        params = layer["params"]
        if layer["type"] == "db":
            params = {k: params[v] for k, v in DATABASE.items() if v in params}
        source = xml.SubElement(node, "Datasource")
        for k, v in params.items():
            xml.SubElement(source, "Parameter", {"name": k}).text = str(v)
    xml.indent(root)
    return xml.tostring(root, encoding="unicode")
