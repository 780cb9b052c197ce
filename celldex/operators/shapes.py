"""Outlines of labelled pixels and polygons: contours, feature collections, overlaps of pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import json_text

RINGS = "array<array<struct<x: double, y: double>>>"


def outline(mask: np.ndarray) -> np.ndarray:
    """The longest closed outline (x, y; pixel centres) half-way between pixels inside a mask and those outside.

    Half-way points on the sides of the squares between four pixel centres are linked square by square.
    Where only two opposite corners of a square are inside, they aren't joined.
    """
    m = np.pad(mask, 1)
    a, b, c, d = m[:-1, :-1], m[:-1, 1:], m[1:, 1:], m[1:, :-1]  # corners of squares, clockwise from the upper left
    code = a * 1 + b * 2 + c * 4 + d * 8
    top, right, bottom, left = (0.5, 0.0), (1.0, 0.5), (0.5, 1.0), (0.0, 0.5)
    # Steps with the inside on the right hand, by which corners are inside.
    steps = {1: [(left, top)], 2: [(top, right)], 3: [(left, right)], 4: [(right, bottom)], 5: [(left, top), (right, bottom)], 6: [(top, bottom)], 7: [(left, bottom)],
             8: [(bottom, left)], 9: [(bottom, top)], 10: [(top, right), (bottom, left)], 11: [(bottom, right)], 12: [(right, left)], 13: [(right, top)], 14: [(top, left)]}
    follow: dict[tuple[float, float], tuple[float, float]] = {}
    for y, x in zip(*np.nonzero((code > 0) & (code < 15)), strict=True):
        for (fx, fy), (tx, ty) in steps[int(code[y, x])]:
            follow[x - 1 + fx, y - 1 + fy] = (x - 1 + tx, y - 1 + ty)
    best: list[tuple[float, float]] = []
    while follow:
        start, at = follow.popitem()
        ring = [start]
        while at != start:
            ring.append(at)
            at = follow.pop(at)
        best = max(best, ring, key=len)
    return np.array([*best, best[0]]) if best else np.zeros((0, 2))


def simplified(line: np.ndarray, tolerance: float) -> np.ndarray:
    """The points of a line that are needed so that no other is further from it than the tolerance."""
    keep = np.zeros(len(line), bool)
    keep[[0, -1]] = True
    todo = [(0, len(line) - 1)]
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        p, q, mid = line[i], line[j], line[i + 1 : j]
        along, length = q - p, float(np.hypot(*(q - p)))
        t = np.clip((mid - p) @ along / length**2, 0, 1)[:, None] if length else np.zeros((len(mid), 1))
        away = np.hypot(*(mid - p - t * along).T)
        k = int(away.argmax())
        if away[k] > tolerance:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return line[keep]


def contours(pixels: DataFrame, tolerance: float = 1.0, places: int = 2, corner: float = 0.5) -> DataFrame:
    """label, ring of labels (NULL and 0 are background): the longest outline, closed, simplified and rounded.

    Coordinates are from pixel corners; with corner 0, from pixel centres.

    Rings that keep less than 4 points are left out.  A task gets one label's pixels, so its box, at a time.
    """

    def trace(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = np.unique(np.concatenate([f[["y", "x"]].to_numpy(np.int64) for f in frames]), axis=0)
        low = at.min(0)
        mask = np.zeros(at.max(0) - low + 1, bool)
        mask[tuple((at - low).T)] = True
        ring = simplified(outline(mask) + corner, tolerance) + low[::-1]
        if len(ring) >= 4:
            yield pd.DataFrame({"label": [key[0]], "ring": [[{"x": round(float(x), places), "y": round(float(y), places)} for x, y in ring]]})

    kind = pixels.schema["label"].dataType.simpleString()
    rows = pixels.where("label <> 0 and x is not null and y is not null").select("label", "x", "y")
    return rows.groupBy("label").applyInPandas(trace, f"label {kind}, ring array<struct<x: double, y: double>>")


def mask_features(pixels: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """label, feature (GeoJSON text) of labels' outlines from pixel centres, as registration takes them."""
    ring = contours(pixels, tolerance, corner=0.0)
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.transform("ring", lambda p: F.array(p["x"], p["y"]))).alias("coordinates"))
    one = F.struct(F.lit("Feature").alias("type"), F.col("label").cast("string").alias("id"), shape.alias("geometry"))
    return ring.select("label", json_text(one, ring.select(one.alias("f")).schema["f"].dataType).alias("feature"))


def polygons(features: DataFrame, geometry: str, feature: str) -> DataFrame:
    """feature, part, hole, ring of GeoJSON geometries (text): Polygon and MultiPolygon, rings of 3 points or more.

    A part is a polygon; `hole` is false for its outer ring.
    """
    kind = F.get_json_object(geometry, "$.type")
    single = F.when(kind == "Polygon", F.array(F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<double>>>")))
    many = F.when(kind == "MultiPolygon", F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<array<double>>>>"))
    parts = features.select(feature, F.posexplode(F.coalesce(single, many)).alias("part", "rings"))
    rings = parts.select(feature, "part", F.posexplode("rings").alias("at", "points"))
    ring = F.transform("points", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return rings.where(F.size("points") >= 3).select(feature, "part", (F.col("at") > 0).alias("hole"), ring.alias("ring"))


def boxes(rings: DataFrame, feature: str) -> DataFrame:
    """feature, x0, y0, x1, y1 of rings (structs x, y)."""
    low = lambda f, c: f(F.transform("ring", lambda p: p[c]))
    ends = rings.groupBy(feature).agg(*[g(low(f, c)).alias(f"{c}{i}") for i, f, g in ((0, F.array_min, F.min), (1, F.array_max, F.max)) for c in "xy"])
    return ends.select(feature, "x0", "y0", "x1", "y1")


class Rings:
    """The rings of a column (a list of rings a row) as flat arrays: x, y of corners, and of each its row, its ring and the corner after it."""

    def __init__(self, column: pa.Array):
        rings = column.flatten()
        points = rings.flatten()
        self.x, self.y = (points.field(c).to_numpy(zero_copy_only=False).astype(float) for c in "xy")
        size = rings.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.many = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.ring = np.repeat(np.arange(len(size)), size)
        self.row = np.repeat(np.repeat(np.arange(len(self.many)), self.many), size)
        ends = np.cumsum(size)
        self.after = np.arange(1, len(self.x) + 1)
        self.after[ends[size > 0] - 1] = (ends - size)[size > 0]

    def filled(self, e: np.ndarray, origin: np.ndarray, scale: int, base: np.ndarray, height: np.ndarray, width: np.ndarray, total: int) -> np.ndarray:
        """Which whole points of rows' windows (their origin, size, and place among `total` points) lie inside any of their rings, by crossings of lines; e: the corners of these rows."""
        row = self.row[e]
        (x0, y0), (x1, y1) = (((self.x[c] - origin[0, row]) * scale, (self.y[c] - origin[1, row]) * scale) for c in (e, self.after[e]))
        first = np.maximum(np.ceil(np.minimum(y0, y1)), 0).astype(np.int64)
        n = np.maximum(np.minimum(np.ceil(np.maximum(y0, y1)).astype(np.int64), height[row]) - first, 0)  # lines that the side crosses
        i = np.repeat(np.arange(len(e)), n)
        line = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        at = x0[i] + (line - y0[i]) * (x1[i] - x0[i]) / (y1[i] - y0[i])
        order = np.lexsort((at, line, self.ring[e[i]]))
        a, b, line, row = at[order][::2], at[order][1::2], line[order][::2], row[i[order]][::2]
        start = np.clip(np.ceil(a).astype(np.int64), 0, width[row])
        stop = np.clip(np.floor(b).astype(np.int64) + 1, 0, width[row])
        some, at = stop > start, base[row] + line * width[row]
        steps = np.bincount((at + start)[some], minlength=total + 1) - np.bincount((at + stop)[some], minlength=total + 1)
        return np.cumsum(steps)[:total] > 0


#: Window points that `pair_overlap` fills at once, unless one pair's window alone has more.
POINTS = 1 << 20


def overlaps(batch: pa.RecordBatch, scale: int, most: int) -> np.ndarray:
    """iou of the rows of a batch with p, p_holes, q, q_holes (`pair_overlap`), NaN for none; windows of many rows are filled together."""
    n = len(batch)
    rings = {k: Rings(batch.column(k)) for k in ("p", "p_holes", "q", "q_holes")}
    low, high, ok = np.full((2, n), np.inf), np.full((2, n), -np.inf), (rings["p"].many > 0) & (rings["q"].many > 0)
    for r in rings.values():
        np.logical_and.at(ok, r.row, np.isfinite(r.x) & np.isfinite(r.y))
        for i, v in enumerate((r.x, r.y)):
            np.fmin.at(low[i], r.row, v)
            np.fmax.at(high[i], r.row, v)
    with np.errstate(invalid="ignore", over="ignore"):
        size = np.ceil((high - low) * scale) + 2
        ok &= np.isfinite(size).all(0) & (size[0] * size[1] <= most)
    width, height = np.where(ok, size, 0).astype(np.int64)
    out, upto = np.full(n, np.nan), np.cumsum(width * height)
    done = 0
    while done < n:
        taken = upto[done - 1] if done else 0
        end = max(done + 1, int(np.searchsorted(upto, taken + POINTS, side="right")))
        base, total = upto - width * height - taken, int(upto[end - 1] - taken)
        masks = {}
        for k, r in rings.items():
            e = np.arange(*np.searchsorted(r.row, (done, end)))  # rows ascend
            masks[k] = r.filled(e[ok[r.row[e]]], low - 1.0 / scale, scale, base, height, width, total)
        m, k = (masks["p"] & ~masks["p_holes"]), (masks["q"] & ~masks["q_holes"])
        rows = np.arange(done, end)[ok[done:end]]
        if len(rows):
            both, either = (np.add.reduceat(v.astype(np.int64), base[rows]) for v in (m & k, m | k))
            out[rows[either > 0]] = both[either > 0] / either[either > 0]
        done = end
    return out


def pair_overlap(pairs: DataFrame, a: DataFrame, b: DataFrame, scale: int = 2, most: int = 4_000_000) -> DataFrame:
    """pairs (a, b) with iou: common over all grid points of two features, `scale` a pixel in a window of their own.

    a and b: `polygons` with feature, hole, ring.  NULL where the window has more than `most` points, a
    coordinate isn't finite, or neither has a point.  Pairs are joined to their rings, each feature's in one row.
    """
    of = lambda rings, f, name: rings.groupBy(F.col("feature").alias(f)).agg(F.collect_list(F.when(~F.col("hole"), F.col("ring"))).alias(name), F.collect_list(F.when(F.col("hole"), F.col("ring"))).alias(f"{name}_holes"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            iou = overlaps(batch, scale, most)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(iou, pa.float64(), mask=np.isnan(iou))], ["a", "b", "iou"])

    ka, kb = (pairs.schema[c].dataType.simpleString() for c in "ab")
    rows = pairs.select("a", "b").join(of(a, "a", "p"), "a", "left").join(of(b, "b", "q"), "b", "left")
    full = {c: F.coalesce(F.col(c), F.array().cast(RINGS)) for c in ("p", "p_holes", "q", "q_holes")}
    return rows.withColumns(full).select("a", "b", *full).mapInArrow(score, f"a {ka}, b {kb}, iou double")


def feature_text(cells: DataFrame, rings: DataFrame, label: str, cx: str, cy: str, properties: Column) -> DataFrame:
    """label, feature (GeoJSON text): a polygon where the label has a ring (label, ring), else a point; none where the centroid is missing or NaN."""
    rows = cells.where(F.col(cx).isNotNull() & F.col(cy).isNotNull() & ~F.isnan(cx) & ~F.isnan(cy)).join(rings.select(label, "ring"), label, "left")
    numbers = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    shape = lambda kind, c: F.struct(F.lit(kind).alias("type"), c.alias("coordinates"))
    head = [F.lit("Feature").alias("type"), F.col(label).cast("string").alias("id")]

    def as_text(geometry: Column) -> Column:
        one = F.struct(*head, geometry.alias("geometry"), properties.alias("properties"))
        return json_text(one, rows.select(one.alias("f")).schema["f"].dataType)

    point = as_text(shape("Point", F.array(F.col(cx).cast("double"), F.col(cy).cast("double"))))
    return rows.select(label, F.when(F.size("ring") > 0, as_text(shape("Polygon", F.array(numbers)))).otherwise(point).alias("feature"))


def combined_features(cells: DataFrame, rings: DataFrame, nuclei: DataFrame, label: str, cx: str, cy: str, properties: Column) -> tuple[DataFrame, DataFrame]:
    """Features of cells with their nucleus as geometry and all properties, and lean ones with the whole cell."""
    lean = F.struct(F.lit("annotation").alias("objectType"))
    return feature_text(cells, nuclei, label, cx, cy, properties), feature_text(cells, rings, label, cx, cy, lean)


def write_collection(features: DataFrame, path: str, order: str) -> None:
    """A FeatureCollection as text parts that make one document when put together in the order of their names.

    Parts are ranges of `order`; head and tail are parts too, so no task sees all features.
    """
    first = features.agg(F.min(order).alias("_least"))
    lines = features.select(F.col(order).alias("o"), F.col("feature").alias("f")).join(F.broadcast(first))
    text = lines.select("o", F.concat(F.when(F.col("o") > F.col("_least"), ",").otherwise(""), F.col("f")).alias("value"))
    body = text.repartitionByRange("o").sortWithinPartitions("o").select("value")
    spark = features.sparkSession
    end = lambda text: spark.createDataFrame([(text,)], "value string").coalesce(1)
    end('{"type": "FeatureCollection", "features": [').write.mode("overwrite").text(f"{path}/0-head")
    body.write.mode("overwrite").text(f"{path}/1-features")
    end("]}").write.mode("overwrite").text(f"{path}/2-tail")
