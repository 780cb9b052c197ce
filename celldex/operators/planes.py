"""Planes as tables of packed tiles, and stencils over them: morphology, area closing, contours, label growth.

A tile is a row (plane, ty, tx, body): `depth` layers of numbers, packed.  A stencil sends each tile's strips
to the tiles around it, once, and works on the tile with its halo; what lies beyond the plane is told apart.
Every step is written to the shared folder, so lineage stays short and lost executors cost little.  No task
holds more than a tile and its halo, whatever the plane's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import _kept, components

TILE = 256

#: Different values that a plane may have for area closing: each is a level of its own.
MOST_LEVELS = 64

KEYS = ["plane", "ty", "tx"]


@dataclass(frozen=True)
class Planes:
    tiles: DataFrame  # plane, ty, tx, body
    height: int
    width: int
    tile: int = TILE
    depth: int = 1
    kind: str = "<i4"

    def __getstate__(self) -> dict:
        """Tasks get the layout, not the table."""
        return self.__dict__ | {"tiles": None}

    @property
    def rows(self) -> int:
        return -(-self.height // self.tile)

    @property
    def columns(self) -> int:
        return -(-self.width // self.tile)

    def shape(self, ty: int, tx: int) -> tuple[int, int, int]:
        return self.depth, min(self.tile, self.height - ty * self.tile), min(self.tile, self.width - tx * self.tile)

    def array(self, ty: int, tx: int, body: bytes) -> np.ndarray:
        return np.frombuffer(body, self.kind).reshape(self.shape(ty, tx))


def packed(pixels: DataFrame, height: int, width: int, tile: int = TILE, layers: list[str] | None = None, kind: str = "<i4") -> Planes:
    """Planes of pixels (plane, x, y and a column a layer); pixels that aren't there, NULL or beyond the plane count as 0.

    Of several rows of one pixel the greatest values count.
    """
    layers = layers or ["v"]
    out = Planes(pixels, height, width, tile, len(layers), kind)
    inside = pixels.where((F.col("x") >= 0) & (F.col("x") < width) & (F.col("y") >= 0) & (F.col("y") < height))
    place = [F.col("plane").cast("long").alias("plane"), F.floor(F.col("y") / tile).cast("int").alias("ty"), F.floor(F.col("x") / tile).cast("int").alias("tx")]
    real = inside.select(*place, (F.col("y") % tile).cast("int").alias("y"), (F.col("x") % tile).cast("int").alias("x"), *[F.col(c).cast("long" if "i" in kind else "double").alias(f"v{i}") for i, c in enumerate(layers)])
    every = pixels.select(place[0]).distinct()
    every = every.select("plane", F.explode(F.sequence(F.lit(0), F.lit(out.rows - 1))).alias("ty")).select("plane", "ty", F.explode(F.sequence(F.lit(0), F.lit(out.columns - 1))).alias("tx"))

    def pack(rows: pa.Table) -> pa.Table:
        _, ty, tx = key = [rows[c][0].as_py() for c in KEYS]
        a = np.zeros(out.shape(ty, tx), kind)
        rows = rows.filter(rows["y"].is_valid())
        y, x = (rows[c].to_numpy() for c in ("y", "x"))
        for i in range(out.depth):
            ok = rows[f"v{i}"].is_valid().to_numpy()
            v = rows[f"v{i}"].drop_null().to_numpy()
            order = np.argsort(v, kind="stable")
            a[i, y[ok][order], x[ok][order]] = v[order]
        return _tile(key, a)

    tiles = real.unionByName(every, allowMissingColumns=True).groupBy(*KEYS).applyInArrow(pack, "plane long, ty int, tx int, body binary")
    return replace(out, tiles=_kept(tiles, "tiles"))


def _tile(key: list, a: np.ndarray) -> pa.Table:
    return pa.table([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int32()), pa.array([key[2]], pa.int32()), pa.array([a.tobytes()], pa.binary())], names=[*KEYS, "body"])


def unpacked(planes: Planes, names: list[str] | None = None) -> DataFrame:
    """plane, x, y and a column a layer: every pixel."""
    names = names or ["v"]
    number = "long" if "i" in planes.kind else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, ty, tx, body in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "body")), strict=True):
                a = planes.array(ty, tx, body)
                y, x = (v.ravel() for v in np.indices(a.shape[1:]))
                layers = [pa.array(v.ravel().astype(np.int64 if number == "long" else np.float64)) for v in a]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), plane, np.int64)), pa.array(x + tx * planes.tile), pa.array(y + ty * planes.tile), *layers], ["plane", "x", "y", *names])

    return planes.tiles.mapInArrow(run, f"plane long, x long, y long, {', '.join(f'{c} {number}' for c in names)}")


def with_halo(planes: Planes, halo: int, f: Callable[[list, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """f([plane, ty, tx], the tile with its halo, which of that is inside the plane) of every tile.

    Each tile sends its neighbours no more than the strips they need.
    """
    size, reach = planes.tile, -(-halo // planes.tile)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, ty, tx, body in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "body")), strict=True):
                a, out = planes.array(ty, tx, body), []
                for ny in range(max(0, ty - reach), min(planes.rows, ty + reach + 1)):
                    for nx in range(max(0, tx - reach), min(planes.columns, tx + reach + 1)):
                        y0, x0 = max(0, ny * size - halo - ty * size), max(0, nx * size - halo - tx * size)
                        y1, x1 = ny * size + size + halo - ty * size, nx * size + size + halo - tx * size
                        part = a[:, y0:y1, x0:x1]
                        if part.size:
                            out.append((plane, ny, nx, ty * size + y0 - ny * size + halo, tx * size + x0 - nx * size + halo, part.shape[1], part.shape[2], part.tobytes()))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.int32()) for c in cols[1:7]), pa.array(cols[7], pa.binary())], [*KEYS, "oy", "ox", "h", "w", "part"])

    def put(rows: pa.Table) -> pa.Table:
        key = [rows[c][0].as_py() for c in KEYS]
        depth, h, w = planes.shape(key[1], key[2])
        a, inside = np.zeros((depth, h + 2 * halo, w + 2 * halo), planes.kind), np.zeros((h + 2 * halo, w + 2 * halo), bool)
        for oy, ox, ph, pw, part in zip(*(rows[c].to_pylist() for c in ("oy", "ox", "h", "w", "part")), strict=True):
            whole = np.frombuffer(part, planes.kind).reshape(depth, ph, pw)[:, : a.shape[1] - oy, : a.shape[2] - ox]
            a[:, oy : oy + ph, ox : ox + pw] = whole
            inside[oy : oy + ph, ox : ox + pw] = True
        return f(key, a, inside)

    sent = planes.tiles.mapInArrow(send, "plane long, ty int, tx int, oy int, ox int, h int, w int, part binary")
    return sent.groupBy(*KEYS).applyInArrow(put, schema)


def stencil(planes: Planes, halo: int, f: Callable[[np.ndarray, np.ndarray], np.ndarray], depth: int = 1, kind: str | None = None) -> Planes:
    """Planes of f(tile with its halo, inside), cut to the tile."""
    kind = kind or planes.kind

    def one(key: list, a: np.ndarray, inside: np.ndarray) -> pa.Table:
        got = f(a, inside)
        return _tile(key, np.ascontiguousarray(got[:, halo : got.shape[1] - halo, halo : got.shape[2] - halo], kind))

    tiles = with_halo(planes, halo, one, "plane long, ty int, tx int, body binary")
    return replace(planes, tiles=_kept(tiles, "tiles"), depth=depth, kind=kind)


def shifted(a: np.ndarray, dy: int, dx: int, fill) -> np.ndarray:
    """b[y, x] = a[y + dy, x + dx], `fill` beyond."""
    out = np.full_like(a, fill)
    h, w = a.shape
    if abs(dy) < h and abs(dx) < w:
        out[max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)] = a[max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)]
    return out


def over_disk(a: np.ndarray, radius: int, best: np.ufunc, worst: int) -> np.ndarray:
    """The best value within a disk around each pixel.  Each half-width of a row of the disk is widened from the one before."""
    out, wide, reached = a.copy(), a.copy(), 0
    for dy in sorted(range(-radius, radius + 1), key=abs, reverse=True):
        half = int((radius * radius - dy * dy) ** 0.5)
        while reached < half:
            reached += 1
            wide = best(wide, best(shifted(a, 0, reached, worst), shifted(a, 0, -reached, worst)))
        out = best(out, shifted(wide, dy, 0, worst))
    return out


def closed(a: np.ndarray, inside: np.ndarray, radius: int) -> np.ndarray:
    """Greatest within a disk, then least; what is outside counts for neither."""
    low, high = np.iinfo(a.dtype).min, np.iinfo(a.dtype).max
    most = over_disk(np.where(inside, a, low), radius, np.maximum, low)
    return over_disk(np.where(inside, most, high), radius, np.minimum, high)


def closing(planes: Planes, radius: int, inverted: bool = False) -> Planes:
    """Morphological closing by a disk, one minus that if asked for; both passes share one exchange."""

    def f(a: np.ndarray, inside: np.ndarray) -> np.ndarray:
        got = np.stack([closed(v, inside, radius) for v in a])
        return 1 - got if inverted else got

    return stencil(planes, 2 * radius, f, planes.depth)


def labelled(mask: np.ndarray) -> np.ndarray:
    """Components of a mask, corners included: 0 outside, then 1, 2, .. in the order of first pixels.  Runs of rows are linked, not pixels."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    at = row * (w + 2)
    first, last = np.searchsorted(at + end, at + w + 2 + start), np.searchsorted(at + start, at + w + 2 + end, side="right")
    n = np.maximum(last - first, 0)
    i = np.repeat(np.arange(len(row)), n)
    j = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    top = np.arange(len(row))
    while len(i):
        a, b = top[i], top[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
        while (top[top] != top).any():
            top = top[top]
    number = np.unique(top, return_inverse=True)[1] + 1
    out = np.zeros((h, w + 1), np.int64)
    np.add.at(out, (row, start), number)
    np.add.at(out, (row, end), -number)
    return np.cumsum(out, axis=1)[:, :w]


def area_closing(planes: Planes, area: int) -> Planes:
    """Each pixel's least level, from its own up, at which it is in a component (corners included) of `area` pixels or more of that level or
    below; the plane's greatest value where there is none.

    Tiles label components of every level by themselves; links over tiles' borders join them, and sizes are summed by component.
    """
    levels = sorted({r["v"] for r in unpacked(planes).select("v").distinct().limit(MOST_LEVELS + 1).collect()})
    if len(levels) > MOST_LEVELS:
        raise ValueError(f"more than {MOST_LEVELS} different values")
    if planes.tile > 1024:
        raise ValueError("tiles of more than 1024 pixels a side")
    greatest = unpacked(planes).groupBy("plane").agg(F.max("v").alias("greatest"))
    low = levels[:-1]
    if not low:
        return planes
    local = stencil(planes, 0, lambda a, inside: np.stack([labelled(a[0] <= t) for t in low]), len(low))

    def node(plane: int, ty: int, tx: int) -> int:
        """The number of a tile's first component of the lowest level."""
        return ((plane * planes.rows + ty) * planes.columns + tx) * len(low) << 20

    def sizes(key: list, a: np.ndarray, inside: np.ndarray) -> pa.Table:
        parts = [(node(*key) + (k << 20) + np.arange(v.max(initial=0) + 1)[1:], np.bincount(v.ravel())[1:]) for k, v in enumerate(a)]
        return pa.table([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts, strict=True)], names=["node", "size"])

    def links(key: list, a: np.ndarray, inside: np.ndarray) -> pa.Table:
        found = [np.zeros((0, 2), np.int64)]
        h, w = a.shape[1] - 2, a.shape[2] - 2
        for k, v in enumerate(a):
            for ey, ex, ys, xs in ((1, 0, slice(h, h + 1), slice(1, w + 1)), (0, 1, slice(1, h + 1), slice(w, w + 1))):  # towards the tiles below and to the right
                for off in (-1, 0, 1):
                    dy, dx = (1, off) if ey else (off, 1)
                    y, x = np.broadcast_arrays(np.arange(ys.start, ys.stop)[:, None], np.arange(xs.start, xs.stop)[None])
                    p, q = v[y, x].ravel().astype(np.int64), v[y + dy, x + dx].ravel().astype(np.int64)  # numbers of nodes are beyond 32 bits
                    ny, nx = key[1] + (y + dy > h).ravel() - (y + dy < 1).ravel(), key[2] + (x + dx > w).ravel() - (x + dx < 1).ravel()
                    ok = (p > 0) & (q > 0)
                    if ok.any():
                        there = node(key[0], 0, 0) + ((ny * planes.columns + nx)[ok] * len(low) << 20)
                        found.append(np.unique(np.stack((node(*key) + (k << 20) + p[ok], there + (k << 20) + q[ok]), 1), axis=0))
        both = np.concatenate(found)
        return pa.table([pa.array(np.ascontiguousarray(both[:, i])) for i in (0, 1)], names=["a", "b"])

    size = with_halo(local, 0, sizes, "node long, size long")
    joined = components(with_halo(local, 1, links, "a long, b long"))
    size = _kept(size.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")), "sizes")
    large = size.groupBy("component").agg(F.sum("size").alias("all")).where(F.col("all") >= area)
    of_tile = F.expr(f"(node >> 20) div {len(low)}")
    large = size.join(large, "component").groupBy(of_tile.alias("at")).agg(F.collect_list("node").alias("nodes"))  # of a tile, whose pixels bound them
    at = (F.col("plane") * planes.rows + F.col("ty")) * planes.columns + F.col("tx")
    both = planes.tiles.join(local.tiles.withColumnRenamed("body", "marks"), KEYS).withColumn("at", at).join(large, "at", "left").join(greatest, "plane")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, ty, tx, body, marks, nodes, most in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "body", "marks", "nodes", "greatest")), strict=True):
                v, mark = planes.array(ty, tx, body)[0], local.array(ty, tx, marks)
                out, own = np.full(v.shape, most, v.dtype), np.array(nodes or [], np.int64) - node(plane, ty, tx)
                for k in reversed(range(len(low))):
                    out[(v <= low[k]) & np.isin(mark[k], own[own >> 20 == k] & ((1 << 20) - 1)) & (mark[k] > 0)] = low[k]
                yield from _tile([plane, ty, tx], out).to_batches()

    tiles = both.select(*KEYS, "body", "marks", "nodes", "greatest").mapInArrow(fill, "plane long, ty int, tx int, body binary")
    return replace(planes, tiles=_kept(tiles, "tiles"))


#: Lines of three pixels through a pixel: both diagonals, upright and level.
_LINES = (((-1, -1), (0, 0), (1, 1)), ((-1, 1), (0, 0), (1, -1)), ((-1, 0), (0, 0), (1, 0)), ((0, -1), (0, 0), (0, 1)))


def _lines(u: np.ndarray, inside: np.ndarray, erode: bool) -> np.ndarray:
    """Any line of which all pixels are set (erode), or whether every line has a set pixel; beyond the plane none is."""
    each = [np.logical_and.reduce([shifted(u, dy, dx, False) for dy, dx in line]) if erode else np.logical_or.reduce([shifted(u, dy, dx, False) for dy, dx in line]) for line in _LINES]
    return (np.logical_or.reduce(each) if erode else np.logical_and.reduce(each)) & inside


def _slope(a: np.ndarray, inside: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """Central differences, one-sided at the plane's edge."""
    a = a.astype(float)
    after, before = shifted(a, dy, dx, 0), shifted(a, -dy, -dx, 0)
    has_after, has_before = shifted(inside, dy, dx, False), shifted(inside, -dy, -dx, False)
    up = np.where(has_after, after, a)
    down = np.where(has_before, before, a)
    return (up - down) / np.where(has_after & has_before, 2.0, 1.0)


def evolved(u: np.ndarray, image: np.ndarray, inside: np.ndarray, rounds: int, balloon: float, threshold: float, smoothing: int, turn: int) -> np.ndarray:
    """`rounds` steps of a geodesic contour (a set u) on an image: it grows or shrinks where the image is above threshold / |balloon|, is drawn
    along the image's slopes, and is smoothed by lines of three pixels, in one order and the other by turns.  A step reaches 2 + 2 * smoothing pixels.
    """
    u = u & inside
    far, sy, sx = image > threshold / abs(balloon) if balloon else None, _slope(image, inside, 1, 0), _slope(image, inside, 0, 1)
    square = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    for _ in range(rounds):
        if balloon:
            around = [shifted(u, dy, dx, False) for dy, dx in square]
            u = np.where(far, np.logical_or.reduce(around) if balloon > 0 else np.logical_and.reduce(around), u) & inside
        pull = sy * _slope(u, inside, 1, 0) + sx * _slope(u, inside, 0, 1)
        u = np.where(pull > 0, True, np.where(pull < 0, False, u)) & inside
        for _ in range(smoothing):
            order = (False, True) if turn % 2 == 0 else (True, False)
            for erode in order:
                u = _lines(u, inside, erode)
            turn += 1
    return u


def geodesic_contour(planes: Planes, rounds: int = 5, balloon: float = 0.8, threshold: float = 0.5, smoothing: int = 1) -> Planes:
    """`evolved` of planes of two layers (the set, the image); as many rounds share an exchange as a halo of half a tile has room for."""
    step = 2 + 2 * smoothing
    at_once, done = max(1, planes.tile // 2 // step), 0
    while done < rounds:
        n, turn = min(at_once, rounds - done), done * smoothing
        planes = stencil(planes, n * step, lambda a, inside, n=n, turn=turn: np.stack([evolved(a[0] > 0, a[1], inside, n, balloon, threshold, smoothing, turn), a[1]]), 2)
        done += n
    return stencil(planes, 0, lambda a, inside: a[:1])


def foreground_separation(planes: Planes, disks: tuple[int, ...] = (1, 2, 20, 10), areas: tuple[int, int] = (20000, 1000)) -> Planes:
    """1 where a thresholded plane (small integers) is foreground: closings by disks, each inverted, an area closing, a contour that is held
    by the plane's own edges, another area closing, inverted.
    """
    now = planes
    for radius in disks:
        now = closing(now, radius, inverted=True)
    now = area_closing(now, areas[0])
    start = now.tiles.join(planes.tiles.withColumnRenamed("body", "image"), KEYS)

    def stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, ty, tx, body, image in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "body", "image")), strict=True):
                yield from _tile([plane, ty, tx], np.concatenate((1 - now.array(ty, tx, body) > 0, 1 - planes.array(ty, tx, image))).astype(planes.kind)).to_batches()

    tiles = _kept(start.select(*KEYS, "body", "image").mapInArrow(stack, "plane long, ty int, tx int, body binary"), "tiles")
    shape = geodesic_contour(replace(planes, tiles=tiles, depth=2))
    return stencil(area_closing(shape, areas[1]), 0, lambda a, inside: 1 - a)


def thresholded(pixels: DataFrame, channels: list[str], least: float = 0.1) -> DataFrame:
    """plane, x, y, v: in how many channels a pixel is above its plane's mean; 0 where that is no more than `least` of them, rounded."""
    means = pixels.groupBy("plane").agg(*[F.avg(c).alias(f"_{c}") for c in channels])
    above = sum((F.coalesce((F.col(c) > F.col(f"_{c}")).cast("int"), F.lit(0)) for c in channels), F.lit(0))
    rows = pixels.join(means, "plane").select("plane", "x", "y", above.alias("v"))
    return rows.withColumn("v", F.when(F.col("v") <= round(len(channels) * least), 0).otherwise(F.col("v")))


def nearest_labels(label: np.ndarray, reach: int) -> np.ndarray:
    """Each pixel's nearest label at most `reach` away, the least of equals, 0 for none: nearest in the row first, then over rows."""
    h, w = label.shape
    far = np.int64(1) << 40
    x = np.arange(w)
    last = np.maximum.accumulate(np.where(label != 0, x, -1), axis=1)
    after = np.minimum.accumulate(np.where(label != 0, x, w)[:, ::-1], axis=1)[:, ::-1]
    left, right = np.where(last >= 0, (x - last) ** 2, far), np.where(after < w, (after - x) ** 2, far)
    row = np.arange(h)[:, None]
    names = label[row, np.maximum(last, 0)], label[row, np.minimum(after, w - 1)]
    use = (right < left) | ((right == left) & (names[1] < names[0]))
    away, name = np.where(use, right, left), np.where(use, names[1], names[0])
    best, out = away.copy(), name.copy()
    for dy in range(1, min(reach, h - 1) + 1):
        for step in (dy, -dy):
            d, n = shifted(away, step, 0, far) + dy * dy, shifted(name, step, 0, 0)
            better = (d < best) | ((d == best) & (n < out))
            best, out = np.where(better, d, best), np.where(better, n, out)
    return np.where(best <= reach * reach, out, 0)


def grown(pixels: DataFrame, height: int, width: int, reach: int, tile: int = TILE) -> DataFrame:
    """plane, x, y, label of every pixel of the plane: its own label, or the nearest at most `reach` away, the least of equals, else 0.

    A tile and its halo get one pass over rows and one over columns; rows shuffled are tiles and strips, whatever the reach.
    """
    labels = packed(pixels, height, width, tile, ["label"], "<i8")
    return unpacked(stencil(labels, reach, lambda a, inside: nearest_labels(a[0], reach)[None]), ["label"])


def plane_of(x: Column, y: Column, value: Column, plane: Column | None = None) -> list[Column]:
    """Columns of a pixel table."""
    return [(plane if plane is not None else F.lit(0)).cast("long").alias("plane"), x.cast("long").alias("x"), y.cast("long").alias("y"), value.alias("v")]
