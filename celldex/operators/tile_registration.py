"""Registration of slides by tiles: coarse anchor, tile residuals, transform and mesh, warps of all channels.

Slides are planes (`planes`); each has a transform and a mesh, which are small (a shift a tile) and go with the
tasks.  Everything of the size of a slide stays in tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .matching import _kept
from .planes import KEYS, Planes, _tile, with_halo
from .registration import Mesh, control_grid, fitted, moved, residual, source, strip_residuals

#: Pixels of a thumbnail that a task holds whole.
MOST_WHOLE = 1 << 20

Moves = dict[int, tuple[np.ndarray, Mesh | None]]


def grid(planes: Planes) -> DataFrame:
    """plane, ty, tx of every tile, from the planes there are."""
    rows = planes.tiles.select("plane").distinct().select("plane", F.explode(F.sequence(F.lit(0), F.lit(planes.rows - 1))).alias("ty"))
    return rows.select("plane", "ty", F.explode(F.sequence(F.lit(0), F.lit(planes.columns - 1))).alias("tx"))


def _places(layout: Planes, shape: tuple[int, int], moves: Moves, plane: int, ty: int, tx: int) -> np.ndarray:
    """Where each pixel of a target tile lies in the moving plane (of shape height, width), kept within it."""
    _, h, w = layout.shape(ty, tx)
    y, x = np.indices((h, w)) + np.array([ty, tx])[:, None, None] * layout.tile
    m, mesh = moves[plane]
    at = source(m, mesh, np.column_stack((x.ravel(), y.ravel())).astype(float))
    return np.clip(at, 0, np.array(shape[::-1]) - 1.0)


def warped_planes(planes: Planes, moves: Moves, height: int, width: int) -> Planes:
    """All layers of planes in the reference's frame (height, width), sampled bilinearly; beyond the edge counts the nearest.

    Target tiles are made in the tasks.  Each works out the window it draws from, and asks the source tiles there
    once for all layers; they send it their part of the window.
    """
    layout, shape, size = replace(planes, height=height, width=width), (planes.height, planes.width), planes.tile

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, ty, tx in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = _places(layout, shape, moves, plane, ty, tx)
                x0, y0 = np.floor(at.min(0)).astype(int).tolist()
                x1, y1 = (np.minimum(np.floor(at.max(0)) + 1, np.array(shape[::-1]) - 1).astype(int) + 1).tolist()
                rows = [(plane, sy, sx, ty, tx, x0, y0, x1, y1) for sy in range(y0 // size, (y1 - 1) // size + 1) for sx in range(x0 // size, (x1 - 1) // size + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.int32()) for i, c in enumerate(zip(*rows, strict=True))], [*KEYS, "py", "px", "x0", "y0", "x1", "y1"])

    def crop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, sy, sx, py, px, x0, y0, x1, y1, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, oy, ox = planes.array(sy, sx, body), sy * size, sx * size
                part = a[:, max(0, y0 - oy) : y1 - oy, max(0, x0 - ox) : x1 - ox]
                row = (plane, py, px, x0, y0, x1, y1, max(ox, x0), max(oy, y0), part.shape[1], part.shape[2])
                yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64() if i == 0 else pa.int32()) for i, v in enumerate(row)), pa.array([part.tobytes()], pa.binary())], [*KEYS, "x0", "y0", "x1", "y1", "x", "y", "h", "w", "part"])

    def sample(rows: pa.Table) -> pa.Table:
        plane, ty, tx, x0, y0, x1, y1 = (rows[c][0].as_py() for c in (*KEYS, "x0", "y0", "x1", "y1"))
        a = np.zeros((planes.depth, y1 - y0, x1 - x0))
        for x, y, h, w, part in zip(*(rows[c].to_pylist() for c in ("x", "y", "h", "w", "part")), strict=True):
            a[:, y - y0 : y - y0 + h, x - x0 : x - x0 + w] = np.frombuffer(part, planes.kind).reshape(planes.depth, h, w)
        at = _places(layout, shape, moves, plane, ty, tx)
        low = np.floor(at).astype(int)
        high, (t, u) = np.minimum(low + 1, np.array(shape[::-1]) - 1), (at - low).T
        (lx, ly), (hx, hy) = (low - (x0, y0)).T, (high - (x0, y0)).T
        out = (a[:, ly, lx] * (1 - t) + a[:, ly, hx] * t) * (1 - u) + (a[:, hy, lx] * (1 - t) + a[:, hy, hx] * t) * u
        return _tile([plane, ty, tx], out.reshape(layout.shape(ty, tx)))

    asked = grid(replace(layout, tiles=planes.tiles)).mapInArrow(ask, "plane long, ty int, tx int, py int, px int, x0 int, y0 int, x1 int, y1 int")
    met = asked.join(planes.tiles, KEYS).select(*KEYS, "py", "px", "x0", "y0", "x1", "y1", "body")
    parts = met.mapInArrow(crop, "plane long, ty int, tx int, x0 int, y0 int, x1 int, y1 int, x int, y int, h int, w int, part binary")
    tiles = parts.groupBy(*KEYS).applyInArrow(sample, "plane long, ty int, tx int, body binary")
    return replace(layout, tiles=_kept(tiles, "tiles"), kind="<f8")


def layer(planes: Planes, i: int) -> Planes:
    """One layer of planes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, ty, tx, body in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "body")), strict=True):
                yield from _tile([plane, ty, tx], planes.array(ty, tx, body)[i : i + 1]).to_batches()

    return replace(planes, tiles=planes.tiles.mapInArrow(cut, "plane long, ty int, tx int, body binary"), depth=1)


def stacked(a: Planes, b: Planes) -> Planes:
    """Layers of both, of one size, as doubles."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, ty, tx, one, two in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "body", "other")), strict=True):
                yield from _tile([plane, ty, tx], np.concatenate((a.array(ty, tx, one), b.array(ty, tx, two))).astype("<f8")).to_batches()

    both = a.tiles.join(b.tiles.withColumnRenamed("body", "other"), KEYS).select(*KEYS, "body", "other")
    return replace(a, tiles=_kept(both.mapInArrow(put, "plane long, ty int, tx int, body binary"), "tiles"), depth=a.depth + b.depth, kind="<f8")


def coarse_anchor(reference: Planes, moving: Planes, most: int = 256) -> DataFrame:
    """plane, dx, dy, tre, error: the shift that brings the first layer of moving onto reference's, from planes decimated by block means
    to `most` pixels a side; a task gets one slide's two thumbnails, or strips of them where they are large (`MOST_WHOLE` pixels).
    """
    high, wide = max(reference.height, moving.height), max(reference.width, moving.width)
    factor = -(-max(high, wide) // most)

    def blocks(planes: Planes, which: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for plane, ty, tx, body in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "body")), strict=True):
                    a = planes.array(ty, tx, body)[0].astype(float)
                    y, x = np.indices(a.shape)
                    wide_ = -(-wide // factor)
                    at = (y + ty * planes.tile) // factor * wide_ + (x + tx * planes.tile) // factor
                    ids, where = np.unique(at, return_inverse=True)
                    total = np.bincount(where.ravel(), a.ravel())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), plane, np.int64)), pa.array(ids // wide_), pa.array(ids % wide_), pa.array(total), pa.array(np.bincount(where.ravel()).astype(float))], ["plane", "y", "x", "total", "n"])

        rows = planes.tiles.mapInArrow(run, "plane long, y long, x long, total double, n double")
        return rows.groupBy("plane", "y", "x").agg((F.sum("total") / F.sum("n")).alias("v")).withColumn("which", F.lit(which))

    def measure(rows: pa.Table) -> pa.Table:
        both = np.zeros((2, -(-high // factor), -(-wide // factor)))
        for i, which in enumerate(("ref", "mov")):
            some = rows.filter(pa.compute.equal(rows["which"], which))
            both[i, some["y"].to_numpy(), some["x"].to_numpy()] = some["v"].to_numpy()
        dx, dy, tre, error = residual(both[0], both[1])
        return pa.table({"plane": [rows["plane"][0].as_py()], "dx": [dx * factor], "dy": [dy * factor], "tre": [tre * factor], "error": [error]})

    both = blocks(reference, "ref").unionByName(blocks(moving, "mov"))
    h, w = -(-high // factor), -(-wide // factor)
    if h * w > MOST_WHOLE:
        return strip_residuals(both, h, w).select("plane", *[(F.col(c) * factor).alias(c) for c in ("dx", "dy", "tre")], "error")
    return both.groupBy("plane").applyInArrow(measure, "plane long, dx double, dy double, tre double, error double")


def tile_controls(both: Planes, halo: int, upsample: int = 10) -> DataFrame:
    """plane, ix, iy, cx, cy, dx, dy, tre, error of each tile of planes of two layers (reference, moving): measured on the tile and its halo."""
    size = both.tile

    def measure(key: list, a: np.ndarray, inside: np.ndarray) -> pa.Table:
        rows, columns = inside.any(1), inside.any(0)
        a = a[:, rows][:, :, columns].astype(float)
        _, h, w = both.shape(key[1], key[2])
        dx, dy, tre, error = residual(a[0], a[1], upsample)
        out = {"plane": key[0], "ix": key[2], "iy": key[1], "cx": key[2] * size + (w - 1) / 2, "cy": key[1] * size + (h - 1) / 2, "dx": dx, "dy": dy, "tre": tre, "error": error}
        return pa.Table.from_pylist([out], pa.schema([("plane", pa.int64()), ("ix", pa.int32()), ("iy", pa.int32()), *[(c, pa.float64()) for c in ("cx", "cy", "dx", "dy", "tre", "error")]]))

    return with_halo(both, halo, measure, "plane long, ix int, iy int, cx double, cy double, dx double, dy double, tre double, error double")


@dataclass
class Registered:
    """Of each slide: its transform and mesh, what was measured at each step, and the moving layers in the reference's frame."""

    moves: Moves
    anchors: DataFrame
    steps: dict[str, DataFrame] = field(default_factory=dict)
    planes: Planes | None = None

    def report(self) -> DataFrame:
        """plane, step, tiles, tre_mean, tre_worst, error_mean."""
        rows = None
        for name, controls in self.steps.items():
            by = controls.groupBy("plane").agg(F.count("*").alias("tiles"), F.avg("tre").alias("tre_mean"), F.max("tre").alias("tre_worst"), F.avg("error").alias("error_mean")).withColumn("step", F.lit(name))
            rows = by if rows is None else rows.unionByName(by)
        return rows.select("plane", "step", "tiles", "tre_mean", "tre_worst", "error_mean")


def register(reference: Planes, moving: Planes, halo: int = 64, gate: float = 0.3, most_error: float | None = 0.95, most: float | None = None, model: str | None = "affine") -> Registered:
    """Brings moving (all layers) onto reference by their first layers: coarse anchor, tile residuals, a transform of least squares over the
    trusted tiles (`model`; none leaves the anchor), residuals again, the mesh of what is left, and a last measure of what that leaves.

    What comes to the driver is a row a tile and slide, as the mesh is.
    """
    first = _kept(layer(moving, 0).tiles, "tiles")
    first = replace(moving, tiles=first, depth=1)
    anchors = _kept(coarse_anchor(layer(reference, 0), first), "anchors")
    shift = lambda dx, dy: np.array([[1.0, 0, dx], [0, 1, dy], [0, 0, 1]])
    moves: Moves = {r["plane"]: (shift(r["dx"], r["dy"]), None) for r in anchors.collect()}
    out = Registered(moves, anchors)
    most = most if most is not None else 0.5 * reference.tile

    def measured(name: str) -> DataFrame:
        both = stacked(layer(reference, 0), warped_planes(first, out.moves, reference.height, reference.width))
        out.steps[name] = _kept(tile_controls(both, halo), "controls")
        return out.steps[name]

    controls = measured("anchor")
    if model:
        for plane, (m, _) in list(out.moves.items()):
            rows = controls.where((F.col("plane") == plane) & (F.col("error") <= (most_error if most_error is not None else 1.0)) & (F.col("tre") < most)).toPandas()
            if len(rows) >= 4:
                at = rows[["cx", "cy"]].to_numpy()
                out.moves[plane] = (fitted(moved(np.linalg.inv(m), at - rows[["dx", "dy"]].to_numpy()), at, model), None)
        controls = measured("transform")
    for plane, (m, _) in list(out.moves.items()):
        nodes = control_grid(controls.where(F.col("plane") == plane), gate, most_error, most).toPandas().sort_values(["iy", "ix"])
        ny, nx = nodes["iy"].nunique(), nodes["ix"].nunique()
        out.moves[plane] = (m, Mesh(np.sort(nodes["cx"].unique()), np.sort(nodes["cy"].unique()), nodes[["dx", "dy"]].to_numpy().reshape(ny, nx, 2)))
    measured("mesh")
    out.planes = warped_planes(moving, out.moves, reference.height, reference.width)
    return out
