"""Registration of planes: control points, transforms from matches, tile residuals, meshes and warps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .measure import quantiles
from .pairing import _kept
from .raster import median_filter

SEPARATION = 4.0


def accepted(dx: Column, dy: Column, error: Column, most_error: float | None, most: float | None) -> Column:
    """Why a control point isn't trusted ("disp": its shift is `most` or more, "error": above `most_error`, or NaN), NULL if it is.

    A point without an error (NULL) is trusted if its shift is short enough.
    """
    far = F.coalesce(F.hypot(dx, dy) >= most, F.lit(True)) if most is not None else F.lit(False)
    poor = error.isNotNull() & (F.isnan(error) | (error > most_error)) if most_error is not None else F.lit(False)
    return F.when(far, "disp").when(poor, "error")


def control_grid(points: DataFrame, gate: float, most_error: float | None = None, most: float | None = None, radius: int = 1) -> DataFrame:
    """ix, iy, cx, cy, dx, dy: the mesh of control points (ix, iy, cx, cy, dx, dy, tre, error).

    Trusted points below the gate count as not shifted; shifts are then medians of the trusted points
    around.  Points that aren't trusted don't shift and count for none.
    """
    rows = points.withColumn("why", accepted(F.col("dx"), F.col("dy"), F.col("error"), most_error, most))
    ok = F.col("why").isNull()
    gated = rows.withColumns({c: F.when(ok & (F.col("tre") >= gate), F.col(c).cast("double")).otherwise(0.0) for c in ("dx", "dy")})
    out = gated.select("ix", "iy", "cx", "cy", ok.alias("ok"))
    for c in ("dx", "dy"):
        med = median_filter(gated.select(F.col("ix").alias("x"), F.col("iy").alias("y"), F.col(c).alias("v"), ok.alias("ok")), F.col("ok"), radius)
        out = out.join(med.select(F.col("x").alias("ix"), F.col("y").alias("iy"), F.col("v").alias(c)), ["ix", "iy"], "left")
    return out.select("ix", "iy", "cx", "cy", *[F.when(F.col("ok"), F.col(c)).otherwise(0.0).alias(c) for c in ("dx", "dy")])


def gate_counts(points: DataFrame, most_error: float | None, most: float | None) -> DataFrame:
    """accepted, n_error, n_disp, n_legacy: how control points fared at the gates."""
    why = accepted(F.col("dx"), F.col("dy"), F.col("error"), most_error, most)
    return points.agg(F.count_if(why.isNull()).alias("accepted"), F.count_if(why == "error").alias("n_error"), F.count_if(why == "disp").alias("n_disp"), F.count_if(F.col("error").isNull() & why.isNull()).alias("n_legacy"))


def otsu_fraction(counts: np.ndarray) -> float:
    """The share above the cut of most variance between classes of a histogram; 0 unless they are `SEPARATION` deviations apart."""
    n, at = counts.astype(float), np.arange(len(counts)) + 0.5
    low, low_sum, low_square = np.cumsum(n), np.cumsum(n * at), np.cumsum(n * at * at)
    high = low[-1] - low
    real = (low > 0) & (high > 0)
    if not real.any():
        return 0.0
    a, b = low_sum / np.maximum(low, 1), (low_sum[-1] - low_sum) / np.maximum(high, 1)
    k = int(np.where(real, low * high * (a - b) ** 2, -1).argmax())
    spread = (low_square[k] - low[k] * a[k] ** 2) + (low_square[-1] - low_square[k] - high[k] * b[k] ** 2)
    return float(high[k] / low[-1]) if b[k] - a[k] >= SEPARATION * np.sqrt(max(spread, 0.0) / low[-1]) + 1e-12 else 0.0


def foreground(tiles: DataFrame, tile: str, value: str, bins: int = 256) -> DataFrame:
    """tile, fraction: how much of each tile is foreground; 0 for constant tiles and those without two classes.

    Spark bins the pixels; a task gets a tile's `bins` counts.
    """
    ends = tiles.groupBy(tile).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = tiles.join(ends, tile).where("hi - lo >= 1e-9").groupBy(tile, at.alias("bin")).agg(F.count("*").alias("n"))

    def cut(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros(bins)
        n[frame["bin"]] = frame["n"]
        return pd.DataFrame({tile: [key[0]], "fraction": [otsu_fraction(n)]})

    kind = tiles.schema[tile].dataType.simpleString()
    found = counts.groupBy(tile).applyInPandas(cut, f"{tile} {kind}, fraction double")
    return ends.select(tile).join(found, tile, "left").withColumn("fraction", F.coalesce("fraction", F.lit(0.0)))


def _blurred(a: np.ndarray, sigma: float, axes: tuple[int, ...] = (0, 1)) -> np.ndarray:
    """Gaussian blur along axes, four deviations wide, the edges mirrored."""
    reach = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    k /= k.sum()
    for axis in axes:
        pad = [(reach, reach) if i == axis else (0, 0) for i in range(a.ndim)]
        a = np.apply_along_axis(np.convolve, axis, np.pad(a, pad, mode="symmetric"), k, "valid")
    return a


def residual(ref: np.ndarray, mov: np.ndarray, upsample: int = 10, sigma: float = 3.0) -> tuple[float, float, float, float]:
    """dx, dy that bring mov onto ref, their length, and the correlation's error (0 the same, 1 nothing in common, NaN if one is blank).

    Both are cleared of slow changes, tapered to the edges, and correlated by Fourier transforms; the peak is
    refined on a grid `upsample` times as fine around it.
    """
    if ref.size == 0 or mov.size == 0:
        return 0.0, 0.0, 0.0, float("nan")
    f, g = (np.fft.fft2((x - _blurred(x, sigma)) * np.outer(_taper(x.shape[0]), _taper(x.shape[1]))) for x in (ref.astype(float), mov.astype(float)))
    both = f * g.conj()
    h, w = ref.shape
    peak = np.unravel_index(np.abs(np.fft.ifft2(both)).argmax(), ref.shape)
    at, ey, ex = _around(peak, h, w, upsample)
    return _refined(ey @ both @ ex, at, upsample, float((np.abs(f) ** 2).sum() * (np.abs(g) ** 2).sum()))


def _taper(n: int) -> np.ndarray:
    return np.hanning(n + 1)[:-1] if n > 1 else np.ones(1)


def _fine(upsample: int) -> np.ndarray:
    return np.arange(-1.5, 1.5 + 0.5 / upsample, 1 / upsample)


def _around(peak: tuple[int, int], h: int, w: int, upsample: int) -> tuple[tuple[int, int], np.ndarray, np.ndarray]:
    """The shift (y, x) of a peak, and what turns products of spectra into correlations around it: from the left and from the right."""
    y, x = (int(v) - n if v > n // 2 else int(v) for v, n in zip(peak, (h, w), strict=True))
    fine = _fine(upsample)
    return (y, x), np.exp(2j * np.pi * np.outer(np.round(y * upsample) / upsample + fine, np.fft.fftfreq(h))), np.exp(2j * np.pi * np.outer(np.fft.fftfreq(w), np.round(x * upsample) / upsample + fine))


def _refined(near: np.ndarray, at: tuple[int, int], upsample: int, power: float) -> tuple[float, float, float, float]:
    i, j = np.unravel_index(np.abs(near).argmax(), near.shape)
    fine = _fine(upsample)
    dy, dx = float(at[0] + fine[i]), float(at[1] + fine[j])
    error = float(np.sqrt(abs(1 - np.abs(near[i, j]) ** 2 / power))) if power > 0 else float("nan")
    return dx, dy, float(np.hypot(dx, dy)), error


#: Numbers of a plane that a strip of whole rows or columns holds, unless one row or column alone has more.
STRIP = 1 << 18


def strip_residuals(pixels: DataFrame, h: int, w: int, upsample: int = 10, sigma: float = 3.0) -> DataFrame:
    """plane, dx, dy, tre, error: `residual` of large planes' pixels (plane, which: ref or mov, y, x, v), those that aren't there 0.

    Blurs and Fourier transforms go along rows, then along columns; a task holds a strip of whole rows or columns, and
    strips are cut into blocks to be put together the other way.
    """
    tall, wide = max(1, STRIP // w), max(1, STRIP // h)
    block = "plane long, to int, of int, body binary"

    def cut(plane: int, of: int, a: np.ndarray, axis: int) -> pa.Table:
        """A strip's blocks along its axis, each for a strip the other way."""
        size = wide if axis == 2 else tall
        bodies = [np.ascontiguousarray(np.take(a, range(s, min(s + size, a.shape[axis])), axis)).tobytes() for s in range(0, a.shape[axis], size)]
        n = len(bodies)
        return pa.table([pa.array([plane] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([of] * n, pa.int32()), pa.array(bodies, pa.binary())], names=["plane", "to", "of", "body"])

    def put(rows: pa.Table, depth: int, kind: type, axis: int) -> tuple[int, int, np.ndarray]:
        """plane, place and numbers of the strip that blocks along an axis make."""
        plane, to = rows["plane"][0].as_py(), rows["to"][0].as_py()
        shape = (depth, h, min(wide, w - to * wide)) if axis == 1 else (depth, min(tall, h - to * tall), w)
        out, size = np.zeros(shape, kind), tall if axis == 1 else wide
        for of, body in zip(rows["of"].to_pylist(), rows["body"].to_pylist(), strict=True):
            part = (slice(None), slice(of * size, (of + 1) * size)) if axis == 1 else (slice(None), slice(None), slice(of * size, (of + 1) * size))
            out[part] = np.frombuffer(body, kind).reshape(out[part].shape)
        return plane, to, out

    def rows_in(rows: pa.Table) -> pa.Table:
        plane, of = rows["plane"][0].as_py(), rows["of"][0].as_py()
        a = np.zeros((4, min(tall, h - of * tall), w))  # both planes, and both blurred along rows
        a[pc.equal(rows["which"], "mov").to_numpy().astype(int), rows["y"].to_numpy() - of * tall, rows["x"].to_numpy()] = rows["v"].to_numpy()
        a[2:] = _blurred(a[:2], sigma, (2,))
        return cut(plane, of, a, 2)

    def columns_in(rows: pa.Table) -> pa.Table:
        plane, to, a = put(rows, 4, float, 1)
        x = a[:2] - _blurred(a[2:], sigma, (1,))
        return cut(plane, to, np.fft.fft(x * _taper(h)[:, None] * _taper(w)[to * wide : to * wide + x.shape[2]], axis=1), 1)

    def spectra(rows: pa.Table) -> pa.Table:
        plane, to, a = put(rows, 2, complex, 2)
        f, g = np.fft.fft(a, axis=2)
        power = [float((np.abs(v) ** 2).sum()) for v in (f, g)]
        return pa.table([pa.array([plane], pa.int64()), pa.array([to], pa.int32()), pa.array([(f * g.conj()).tobytes()], pa.binary()), *(pa.array([p]) for p in power)], names=["plane", "of", "body", "f", "g"])

    def rows_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for plane, of, body in zip(*(batch.column(c).to_pylist() for c in ("plane", "of", "body")), strict=True):
                yield from cut(plane, of, np.fft.ifft(np.frombuffer(body, complex).reshape(1, -1, w), axis=2), 2).to_batches()

    def peaks(rows: pa.Table) -> pa.Table:
        plane, to, a = put(rows, 1, complex, 1)
        a = np.abs(np.fft.ifft(a[0], axis=0))
        y, x = np.unravel_index(a.argmax(), a.shape)
        return pa.table({"plane": pa.array([plane], pa.int64()), "height": [float(a[y, x])], "y": pa.array([int(y)], pa.int64()), "x": pa.array([int(x) + to * wide], pa.int64())})

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for plane, of, body, f, g, y, x in zip(*(batch.column(c).to_pylist() for c in ("plane", "of", "body", "f", "g", "y", "x")), strict=True):
                _, ey, ex = _around((y, x), h, w, upsample)
                both = np.frombuffer(body, complex).reshape(-1, w)
                old = sums.get((plane, y, x), [0, 0.0, 0.0])
                sums[plane, y, x] = [old[0] + ey[:, of * tall : of * tall + len(both)] @ both @ ex, old[1] + f, old[2] + g]
        for (plane, y, x), (near, f, g) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([plane], pa.int64()), pa.array([y], pa.int64()), pa.array([x], pa.int64()), pa.array([near.tobytes()], pa.binary()), pa.array([f]), pa.array([g])], ["plane", "y", "x", "near", "f", "g"])

    def measure(rows: pa.Table) -> pa.Table:
        at, ey, _ = _around((rows["y"][0].as_py(), rows["x"][0].as_py()), h, w, upsample)
        near = sum(np.frombuffer(b, complex) for b in rows["near"].to_pylist()).reshape(len(ey), -1)
        dx, dy, tre, error = _refined(near, at, upsample, sum(rows["f"].to_pylist()) * sum(rows["g"].to_pylist()))
        return pa.table({"plane": [rows["plane"][0].as_py()], "dx": [dx], "dy": [dy], "tre": [tre], "error": [error]})

    strips = pixels.withColumn("of", F.floor(F.col("y") / tall).cast("int")).groupBy("plane", "of").applyInArrow(rows_in, block)
    columns = strips.groupBy("plane", "to").applyInArrow(columns_in, block)
    both = _kept(columns.groupBy("plane", "to").applyInArrow(spectra, "plane long, of int, body binary, f double, g double"), "spectra")
    back = both.mapInArrow(rows_back, block).groupBy("plane", "to").applyInArrow(peaks, "plane long, height double, y long, x long")
    peak = back.groupBy("plane").agg(F.max(F.struct("height", (-F.col("y")).alias("y"), (-F.col("x")).alias("x"))).alias("p")).select("plane", (-F.col("p.y")).alias("y"), (-F.col("p.x")).alias("x"))
    parts = both.join(F.broadcast(peak), "plane").mapInArrow(close, "plane long, y long, x long, near binary, f double, g double")
    return parts.groupBy("plane").applyInArrow(measure, "plane long, dx double, dy double, tre double, error double")


def tile_residuals(tiles: DataFrame, upsample: int = 10) -> DataFrame:
    """tile, dx, dy, tre, error of tiles' pixels (tile, x, y, ref, mov); a task gets a tile at a time, whose size is fixed."""

    def measure(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        y, x = (frame[c].to_numpy() - frame[c].min() for c in ("y", "x"))
        planes = np.zeros((2, y.max() + 1, x.max() + 1))
        planes[0, y, x], planes[1, y, x] = frame["ref"], frame["mov"]
        return pd.DataFrame([(key[0], *residual(*planes, upsample))], columns=["tile", "dx", "dy", "tre", "error"])

    kind = tiles.schema["tile"].dataType.simpleString()
    return tiles.groupBy("tile").applyInPandas(measure, f"tile {kind}, dx double, dy double, tre double, error double")


LEAST = {"euclidean": 2, "similarity": 2, "affine": 3}


def fitted(src: np.ndarray, dst: np.ndarray, model: str) -> np.ndarray:
    """The 3 x 3 transform of least squares from src to dst."""
    m = np.eye(3)
    if model == "affine":
        m[:2] = np.linalg.lstsq(np.column_stack([src, np.ones(len(src))]), dst, rcond=None)[0].T
        return m
    a, b = src - src.mean(0), dst - dst.mean(0)
    u, s, v = np.linalg.svd(b.T @ a / len(a))
    turn = np.diag([1.0, np.sign(np.linalg.det(u @ v)) or 1.0])
    scale = (s * np.diag(turn)).sum() / max(a.var(0).sum(), 1e-300) if model == "similarity" else 1.0
    m[:2, :2] = scale * u @ turn @ v
    m[:2, 2] = dst.mean(0) - m[:2, :2] @ src.mean(0)
    return m


def moved(m: np.ndarray, xy: np.ndarray) -> np.ndarray:
    return xy @ m[:2, :2].T + m[:2, 2]


def rms(away: np.ndarray) -> float:
    return float(np.sqrt((away**2).sum(1).mean())) if len(away) else float("nan")


def transform(src: np.ndarray, dst: np.ndarray, model: str = "euclidean", reach: float = 3.0, trials: int = 1000, seed: int = 0) -> tuple[np.ndarray, float, int]:
    """The transform that brings most of src within reach of dst, its residual there, and how many those are.

    Least sets are drawn `trials` times; the one of most followers, then the least residual, is fitted to all of them.
    """
    if model not in LEAST:
        raise ValueError(f"unknown model {model!r}; known: {', '.join(LEAST)}")
    n, best, inside = LEAST[model], (-1, 0.0), np.ones(len(src), bool)
    draw = np.random.default_rng(seed)
    for _ in range(trials if len(src) > n else 0):
        pick = draw.choice(len(src), n, replace=False)
        away = np.hypot(*(moved(fitted(src[pick], dst[pick], model), src) - dst).T)
        ok = away < reach
        score = (int(ok.sum()), -float((away[ok] ** 2).sum()))
        if score > best and ok.sum() >= n:
            best, inside = score, ok
    m = fitted(src[inside], dst[inside], model)
    return m, rms(moved(m, src[inside]) - dst[inside]), int(inside.sum())


def transforms(matches: DataFrame, key: str, model: str = "euclidean", reach: float = 3.0) -> DataFrame:
    """key, m (9 numbers, row by row), residual, inliers of the matches (sx, sy, dx, dy) of each slide; matches of a slide are bounded by its keypoints."""

    def fit(k: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["sx", "sy", "dx", "dy"])  # the same draw whatever the order of rows
        m, away, n = transform(frame[["sx", "sy"]].to_numpy(), frame[["dx", "dy"]].to_numpy(), model, reach)
        return pd.DataFrame({key: [k[0]], "m": [m.ravel().tolist()], "residual": [away], "inliers": [n]})

    kind = matches.schema[key].dataType.simpleString()
    return matches.groupBy(key).applyInPandas(fit, f"{key} {kind}, m array<double>, residual double, inliers long")


def full_scale(m: Column, factor: Column) -> Column:
    """A transform (9 numbers) of planes decimated by a factor, for whole ones: its offsets grow."""
    return F.transform(m, lambda v, i: F.when(i.isin(2, 5), v * factor).otherwise(v))


class Mesh:
    """Shifts (ny, nx, 2) at the nodes of two ascending grids, bilinear between them and constant beyond."""

    def __init__(self, xs: np.ndarray, ys: np.ndarray, shifts: np.ndarray):
        self.xs, self.ys, self.shifts = np.asarray(xs, float), np.asarray(ys, float), np.asarray(shifts, float)

    @staticmethod
    def _weights(v: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = np.clip(v, grid[0], grid[-1])
        hi = np.clip(np.searchsorted(grid, v, side="right"), min(1, len(grid) - 1), len(grid) - 1)
        lo = np.maximum(hi - 1, 0)
        return lo, hi, (v - grid[lo]) / np.where(grid[hi] > grid[lo], grid[hi] - grid[lo], 1.0)

    def __call__(self, xy: np.ndarray) -> np.ndarray:
        (i0, i1, t), (j0, j1, u) = self._weights(xy[:, 0], self.xs), self._weights(xy[:, 1], self.ys)
        t, u, d = t[:, None], u[:, None], self.shifts
        return (d[j0, i0] * (1 - t) + d[j0, i1] * t) * (1 - u) + (d[j1, i0] * (1 - t) + d[j1, i1] * t) * u


def source(m: np.ndarray, mesh: Mesh | None, xy: np.ndarray, rounds: int = 3) -> np.ndarray:
    """Where points of the reference lie in the moving plane: the mesh's shift is taken out by repeated guesses, then the transform."""
    v = xy
    for _ in range(rounds if mesh else 0):
        v = xy - mesh(v)
    return moved(np.linalg.inv(m), v)


def source_window(m: np.ndarray, mesh: Mesh | None, x: int, y: int, width: int, height: int, margin: int, shape: tuple[int, int]) -> tuple[int, int, int, int]:
    """x0, y0, x1, y1 of the moving plane (height, width of shape) that a tile of the reference draws from."""
    at = source(m, mesh, np.array([(x, y), (x + width, y), (x, y + height), (x + width, y + height)], float))
    low, high = np.floor(at.min(0)).astype(int) - margin, np.ceil(at.max(0)).astype(int) + margin
    return max(0, low[0]), max(0, low[1]), min(shape[1], high[0]), min(shape[0], high[1])


def warped(pixels: DataFrame, m: np.ndarray, mesh: Mesh | None, height: int, width: int, shape: tuple[int, int]) -> DataFrame:
    """x, y, v of a plane (height, width) in the reference's frame, sampled bilinearly from pixels (x, y, v) of a moving plane of this shape.

    Every target pixel knows its place in the moving plane, so it asks for the four pixels around it (those
    beyond the edge, the nearest) by an equi-join; sources and targets are spread alike, with no tiles to seam.
    The mesh has a bounded number of nodes, and goes with the task.
    """
    spark = pixels.sparkSession

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            target = np.column_stack([batch["id"] % width, batch["id"] // width])
            at = np.clip(source(m, mesh, target.astype(float)), 0, np.array(shape[::-1]) - 1.0)
            low = np.floor(at).astype(np.int64)
            high, part = np.minimum(low + 1, np.array(shape[::-1]) - 1), at - low
            for i, px in enumerate((low[:, 0], high[:, 0])):
                for j, py in enumerate((low[:, 1], high[:, 1])):
                    w = (part[:, 0] if i else 1 - part[:, 0]) * (part[:, 1] if j else 1 - part[:, 1])
                    some = w > 0
                    yield pd.DataFrame({"tx": target[some, 0], "ty": target[some, 1], "x": px[some], "y": py[some], "w": w[some]})

    asked = spark.range(height * width).mapInPandas(place, "tx long, ty long, x long, y long, w double")
    return asked.join(pixels, ["x", "y"]).groupBy(F.col("tx").alias("x"), F.col("ty").alias("y")).agg(F.sum(F.col("w") * F.col("v")).alias("v"))


def interior_correlation(pixels: DataFrame, group: str, inner: float = 0.15) -> DataFrame:
    """By group: correlation of a and b over the pixels (x, y from 0) not within a share of the edges; NULL where one is constant."""
    size = pixels.groupBy(group).agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h"))
    mx, my = F.floor(F.col("w") * inner), F.floor(F.col("h") * inner)
    far = (F.col("x") >= mx) & (F.col("x") < F.col("w") - mx) & (F.col("y") >= my) & (F.col("y") < F.col("h") - my)
    got = pixels.join(size, group).where(far).groupBy(group).agg(F.corr("a", "b").alias("r"), F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1"))
    return got.select(group, F.when((F.col("a0") < F.col("a1")) & (F.col("b0") < F.col("b1")), F.col("r")).alias("correlation"))


def feature_residuals(matches: DataFrame, key: str, distance: str, outlier: float = 50.0) -> DataFrame:
    """key, p50, p90, n of matches' distances up to `outlier`; of all of them where none is that short."""
    rows = matches.where(F.col(distance).isNotNull()).select(F.col(key).alias("_key"), F.col(distance).alias("_d"))
    by = rows.groupBy("_key").agg(F.count_if(F.col("_d") <= outlier).alias("_k"))
    used = rows.join(by, rows["_key"].eqNullSafe(by["_key"])).drop(by["_key"]).where((F.col("_k") == 0) | (F.col("_d") <= outlier))
    n = used.groupBy("_key").agg(F.count("*").alias("n"))
    p = quantiles(used, "_key", "_d", {"p50": 0.5, "p90": 0.9})
    return p.join(n, p["_key"].eqNullSafe(n["_key"])).select(p["_key"].alias(key), "p50", "p90", "n")


def before_after(matches: DataFrame, pixels: DataFrame, key: str, outlier: float = 50.0, inner: float = 0.15) -> DataFrame:
    """key, and of both states: matches' median and 90th percentile of residuals (`feature_residuals`), their number, and the correlation of
    the planes' inner part; improvement: by how much the median fell.

    matches (key, state: before or after, distance), pixels (key, state, x, y, a: reference, b: moving).
    """
    both = F.struct(F.col(key), F.col("state")).alias("both")
    found = feature_residuals(matches.select(both, "distance"), "both", "distance", outlier).select(F.col("both")[key].alias(key), F.col("both.state").alias("state"), "p50", "p90", "n")
    alike = interior_correlation(pixels.select(both, "x", "y", "a", "b"), "both", inner).select(F.col("both")[key].alias(key), F.col("both.state").alias("state"), "correlation")
    rows = found.join(alike, [key, "state"], "full")
    of = lambda c, s: F.max(F.when(F.col("state") == s, F.col(c))).alias(f"{c}_{s}")
    by = rows.groupBy(key).agg(*[of(c, s) for s in ("before", "after") for c in ("p50", "p90", "n", "correlation")])
    return by.withColumn("improvement", F.col("p50_before") - F.col("p50_after"))


def mesh_margin(mesh: Mesh | None) -> int:
    """How far beyond a tile's own window its source may lie: the mesh's longest shift along an axis, and four pixels."""
    return 4 + (int(np.ceil(np.abs(mesh.shifts).max(initial=0.0))) if mesh else 0)


def moving_entry(slides: DataFrame, name: str | None = None) -> DataFrame:
    """The row of a manifest's slides (slide, is_reference, ..) that is warped: the one of that name, else the first by name that isn't the
    reference; an error without one.
    """
    rank = F.when(F.col("slide") == F.lit(name), 0).otherwise(1)
    got = slides.where((F.col("slide") == F.lit(name)) | ~F.col("is_reference") if name else ~F.col("is_reference")).orderBy(rank, "slide").limit(1)
    if got.isEmpty():
        raise ValueError("no moving slide")
    return got


def on_canvas(ref: DataFrame, mov: DataFrame) -> DataFrame:
    """x, y, ref, mov: mov cut and filled with 0 to the pixels of ref."""
    return ref.select("x", "y", F.col("v").alias("ref")).join(mov.select("x", "y", F.col("v").alias("mov")), ["x", "y"], "left").withColumn("mov", F.coalesce("mov", F.lit(0).cast("double")))
