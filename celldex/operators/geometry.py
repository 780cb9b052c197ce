"""Shapes of labelled pixels (label, x, y): moments, boundaries, hulls.  NULL and 0 labels are background."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _inside(pixels: DataFrame) -> DataFrame:
    return pixels.where("label is not null and x is not null and y is not null").select("label", F.col("x").cast("long"), F.col("y").cast("long"))


def morphology(pixels: DataFrame) -> DataFrame:
    """area, centroid, bounding box, axis lengths and eccentricity by label, of the ellipse of equal second moments.

    Second moments are folded about running means, so large coordinates neither overflow nor lose places.
    """
    sums = _inside(pixels).groupBy("label").agg(
        F.count("*").alias("area"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.var_pop("x").alias("cxx"), F.var_pop("y").alias("cyy"), F.covar_pop("x", "y").alias("cxy"),
        F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"),
    )
    half, root = (F.col("cxx") + F.col("cyy")) / 2, F.sqrt(((F.col("cxx") - F.col("cyy")) / 2) * ((F.col("cxx") - F.col("cyy")) / 2) + F.col("cxy") * F.col("cxy"))
    sums = sums.withColumns({"l1": half + root, "l2": F.greatest(half - root, F.lit(0.0))})
    shape = [(4 * F.sqrt("l1")).alias("major"), (4 * F.sqrt("l2")).alias("minor"), F.when(F.col("l1") > 0, F.sqrt(1 - F.col("l2") / F.col("l1"))).otherwise(0.0).alias("eccentricity")]
    return sums.select("label", "area", "cx", "cy", "x0", "y0", "x1", "y1", *shape)


def boundary(pixels: DataFrame, height: int | None = None, width: int | None = None) -> DataFrame:
    """label, x, y of the pixels that have a side without their label beyond it; with the plane's size, its edge is no such side.

    Every pixel votes for itself and its four neighbours, so one grouping finds them and no join is needed.
    """
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))])
    votes = _inside(pixels).distinct().select("label", "x", "y", F.explode(steps).alias("d"))
    at = votes.groupBy("label", (F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"))
    own = (F.col("d.dx") == 0) & (F.col("d.dy") == 0)
    beyond = [(F.col(c) == k).cast("int") for c, n in (("y", height), ("x", width)) if n is not None for k in (0, n - 1)]
    return at.agg(F.bool_or(own).alias("own"), F.count("*").alias("votes")).where(F.col("own") & (F.col("votes") < 5 - sum(beyond, F.lit(0)))).select("label", "x", "y")


#: What a border pixel adds to a perimeter, by the code of its neighbourhood (itself 1, border pixels beside it 2, at its corners 10).
PERIMETER = {1.0: (5, 7, 15, 17, 25, 27), 2**0.5: (21, 33), (1 + 2**0.5) / 2: (13, 23)}


def border_codes(pixels: DataFrame) -> DataFrame:
    """label, x, y, code of labels' border pixels, by votes of those around each."""
    steps = [(dx, dy, 1 if dx == dy == 0 else 10 if dx and dy else 2) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    near = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(w).alias("w")) for dx, dy, w in steps])
    votes = boundary(pixels).select("label", "x", "y", F.explode(near).alias("d"))
    by = votes.groupBy("label", (F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"))
    return by.agg(F.sum("d.w").cast("int").alias("code"), F.bool_or(F.col("d.w") == 1).alias("own")).where("own").drop("own")


def perimeter(pixels: DataFrame) -> DataFrame:
    """label, perimeter: summed over codes of border pixels, of which each label has a bounded number; so tasks fold their own counts."""
    weight = F.lit(0.0)
    for w, codes in PERIMETER.items():
        weight = F.when(F.col("code").isin(*codes), w).otherwise(weight)
    n = border_codes(pixels).groupBy("label", "code").agg(F.count("*").alias("n"))
    return n.groupBy("label").agg(F.sum(F.col("n") * weight).alias("perimeter"))


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of points sorted by x and then y, counter-clockwise."""

    def chain(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(chain(points) + chain(points[::-1])) if len(points) > 1 else points


def lattice_points(corners: np.ndarray) -> int:
    """Whole points within a convex polygon or on it; corners (x, y) are doubled, so halves are whole and nothing is rounded."""
    first, last = -(-int(corners[:, 1].min()) // 2), int(corners[:, 1].max()) // 2
    left, right = np.full(last - first + 1, np.iinfo(np.int64).max), np.full(last - first + 1, np.iinfo(np.int64).min)
    for (x0, y0), (x1, y1) in zip(corners, np.roll(corners, -1, axis=0), strict=True):
        if y0 == y1:
            continue
        if y0 > y1:
            x0, y0, x1, y1 = x1, y1, x0, y0
        y = np.arange(-(-y0 // 2), y1 // 2 + 1)
        at, den = x0 * (y1 - y0) + (x1 - x0) * (2 * y - y0), 2 * (y1 - y0)
        left[y - first] = np.minimum(left[y - first], -(-at // den))
        right[y - first] = np.maximum(right[y - first], at // den)
    return int(np.maximum(right - left + 1, 0)[left <= right].sum())


def convex_area(pixels: DataFrame) -> DataFrame:
    """label, area, convex_area (pixels whose centre is in the hull of the middles of the pixels' sides) and solidity (their quotient).

    Only the ends of a label's rows can be corners, so a task gets two of them a row of the label, not its pixels.
    """
    rows = _inside(pixels).distinct().groupBy("label", "y").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n"))

    def measure(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends, area = np.zeros((0, 2), np.int64), 0
        for f in frames:
            low, high, y = (2 * f[c].to_numpy() for c in ("low", "high", "y"))
            area += int(f["n"].sum())
            middles = [np.stack((x + dx, y + dy), 1) for x, side in ((low, -1), (high, 1)) for dx, dy in ((side, 0), (0, -1), (0, 1))]
            ends = hull(np.unique(np.concatenate([ends, *middles]), axis=0))
        whole = lattice_points(ends)
        yield pd.DataFrame({"label": [key[0]], "area": [area], "convex_area": [whole], "solidity": [area / whole]})

    kind = pixels.schema["label"].dataType.simpleString()
    return rows.groupBy("label").applyInPandas(measure, f"label {kind}, area long, convex_area long, solidity double")


def described(pixels: DataFrame) -> DataFrame:
    """`morphology` with perimeter, convex_area and solidity, by label."""
    return morphology(pixels).join(perimeter(pixels), "label").join(convex_area(pixels).select("label", "convex_area", "solidity"), "label")


def ring_centroids(rings: DataFrame, feature: str, ring: str) -> DataFrame:
    """area, cx, cy by feature, from rings of structs x, y; holes (rings the other way round) subtract.

    A feature without area has the mean of its corners as its centroid.  Products are of distances from a ring's
    first corner, as those of coordinates lose the places of small rings that lie far out.
    """
    n, first = F.size(ring), F.get(ring, F.lit(0))
    near = F.transform(ring, lambda p: F.struct((p["x"] - first["x"]).alias("x"), (p["y"] - first["y"]).alias("y")))
    at = lambda i: F.get("_near", F.pmod(i, F.size("_near")))
    cross = lambda i: at(i)["x"] * at(i + 1)["y"] - at(i + 1)["x"] * at(i)["y"]
    ids = F.sequence(F.lit(0), F.size("_near") - 1)
    total = lambda f: F.aggregate(ids, F.lit(0.0), lambda s, i: s + f(i))
    one = rings.where(n > 0).select(feature, n.alias("n"), first["x"].alias("ox"), first["y"].alias("oy"), near.alias("_near")).select(
        feature, "n", "ox", "oy", total(cross).alias("a"),
        total(lambda i: (at(i)["x"] + at(i + 1)["x"]) * cross(i)).alias("ax"), total(lambda i: (at(i)["y"] + at(i + 1)["y"]) * cross(i)).alias("ay"),
        total(lambda i: at(i)["x"]).alias("mx"), total(lambda i: at(i)["y"]).alias("my"),
    )
    one = one.withColumns({"ax": F.col("ax") + 3 * F.col("a") * F.col("ox"), "ay": F.col("ay") + 3 * F.col("a") * F.col("oy"), "mx": F.col("mx") + F.col("n") * F.col("ox"), "my": F.col("my") + F.col("n") * F.col("oy")})
    by = one.groupBy(feature).agg(*[F.sum(c).alias(c) for c in ("n", "a", "ax", "ay", "mx", "my")])
    flat = F.abs(F.col("a")) < 1e-12
    centre = lambda s, m: F.when(flat, F.col(m) / F.col("n")).otherwise(F.col(s) / (3 * F.nullif(F.col("a"), F.lit(0.0))))
    return by.select(feature, (F.abs("a") / 2).alias("area"), centre("ax", "mx").alias("cx"), centre("ay", "my").alias("cy"))
