"""Quality of segmentations: foreground shares, uniformity, clusters of cells, matched shares, scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import _kept, matched_masks, painted_masks
from .measure import size_uniformity


def shares(pixels: DataFrame, group: str, foreground: Column, mask: Column) -> DataFrame:
    """By group: shares of the foreground and of the background that the mask has, and of the mask that is foreground."""
    n = lambda c: F.count_if(c).cast("double")
    return pixels.groupBy(group).agg(
        F.try_divide(n(foreground & mask), n(foreground)).alias("foreground_fraction"),
        F.coalesce(F.try_divide(n(~foreground & mask), n(~foreground)), F.lit(0.0)).alias("background_fraction"),
        F.try_divide(n(foreground & mask), n(mask)).alias("mask_fraction"),
    )


def matched_fraction(pixels: DataFrame, cell: str, nucleus: str, matched: str) -> DataFrame:
    """fraction: matched labels over mismatched cells, mismatched nuclei and matched ones; the background counts as a label of each."""
    n = {c: F.countDistinct(F.coalesce(F.col(c), F.lit(0))) for c in (cell, nucleus, matched)}
    by = pixels.agg(n[cell].alias("c"), n[nucleus].alias("n"), n[matched].alias("m"))
    return by.select((F.col("m") / (F.col("c") + F.col("n") - F.col("m"))).alias("fraction"))


def channel_uniformity(pixels: DataFrame, channels: list[str], where: Column) -> DataFrame:
    """cv: the mean over channels of the deviation, where `where` holds, of values over the channel's mean; channels of mean 0 are left out."""
    means = pixels.agg(*[F.avg(c).alias(f"{c}_mean") for c in channels])
    got = pixels.where(where).agg(*[F.stddev_pop(c).alias(c) for c in channels]).join(means)
    real = F.filter(F.array(*[F.when(F.col(f"{c}_mean") != 0, F.col(c) / F.col(f"{c}_mean")) for c in channels]), lambda v: v.isNotNull())
    return got.select(F.try_divide(F.aggregate(real, F.lit(0.0), lambda s, v: s + v), F.size(real)).alias("cv"))


class Moments:
    """Number, mean and summed products of deviations of rows of a matrix; two of them merge without the rows."""

    def __init__(self, n: int, mean: np.ndarray, spread: np.ndarray):
        self.n, self.mean, self.spread = n, mean, spread

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(0)
        return cls(len(x), mean, (x - mean).T @ (x - mean))

    def __add__(self, other: Moments) -> Moments:
        n, apart = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + apart * (other.n / n), self.spread + other.spread + np.outer(apart, apart) * (self.n * other.n / n))

    def first_share(self) -> float:
        """The share of the variance along the first principal axis; NaN without variance."""
        total = np.trace(self.spread)
        return float(np.linalg.eigvalsh(self.spread)[-1] / total) if total > 0 else float("nan")


def pixel_features(pixels: DataFrame, where: Column, channels: list[str], column: str = "x", keep: tuple[str, ...] = ()) -> DataFrame:
    """Of the pixels where `where` holds: channels and (`{channel}_z`) their z-scores within the whole plane's columns, 0 in a column without deviation."""
    stats = pixels.groupBy(column).agg(*[f(c).alias(f"_{c}_{n}") for c in channels for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    z = [F.when(F.col(f"_{c}_s") > 0, (F.col(c) - F.col(f"_{c}_m")) / F.col(f"_{c}_s")).otherwise(0.0).alias(f"{c}_z") for c in channels]
    return pixels.where(where).join(stats, column).select(*keep, *channels, *z)


def cell_features(pixels: DataFrame, label: str, channels: list[str], column: str = "x") -> DataFrame:
    """label, and each channel's mean and mean z-score (`pixel_features`); NULL and 0 labels are background, but count for the z-scores."""
    rows = pixel_features(pixels, F.coalesce(F.col(label), F.lit(0)) != 0, channels, column, (label,))
    return rows.groupBy(F.col(label).alias("label")).agg(*[F.avg(c).alias(c) for c in [*channels, *[f"{c}_z" for c in channels]]])


KS = range(1, 11)


def kmeans(cells: DataFrame, columns: list[str], ks: range = KS, seed: int = 777) -> DataFrame:
    """cells with k1, k2, ..: the cluster of each k (k1 is 0); rows with NULL or NaN are left out.  One fit a k, over the same table."""
    rows = _kept(VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(cells), "features")
    for k in ks:
        rows = rows.withColumn("k1", F.lit(0)) if k == 1 else KMeans(k=k, seed=seed, featuresCol="features", predictionCol=f"k{k}").fit(rows).transform(rows)
    return _kept(rows.drop("features"), "clusters")


def cluster_terms(cells: DataFrame, channels: list[str], ks: range = KS) -> DataFrame:
    """k, cluster, n, cv, fraction of cells (a channel and its `_z` each, and k1, k2, ..), for all k in one pass.

    Each task folds its cells into `Moments` by (k, cluster); a few numbers each are shuffled, merged and solved.
    cv: the mean over channels of deviation over mean (0 for constant channels; those of mean 0 don't count, NaN if none does).
    fraction: the share of the first principal component of the z-scores; 1 for one cell, or z-scores that sum to 0.
    """
    d, names = len(channels), [f"k{k}" for k in ks]
    columns = [*channels, *[f"{c}_z" for c in channels]]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[Moments, np.ndarray]] = {}
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2 * d)]) if len(batch) else np.zeros((0, 2 * d))
            for i, k in enumerate(ks):
                cluster = batch.column(2 * d + i).to_numpy(zero_copy_only=False)
                for c in np.unique(cluster):
                    mine = x[cluster == c]
                    m, ends = Moments.of(mine), np.stack((mine.min(0), mine.max(0)))
                    if (k, int(c)) in held:
                        before = held[k, int(c)]
                        m, ends = before[0] + m, np.stack((np.minimum(before[1][0], ends[0]), np.maximum(before[1][1], ends[1])))
                    held[k, int(c)] = (m, ends)
        rows = [(k, c, m.n, [*m.mean, *m.spread.ravel(), *ends.ravel()]) for (k, c), (m, ends) in held.items()]
        cols = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())), strict=True)], ["k", "cluster", "n", "parts"])

    def solve(key: tuple, rows: pa.Table) -> pa.Table:
        total, low, high = None, np.full(2 * d, np.inf), np.full(2 * d, -np.inf)
        for n, parts in zip(rows["n"].to_pylist(), rows["parts"].to_pylist(), strict=True):
            v = np.array(parts)
            m = Moments(n, v[: 2 * d], v[2 * d : 2 * d + 4 * d * d].reshape(2 * d, 2 * d))
            low, high = np.minimum(low, v[-4 * d : -2 * d]), np.maximum(high, v[-2 * d :])
            total = m if total is None else total + m
        sd, mean = np.sqrt(np.diag(total.spread)[:d] / total.n), total.mean[:d]
        with np.errstate(all="ignore"):
            cv = np.where(low[:d] == high[:d], 0.0, np.where(mean == 0, np.nan, sd / mean))
        z = Moments(total.n, total.mean[d:], total.spread[d:, d:])
        fraction = 1.0 if total.n == 1 or not z.mean.sum() else z.first_share()
        real = cv[~np.isnan(cv)]
        out = {"k": key[0].as_py(), "cluster": key[1].as_py(), "n": total.n, "cv": float(real.mean()) if len(real) else float("nan"), "fraction": fraction}
        return pa.Table.from_pylist([out], pa.schema([("k", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), ("cv", pa.float64()), ("fraction", pa.float64())]))

    parts = cells.select(*[F.col(c).cast("double") for c in columns], *[F.col(c).cast("int") for c in names]).mapInArrow(fold, "k int, cluster int, n long, parts array<double>")
    return parts.groupBy("k", "cluster").applyInArrow(solve, "k int, cluster int, n long, cv double, fraction double")


#: Cells that silhouettes are estimated from: all of fewer, else those of least hash.
SAMPLE = 10_000


def silhouettes(cells: DataFrame, columns: list[str], ks: range = KS, most: int = SAMPLE) -> DataFrame:
    """k, silhouette: the mean over cells of (b - a) / max(a, b), a the mean distance to the own cluster's others, b to the nearest other cluster's.

    1 for k = 1; a cell that is alone has 0; NaN where there is one cluster only.  Distances of a bounded sample
    (`most` cells) are worked out once for all k, in blocks of it by tasks.
    """
    names, d = [f"k{k}" for k in ks], len(columns)
    rows = cells.select(F.col("label"), *[F.col(c).cast("double") for c in columns], *[F.col(c).cast("int") for c in names])
    some = _kept(rows.orderBy(F.xxhash64("label"), "label").limit(most).drop("label"), "sample")
    table = some.toArrow()
    share = cells.sparkSession.sparkContext.broadcast((np.column_stack([table[c].to_numpy() for c in columns]) if len(table) else np.zeros((0, d)), [np.unique(table[c].to_numpy(), return_inverse=True) for c in names]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, clusters = share.value
        square, hot = (x**2).sum(1), [np.eye(max(1, len(ids)))[at] for ids, at in clusters]
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                y = np.column_stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(d)])
                away = np.sqrt(np.maximum((y**2).sum(1)[:, None] + square - 2 * y @ x.T, 0))
                for i, k in enumerate(ks):
                    ids = clusters[i][0]
                    own = np.searchsorted(ids, part.column(d + i).to_numpy(zero_copy_only=False))
                    size = hot[i].sum(0)
                    total = away @ hot[i]
                    row = np.arange(len(y))
                    with np.errstate(all="ignore"):
                        a = total[row, own] / (size[own] - 1)
                        other = total / size
                        other[row, own] = np.inf
                        b = other.min(1) if len(ids) > 1 else np.full(len(y), np.nan)
                        s = np.where(k == 1, 1.0, np.where((size[own] == 1) & ~np.isnan(b), 0.0, np.where(np.maximum(a, b) > 0, (b - a) / np.maximum(a, b), np.where(np.isnan(b), np.nan, 0.0))))
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([float(s.sum())]), pa.array([len(s)], pa.int64())], ["k", "total", "n"])

    each = some.repartition(max(1, most // 512)).mapInArrow(score, "k int, total double, n long")
    return each.groupBy("k").agg((F.sum("total") / F.sum("n")).alias("silhouette"))


def uniformity(cells: DataFrame, channels: list[str], ks: range = KS) -> DataFrame:
    """k, cv, fraction (by cluster, weighted by the clusters' sizes) and silhouette, for every k."""
    mean = lambda c: (F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c)
    by = cluster_terms(cells, channels, ks).groupBy("k").agg(mean("cv"), mean("fraction"))
    return by.join(silhouettes(cells, [f"{c}_z" for c in channels], ks), "k")


def foreground_terms(pixels: DataFrame, channels: list[str], where: Column, column: str = "x") -> DataFrame:
    """cv (`channel_uniformity`) and fraction (of the first principal component of z-scores within columns) of the pixels where `where` holds."""
    each = pixel_features(pixels, where, channels, column)
    fraction = cluster_terms(each.withColumn("k1", F.lit(0)), channels, range(1, 2)).agg(F.max("fraction").alias("fraction"))  # NULL without such pixels
    return channel_uniformity(pixels, channels, where).join(fraction)


def evaluation(pixels: DataFrame, channels: list[str], pixel_area: float, assign: Callable[[DataFrame], DataFrame] | None = None, column: str = "x") -> DataFrame:
    """One row of 14 measures of a slide's segmentation.

    pixels (x, y, cell, nucleus, interior: not on the cell's own boundary, foreground, and the channels).  Cells and
    nuclei are matched and painted; cells are clustered (`kmeans` of their z-scores, or `assign`) for k = 1..10, and
    the clusters of a cell are those of its nucleus and of the rest of it.  Averages over k are taken as they are, so
    one that isn't defined leaves none.
    """
    px = pixels.withColumn("_slide", F.lit(0))
    px = _kept(painted_masks(px, matched_masks(px, "_slide"), "_slide"), "masks")
    on = F.col("cell_matched") > 0
    area = px.agg(F.count("*").alias("pixels"), F.countDistinct(F.when(on, F.col("cell_matched"))).alias("cells"))
    shown = area.select((F.col("cells") / (F.col("pixels") * F.lit(pixel_area)) * 100).alias("cells_per_100um2"))
    covered = shares(px, "_slide", F.col("foreground"), on).select("foreground_fraction", (1 - F.col("background_fraction")).alias("background_left"), "mask_fraction")
    even = size_uniformity(px.withColumn("_m", F.when(on, F.col("cell_matched"))), "_m").select(F.try_divide(F.lit(1.0), F.ln("sd") + 1).alias("size_evenness"))
    same = matched_fraction(px, "cell", "nucleus", "cell_matched").select(F.col("fraction").alias("matched_fraction"))
    left = foreground_terms(px, channels, F.col("foreground") & ~on, column).select((1 / (F.col("cv") + 1)).alias("foreground_evenness"), F.col("fraction").alias("foreground_first_share"))
    zs = [f"{c}_z" for c in channels]
    clusters = (assign or (lambda cells: kmeans(cells, zs)))(cell_features(px, "cell_matched", channels, column)).select("label", *[f"k{k}" for k in KS])
    out = shown.join(covered).join(even).join(same).join(left)
    for mask, name in (("nucleus_matched", "nucleus"), ("cell_outside", "outside")):
        by = uniformity(_kept(cell_features(px, mask, channels, column).join(clusters, "label"), "cells"), channels)
        out = out.join(by.agg((1 / (F.avg("cv") + 1)).alias(f"{name}_evenness"), F.avg("fraction").alias(f"{name}_first_share"), F.avg("silhouette").alias(f"{name}_silhouette")))
    return out


#: The measures in the order that a quality model takes them.
MEASURES = [
    "cells_per_100um2", "foreground_fraction", "background_left", "mask_fraction", "size_evenness", "matched_fraction", "foreground_evenness", "foreground_first_share",
    "nucleus_evenness", "nucleus_first_share", "nucleus_silhouette", "outside_evenness", "outside_first_share", "outside_silhouette",
]


def quality_score(metrics: list[Column], mean: list[float], scale: list[float], components: list[list[float]], ratios: list[float]) -> Column:
    """exp of the first two components of the standardised metrics, weighted by their shares of the variance; the model's constants are given."""
    z = [(m - F.lit(a)) / F.lit(s) for m, a, s in zip(metrics, mean, scale, strict=True)]
    parts = [sum((v * F.lit(c) for v, c in zip(z, row, strict=True)), F.lit(0.0)) * F.lit(r) for row, r in zip(components[:2], ratios[:2], strict=True)]
    return F.exp(parts[0] + parts[1])
