"""Rasters and polygons as relations: tiles, block means, affine points, ring areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .measure import quantiles


def block_mean(pixels: DataFrame, factor: int, x: str = "x", y: str = "y", value: str = "v") -> DataFrame:
    """Mean of each factor by factor block, to 6 places."""
    cell = lambda c: F.floor(F.col(c) / factor).cast("long")
    return pixels.groupBy(cell(x).alias("bx"), cell(y).alias("by")).agg(F.round(F.avg(value), 6).alias("mean"), F.count("*").alias("n"))


def affine(points: DataFrame, m: list[list[float]]) -> DataFrame:
    """points with u, v: the affine image of x, y."""
    u, v = ((F.lit(r[0]) * F.col("x") + F.lit(r[1]) * F.col("y")) + F.lit(r[2]) for r in m)
    return points.withColumns({"u": u, "v": v})


def ring_area(rings: DataFrame, ring: str) -> DataFrame:
    """rings with area: half the absolute shoelace sum of a ring given as x0, y0, x1, y1, ...; 0 below 3 vertices."""
    n = F.floor(F.size(ring) / 2).cast("int")
    at = lambda i: F.get(ring, i.cast("int"))
    term = lambda i: at(2 * i) * at(2 * F.pmod(i + 1, n) + 1) - at(2 * F.pmod(i + 1, n)) * at(2 * i + 1)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda s, i: s + term(i).cast("double"))
    return rings.withColumn("area", F.when(n < 3, 0.0).otherwise(F.abs(total) / 2))


def median_filter(pixels: DataFrame, accepted, radius: int) -> DataFrame:
    """x, y, v: the median of the accepted values within radius in x and y, where there are any.

    Accepted pixels are sent to the pixels they count for, so there is one grouping and no join on ranges.
    """
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    near = pixels.where(accepted).select("x", "y", "v", F.explode(steps).alias("dx")).select("*", F.explode(steps).alias("dy"))
    sent = near.select((F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"), "v", F.lit(False).alias("own"))
    both = sent.unionAll(pixels.select("x", "y", F.lit(None).cast("double").alias("v"), F.lit(True).alias("own")))
    return both.groupBy("x", "y").agg(F.median("v").alias("v"), F.bool_or("own").alias("own")).where("own and v is not null").select("x", "y", "v")


def flat_field(pixels: DataFrame, profile: DataFrame, tile: int, most: float) -> DataFrame:
    """pixels with v corrected by their place in a tile, (v - dark) / flat, clipped to 0..most; no profile, no change.

    profile (px, py, flat, dark) has tile * tile rows, whatever the plane's size; that bounds the broadcast.
    """
    if tile * tile <= 1 << 20:
        profile = F.broadcast(profile)
    at = (F.col("px") == F.pmod(F.col("x"), F.lit(tile))) & (F.col("py") == F.pmod(F.col("y"), F.lit(tile)))
    new = F.least(F.greatest((F.col("v") - F.col("dark")) / F.nullif(F.col("flat"), F.lit(0.0)), F.lit(0.0)), F.lit(most))
    return pixels.join(profile, at, "left").withColumn("v", F.coalesce(new, F.col("v"))).drop("px", "py", "flat", "dark")


def above_mean(pixels: DataFrame, group: str) -> DataFrame:
    """By group: how many pixels are above the group's mean, and how many there are, from counts of values."""
    n = pixels.groupBy(group, "v").agg(F.count("*").alias("n"))
    mean = pixels.groupBy(group).agg(F.avg("v").alias("m"))
    return n.join(mean, group).groupBy(group).agg(F.coalesce(F.sum(F.when(F.col("v") > F.col("m"), F.col("n"))), F.lit(0)).alias("above"), F.sum("n").alias("n"))


def percentile_scale(pixels: DataFrame, group: str, low: float, high: float) -> DataFrame:
    """pixels with v from 0 at the group's lower percentile to 1 at its upper one; 0 where they are equal."""
    ends = quantiles(pixels, group, "v", {"_lo": low, "_hi": high})
    lo, hi = F.col("_lo"), F.col("_hi")
    v = F.when(hi > lo, F.least(F.greatest((F.col("v") - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return pixels.join(ends, group).withColumn("v", v).drop("_lo", "_hi")


def fov_split(spark: SparkSession, size: int, parts: int) -> DataFrame:
    """i, size, start of near-equal parts of a length; the first ones take the remainder."""
    each, more = divmod(size, parts)
    i = F.col("id")
    return spark.range(parts).select(i.alias("i"), (F.lit(each) + (i < more).cast("int")).cast("long").alias("size"), (i * each + F.least(i, F.lit(more))).cast("long").alias("start"))


def fov_counts(height: int, width: int, fov_height: int, fov_width: int) -> tuple[int, int]:
    """How many fields of view cover a plane, down and across."""
    if min(fov_height, fov_width) <= 0:
        raise ValueError("a field of view must have a size")
    return -(-height // fov_height), -(-width // fov_width)


def fov_grid(spark: SparkSession, height: int, width: int, down: int, across: int) -> DataFrame:
    """index (row by row), iy, ix, y0, x0, h, w of near-equal fields, and the size (pad_h, pad_w) that all are padded to."""
    y = fov_split(spark, height, down).select(F.col("i").alias("iy"), F.col("start").alias("y0"), F.col("size").alias("h"))
    x = fov_split(spark, width, across).select(F.col("i").alias("ix"), F.col("start").alias("x0"), F.col("size").alias("w"))
    both = y.join(F.broadcast(x))  # down * across rows are the result
    return both.select((F.col("iy") * across + F.col("ix")).alias("index"), "iy", "ix", "y0", "x0", "h", "w", F.lit(-(-height // down)).alias("pad_h"), F.lit(-(-width // across)).alias("pad_w"))


def _field(length: int, parts: int, at) -> tuple:
    """Number and start of the field that a place lies in, of near-equal parts of a length."""
    each, more = divmod(length, parts)
    edge = more * (each + 1)
    i = F.when(at < edge, F.floor(at / (each + 1))).otherwise(more + F.floor((at - edge) / max(each, 1))).cast("long")
    return i, i * each + F.least(i, F.lit(more))


def correctable(channels: list[str], markers: list[str], skip_nuclear: bool = True) -> list[str]:
    """The channels that are corrected: all, or those whose name holds no nuclear marker."""
    return [c for c in channels if not (skip_nuclear and any(m.strip().upper() in c.strip().upper() for m in markers))]


def corrected_channels(pixels: DataFrame, profiles: DataFrame, channels: list[str], tile: int, most: float) -> DataFrame:
    """pixels (channel, x, y, v) with those of `channels` corrected by their channel's profile (channel, px, py, flat, dark) as `flat_field`
    does; other channels, and pixels without a profile, pass as they are.  Profiles have tile * tile rows a channel.
    """
    at = F.pmod(F.col("x"), F.lit(tile)).alias("px"), F.pmod(F.col("y"), F.lit(tile)).alias("py")
    mine = pixels.where(F.col("channel").isin(channels)).select("*", *at).join(profiles, ["channel", "px", "py"], "left")
    v = F.col("v").cast("double")
    fixed = F.least(F.greatest((v - F.col("dark")) / F.col("flat"), F.lit(0.0)), F.lit(float(most)))
    rest = pixels.where(~F.col("channel").isin(channels) | F.col("channel").isNull()).select("channel", "x", "y", v.alias("v"))
    return mine.select("channel", "x", "y", F.coalesce(fixed, v).alias("v")).unionByName(rest)


def fields_for_profiles(height: int, width: int, fov_height: int, fov_width: int) -> tuple[int, int]:
    """`fov_counts`; an error where there is one field only, as a profile is estimated over several."""
    down, across = fov_counts(height, width, fov_height, fov_width)
    if down * across < 2:
        raise ValueError(f"one field of {fov_height} x {fov_width} covers the plane of {height} x {width}; make fields of {max(1, min(height, width) // 2)} or less")
    return down, across


def split_fovs(pixels: DataFrame, height: int, width: int, down: int, across: int) -> DataFrame:
    """index, y, x (in the field), v of each pixel (x, y, v): where it lies is arithmetic, so nothing is joined or shuffled."""
    iy, y0 = _field(height, down, F.col("y"))
    ix, x0 = _field(width, across, F.col("x"))
    return pixels.select((iy * across + ix).alias("index"), (F.col("y") - y0).alias("y"), (F.col("x") - x0).alias("x"), "v")


def join_fovs(fields: DataFrame, grid: DataFrame) -> DataFrame:
    """x, y, v of fields' pixels, padding left out; the inverse of `split_fovs`.  The grid has a row a field."""
    at = fields.join(grid.select("index", "y0", "x0", "h", "w"), "index").where("y < h and x < w")
    return at.select((F.col("x") + F.col("x0")).alias("x"), (F.col("y") + F.col("y0")).alias("y"), "v")


def padded_fovs(fields: DataFrame, grid: DataFrame) -> DataFrame:
    """index, y, x, v of fields' pixels, with 0 where a field is smaller than all are padded to."""
    rows = lambda a, b: F.explode(F.sequence(F.col(a), F.col(b) - 1))
    right = grid.where("w < pad_w").select("index", F.explode(F.sequence(F.lit(0), F.col("pad_h") - 1)).alias("y"), "w", "pad_w").select("index", "y", rows("w", "pad_w").alias("x"))
    below = grid.where("h < pad_h").select("index", rows("h", "pad_h").alias("y"), "w").select("index", "y", F.explode(F.sequence(F.lit(0), F.col("w") - 1)).alias("x"))
    return fields.unionByName(right.unionByName(below).withColumn("v", F.lit(0).cast(fields.schema["v"].dataType)))


def every_nth(pixels: DataFrame, factor: int) -> DataFrame:
    """x, y, v of every factor-th pixel of every factor-th row; a filter that a scan can take over."""
    return pixels.where((F.col("x") % factor == 0) & (F.col("y") % factor == 0)).select(F.floor(F.col("x") / factor).alias("x"), F.floor(F.col("y") / factor).alias("y"), "v")


def to_bytes(pixels: DataFrame, group: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """pixels with v from 0 to 255 between the group's percentiles (or ends), rounded half to even; 0 where they are equal."""
    return percentile_scale(pixels, group, low, high).withColumn("v", F.bround(F.col("v") * 255).cast("int"))


def overlay(pixels: DataFrame) -> DataFrame:
    """x, y, r, g, b of two planes (ref, mov; 0 to 255): red the one, green the other, yellow both."""
    return pixels.select("x", "y", F.col("ref").cast("int").alias("r"), F.col("mov").cast("int").alias("g"), F.lit(0).alias("b"))


def side_by_side(left: DataFrame, right: DataFrame, width: int, gap: int) -> DataFrame:
    """x, y, v of two planes, the second to the right of the first and a gap."""
    return left.select("x", "y", "v").unionByName(right.select((F.col("x") + width + gap).alias("x"), "y", "v"))


def profile_problems(profile: DataFrame, tile: int, positive: bool) -> DataFrame:
    """problem, n: pixels of an illumination profile (px, py, flat) that aren't finite, not positive, or missing from tile x tile."""
    bad = F.coalesce(F.isnan("flat") | (F.abs("flat") == float("inf")), F.lit(True))
    by = profile.agg(F.count_if(bad).alias("not finite"), F.count_if(~bad & (F.col("flat") <= 0) & F.lit(positive)).alias("not positive"), (F.lit(tile * tile) - F.countDistinct("px", "py")).alias("missing"))
    return by.unpivot([], by.columns, "problem", "n").where("n <> 0")


def tile_overlaps(windows: DataFrame, width: int, height: int, tile: int) -> DataFrame:
    """id, ix, iy, x0, y0, x1, y1: what each window (id, x0, y0, x1, y1; ends excluded) has of each tile.

    A window knows its tiles, so it is exploded over them and there is no join.
    """
    ends = {"x0": F.greatest("x0", F.lit(0)), "y0": F.greatest("y0", F.lit(0)), "x1": F.least("x1", F.lit(width)), "y1": F.least("y1", F.lit(height))}
    w = windows.withColumns({k: v.cast("long") for k, v in ends.items()}).where("x0 < x1 and y0 < y1")
    over = lambda a, b: F.sequence(F.floor(F.col(a) / tile), F.floor((F.col(b) - 1) / tile))
    w = w.select("*", F.explode(over("x0", "x1")).alias("ix")).select("*", F.explode(over("y0", "y1")).alias("iy"))
    low, high = lambda a, i: F.greatest(F.col(a), F.col(i) * tile).alias(a), lambda a, i: F.least(F.col(a), (F.col(i) + 1) * tile).alias(a)
    return w.select("id", "ix", "iy", low("x0", "ix"), low("y0", "iy"), high("x1", "ix"), high("y1", "iy"))


def mesh_displacement(points: DataFrame, key: str, mesh: DataFrame) -> DataFrame:
    """key, dx, dy: displacements at points (x, y in mesh units), bilinear between the four nodes (i, j, dx, dy) around.

    Points off the mesh get the displacement of its nearest edge.
    """
    ends = F.broadcast(mesh.agg(F.min("i").alias("i0"), F.max("i").alias("i1"), F.min("j").alias("j0"), F.max("j").alias("j1")))  # one row
    inside = lambda c, e: F.least(F.greatest(F.col(c), F.col(f"{e}0").cast("double")), F.col(f"{e}1").cast("double"))
    at = points.join(ends).select(key, inside("x", "i").alias("x"), inside("y", "j").alias("y"), "i1", "j1")
    corner = lambda c, e: F.when(F.col(e) == 1, F.col(c) - F.floor(c)).otherwise(1 - (F.col(c) - F.floor(c)))
    both = F.sequence(F.lit(0), F.lit(1))
    four = at.select("*", F.explode(both).alias("di")).select("*", F.explode(both).alias("dj"))
    node = lambda c, d, e: F.least(F.floor(c) + F.col(d), F.col(e)).cast("long")
    four = four.select(key, (corner("x", "di") * corner("y", "dj")).alias("w"), node("x", "di", "i1").alias("i"), node("y", "dj", "j1").alias("j"))
    return four.join(mesh, ["i", "j"]).groupBy(key).agg(F.sum(F.col("w") * F.col("dx")).alias("dx"), F.sum(F.col("w") * F.col("dy")).alias("dy"))
