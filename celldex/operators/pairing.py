"""Pairing of labels and points: overlap counts, and spatial joins over grid cells."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import shared_dir

#: Places that the cells of the first round of `nearest_within` should hold at most, and its most rounds.
FEW, MOST_ROUNDS = 8, 16


def _kept(df: DataFrame, what: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends there."""
    path = f"{shared_dir(df.sparkSession)}/celldex/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged(df: DataFrame) -> DataFrame:
    """df for a join by sorting, never by a copy that the driver collects and sends: a Parquet table of points is many times its files in memory."""
    return df.hint("merge")


def overlap_argmax(rows: DataFrame, key: str, other: str) -> DataFrame:
    """Each key's other label of most rows, the smallest of equals, and how many rows."""
    n = rows.where(F.col(key).isNotNull() & F.col(other).isNotNull()).groupBy(key, other).agg(F.count("*").alias("n"))
    best = F.max(F.struct(F.col("n"), (-F.col(other)).alias("minus")))
    return n.groupBy(key).agg(best.alias("best")).select(key, (-F.col("best.minus")).alias(other), F.col("best.n").alias("n"))


def real(points: DataFrame) -> DataFrame:
    """The points (x, y) that have both coordinates."""
    return points.where("x is not null and y is not null and not isnan(x) and not isnan(y)")


def within(a: DataFrame, b: DataFrame, radius: float) -> DataFrame:
    """Pairs of points (id, x, y) at most radius apart, by an equi-join of grid cells: a, b, d2.

    Each point of b is in its own cell; each of a looks into the nine around its own.  Points with a
    NULL or NaN coordinate pair with nothing, and a radius of 0 or less pairs nothing.  All pairs are rows:
    where points are dense they are many times the points.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(max(radius, 1e-300) * (1 + 1e-6))).cast("long")
    near = F.sequence(F.lit(-1), F.lit(1))
    left = real(a).select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), cell("x").alias("cx"), cell("y").alias("cy"))
    left = left.withColumn("dx", F.explode(near)).withColumn("dy", F.explode(near)).withColumns({"cx": F.col("cx") + F.col("dx"), "cy": F.col("cy") + F.col("dy")})
    right = real(b).select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), cell("x").alias("cx"), cell("y").alias("cy"))
    d2 = (F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by"))
    return left.join(merged(right), ["cx", "cy"]).select("a", "b", d2.alias("d2")).where(F.col("d2") <= radius * radius).where(F.lit(radius > 0))


def _nearest(pairs: DataFrame, key: str, other: str) -> DataFrame:
    best = pairs.groupBy(key).agg(F.min(F.struct("d2", other)).alias("best"))
    return best.select(key, F.col(f"best.{other}").alias(other), F.col("best.d2").alias("d2"))


def nearest_within(a: DataFrame, b: DataFrame, radius: float) -> DataFrame:
    """Each point of a that has one in reach: its nearest of b, by distance and then id.

    Points of b in one place are one, that of the least id.  Where many are within the radius, a shorter reach is tried first:
    whoever finds one there has found the nearest, and only the others look twice as far.  So pairs grow with the points, not
    with their density.  How many rounds that takes is read from the fullest cell of b.
    """
    if not radius > 0:
        return _nearest(within(a, b, radius), "a", "b")
    places = real(b).groupBy("x", "y").agg(F.min("id").alias("id"))
    at = [F.floor(F.col(c) / radius).alias(f"c{c}") for c in "xy"]
    fullest = places.groupBy(*at).count().agg(F.max("count")).head()[0] or 0
    rounds = min(MOST_ROUNDS, max(0, math.ceil(math.log2(max(fullest, 1) / FEW))))
    left, found = real(a).select("id", "x", "y"), None
    if rounds:
        left, places = _kept(left, "left"), _kept(places, "places")
    for k in range(rounds, -1, -1):
        near = _nearest(within(left, places, radius / 2**k), "a", "b")
        if k:
            near = _kept(near, "near")
            left = _kept(left.join(merged(near.select(F.col("a").alias("id"))), "id", "left_anti"), "left")
        found = near if found is None else found.unionByName(near)
    return found


def mutual_nearest(a: DataFrame, b: DataFrame, radius: float) -> DataFrame:
    """Pairs of which each is the other's nearest in reach."""
    back = nearest_within(b, a, radius).select(F.col("b").alias("a"), F.col("a").alias("b"))
    return nearest_within(a, b, radius).join(merged(back), ["a", "b"])


def residuals_by_slide(points: DataFrame, cells: DataFrame, radius: float, slides: list[str]) -> DataFrame:
    """label and, for each slide, the greatest residual of its points whose nearest cell in reach that is.

    points (id, slide, x, y, residual), cells (id, x, y).  The slides are declared, so no extra pass finds them.
    """
    near = nearest_within(points.select("id", "x", "y"), cells, radius).select(F.col("a").alias("id"), F.col("b").alias("label"))
    by = near.join(points.select("id", "slide", "residual"), "id").groupBy("label", "slide").agg(F.max("residual").alias("r"))
    return by.groupBy("label").pivot("slide", slides).agg(F.max("r"))


def by_centroid(flow: DataFrame, cells: DataFrame, pixel: float, radius: float) -> DataFrame:
    """Pairs a (of flow, in micrometres) and b (of cells, in pixels), each other's nearest in reach; d2 in pixels.  Both count from pixel corners."""
    return mutual_nearest(flow.select("id", (F.col("x") / pixel).alias("x"), (F.col("y") / pixel).alias("y")), cells, radius)


def by_label(flow: DataFrame, cells: DataFrame) -> DataFrame:
    """Pairs a (of flow) and b (of cells) of equal label; of flow's rows with one label the last (greatest id) counts."""
    last = flow.where("label is not null").groupBy(F.col("label").alias("b")).agg(F.max("id").alias("a"))
    return last.join(cells.select(F.col("id").alias("b")).distinct(), "b").select("a", "b")


def resolve_join(flow: DataFrame, cells: DataFrame, pixel: float, radius: float, least: float) -> DataFrame:
    """b, a of every cell (a: its row of flow, NULL without one), and of all: method, matched, cells, match_fraction.

    By label if flow has one, else by centroid, else an error.  An error, when it runs, if less than `least` of
    the cells find a row.  The totals are one row beside the cells.
    """
    if "label" in flow.columns:
        pairs, how = by_label(flow, cells), "label"
    elif {"x", "y"} <= set(flow.columns):
        pairs, how = by_centroid(flow, cells, pixel, radius).select("a", "b"), "centroid"
    else:
        raise ValueError("no label and no centroid to join by")
    rows = cells.select(F.col("id").alias("b")).join(pairs, "b", "left")
    n, found = F.count("*"), F.count("a")
    few = F.raise_error(F.concat(found, F.lit(" of "), n, F.lit(f" cells found a row by {how}; at least {least:g} of them must"))).cast("long")
    totals = rows.agg(F.when(found < least * n, few).otherwise(found).alias("matched"), n.alias("cells"))
    totals = totals.select(F.lit(how).alias("method"), "matched", "cells", (F.col("matched") / F.greatest("cells", F.lit(1))).alias("match_fraction"))
    return rows.join(F.broadcast(totals)).where("matched >= 0")


def annotated(joined: DataFrame, flow: DataFrame, phenotype: str, flags: list[str], gates: list[str], sign: str = "+") -> DataFrame:
    """joined (`resolve_join`) with what its rows of flow say: the phenotype ("unclassified" where it is blank or there is no row), flags
    (false where unknown), matched_row, and positive: the names of gates that hold the sign.
    """
    blank = F.trim(F.coalesce(F.col(phenotype).cast("string"), F.lit(""))) == ""
    positive = F.filter(F.array(*[F.when(F.trim(F.coalesce(F.col(f"`{g}`").cast("string"), F.lit(""))) == sign, F.lit(g)) for g in gates]) if gates else F.array().cast("array<string>"), lambda g: g.isNotNull())
    said = flow.select(F.col("id").alias("a"), F.when(~blank, F.col(phenotype)).alias("phenotype"), *[F.coalesce(F.col(f).cast("boolean"), F.lit(False)).alias(f) for f in flags], positive.alias("positive"))
    out = joined.join(said, "a", "left")
    full = {f: F.coalesce(f, F.lit(False)) for f in flags} | {"phenotype": F.coalesce("phenotype", F.lit("unclassified")), "positive": F.coalesce("positive", F.array().cast("array<string>"))}
    return out.withColumns(full | {"matched_row": F.col("a").isNotNull()})


def rekey_contours(contours: DataFrame, mapping: DataFrame, areas: DataFrame) -> DataFrame:
    """label, ring: of the nuclei (nucleus, ring, at) mapped to a cell (nucleus, label) the ring of the largest area, the first of equals."""
    rows = contours.join(mapping, "nucleus").join(areas, "nucleus")
    return rows.groupBy("label").agg(F.max_by("ring", F.struct("area", (-F.col("at")).alias("minus"))).alias("ring"))


def pair_inputs(stores: list[str], tables: list[str]) -> list[tuple[str, str]]:
    """Stores with tables of whose stems theirs is part; by place in order if a table has none and there are as many of both, else an error."""
    stem = lambda p: p.rstrip("/").rpartition("/")[2].rpartition(".")[0] or p.rpartition("/")[2]
    if len(stores) == len(tables) == 1:
        return [(stores[0], tables[0])]
    found = {t: next((s for s in stores if stem(s) and stem(s) in stem(t)), None) for t in tables}
    if all(found.values()):
        return [(s, t) for t, s in found.items()]
    if len(stores) != len(tables):
        raise ValueError(f"{len(stores)} stores and {len(tables)} tables, and no store for {[t for t, s in found.items() if not s]}")
    return list(zip(sorted(stores), sorted(tables), strict=True))


def with_report(items: DataFrame, reports: DataFrame, path: str) -> DataFrame:
    """items with the report of the same file name; an error where several reports have one.  Reports are few by nature (one a run)."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    one = reports.groupBy(name.alias("_name")).agg(F.count("*").alias("_n"), F.first(path).alias("report"))
    checked = one.select("_name", F.when(F.col("_n") == 1, F.col("report")).otherwise(F.raise_error(F.concat(F.lit("several reports named "), F.col("_name"))).cast("string")).alias("report"))
    return items.withColumn("_name", name).join(checked, "_name", "left").drop("_name")
