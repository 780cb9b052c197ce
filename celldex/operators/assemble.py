"""Putting tables together: which columns are markers and in which order, slides by kind, metrics side by side, stages scored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.scalars import is_nuclear
from .geometry import ring_centroids
from .matching import _kept, match_cells
from .measure import equivalent_radius
from .quality_control import stage_summary
from .shapes import pair_overlap

#: Columns that describe a cell's shape and place, in the order of merged tables.
MORPHOLOGY = ["label", "y", "x", "area", "eccentricity", "perimeter", "convex_area", "axis_major_length", "axis_minor_length", "solidity"]
OTHERS = ["fov", "cell_size", "cell_id"]


def marker_columns(df: DataFrame) -> list[str]:
    """Columns of numbers that don't describe shape or place, in order."""
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in [*MORPHOLOGY, *OTHERS]]


def ordered_columns(df: DataFrame, patient: str, nuclear: list[str]) -> DataFrame:
    """df with fov (the patient) and cell_size (the area) first, then morphology, nuclear markers, and other columns by name."""
    new = df.withColumns({"fov": F.lit(patient), "cell_size": F.col("area")})
    rest = [c for c in df.columns if c not in [*MORPHOLOGY, *OTHERS]]
    first = [c for m in nuclear for c in rest if c.upper() == m.upper()]
    return new.select("fov", "cell_size", *[c for c in MORPHOLOGY if c in df.columns], *first, *[F.col(f"`{c}`") for c in sorted(set(rest) - set(first))])


def gated_columns(df: DataFrame, suffix: str = "_sign") -> list[str]:
    """Columns with the suffix that have a sign other than blank in any row; one aggregated row says which."""
    names = [c for c in df.columns if c.endswith(suffix)]
    if not names:
        return []
    got = df.agg(*[F.max(F.coalesce(F.trim(F.col(f"`{c}`")) != "", F.lit(False))).alias(c) for c in names]).head()
    return [c for c in names if got[c]]


def branched(rows: DataFrame, where: Column) -> tuple[DataFrame, DataFrame]:
    """The rows for which a condition holds, and all others (those for which it is NULL, too)."""
    holds = F.coalesce(where, F.lit(False))
    return rows.where(holds), rows.where(~holds)


def of_kind(artifacts: DataFrame, kind: str, known: list[str]) -> DataFrame:
    """The artifacts of a kind; an error for a kind that isn't known."""
    if kind not in known:
        raise ValueError(f"unknown kind {kind!r}; known: {', '.join(known)}")
    return artifacts.where(F.col("kind") == kind)


def compartment_mode(compartments: bool, expanded: bool, masks: bool) -> dict[str, bool]:
    """The mode of measurement; an error where expanded statistics lack compartments, or embedded masks lack either."""
    if expanded and not compartments:
        raise ValueError("expanded statistics need compartments")
    if masks and not (compartments and expanded):
        raise ValueError("embedded masks need compartments and expanded statistics")
    return {"compartments": compartments, "expanded": expanded, "masks": masks}


def metrics_table(metrics: DataFrame, key: str, names: list[str] | None = None) -> DataFrame:
    """key and a column for each metric (key, name, value, place), in the order in which names first appear.

    Without `names`, one small aggregate finds them.
    """
    if names is None:
        names = [r["name"] for r in metrics.groupBy("name").agg(F.min("place").alias("p")).orderBy("p", "name").collect()]
    return metrics.groupBy(key).pivot("name", names).agg(F.first("value")).select(key, *[F.col(f"`{c}`") for c in names])


def per_cell_rows(pairs: DataFrame, moving: str) -> DataFrame:
    """moving, ref_x, ref_y (4 places), residual_px (6 places), stage of matched cells, as text for a CSV file."""
    text = lambda c, n: F.format_string(f"%.{n}f", F.col(c))
    return pairs.select(F.lit(moving).alias("moving"), text("ref_x", 4).alias("ref_x"), text("ref_y", 4).alias("ref_y"), text("residual_px", 6).alias("residual_px"), "stage")


def polygon_rows(contours: DataFrame, labels: DataFrame) -> DataFrame:
    """label, ring of the labels that have a ring of 3 different points or more."""
    return contours.join(labels.select("label").distinct(), "label").where(F.size(F.array_distinct("ring")) >= 3).select("label", "ring")


def channel_files(rows: DataFrame) -> DataFrame:
    """rows (channel, height, width); an error unless all have one shape and each channel one file."""
    got = rows.agg(F.countDistinct("height", "width").alias("shapes"), F.count("*").alias("files"), F.countDistinct("channel").alias("channels")).head()
    if got["shapes"] > 1 or got["files"] != got["channels"]:
        raise ValueError(f"{got['files']} files of {got['channels']} channels have {got['shapes']} shapes")
    return rows


def reference_file(files: DataFrame, markers: list[str], extensions: list[str]) -> str:
    """The one file whose name has all markers, whatever the case, and one of the extensions; an error if there isn't just one."""
    name = F.lower(F.regexp_extract("path", r"([^/]*)$", 1))
    has = F.lit(True)
    for m in markers:
        has = has & F.contains(name, F.lit(m.lower()))
    end = F.exists(F.array(*[F.lit(e.lower()) for e in extensions]), lambda e: F.endswith(name, e))
    found = [r["path"] for r in files.where(has & end).orderBy("path").limit(3).collect()]
    if len(found) != 1:
        raise ValueError(f"expected one file with {', '.join(markers)}, found {found or 'none'}")
    return found[0]


def usable_slides(slides: DataFrame, least: int) -> DataFrame:
    """slides (path, height, width) that could be read and aren't smaller than `least` either way."""
    return slides.where((F.col("height") >= least) & (F.col("width") >= least))


def preflight(slides: DataFrame, configured: str, rtol: float = 0.01) -> DataFrame:
    """path, pixel_size (the configured one, or the detected under `auto`), problem: none at all, or far from what was detected."""
    own = F.lit(configured).try_cast("double")
    size = F.when(F.lit(configured.strip().lower() == "auto"), F.col("detected")).otherwise(own)
    far = (F.abs(size - F.col("detected")) > rtol * F.col("detected")) & F.lit(configured.strip().lower() != "auto")
    return slides.select("path", size.alias("pixel_size"), F.when(~F.coalesce(size > 0, F.lit(False)), "no pixel size").when(far, "not what was detected").alias("problem"))


def has_nuclear(channels: Column, markers: list[str]) -> Column:
    return F.exists(channels, lambda c: is_nuclear(c, markers))


def staged(rings: DataFrame, stages: DataFrame) -> DataFrame:
    """rings with stage, every point moved by the stage's transform (m: 9 numbers); there are a few stages, one row each."""
    m = lambda i: F.get("m", F.lit(i))
    moved = F.transform("ring", lambda p: F.struct((m(0) * p["x"] + m(1) * p["y"] + m(2)).alias("x"), (m(3) * p["x"] + m(4) * p["y"] + m(5)).alias("y")))
    return rings.join(F.broadcast(stages)).select("stage", "feature", "hole", moved.alias("ring"))


def geometry_at(rings: DataFrame, stages: DataFrame) -> DataFrame:
    """stage, feature, area, cx, cy of features at each stage."""
    both = staged(rings, stages).withColumn("key", F.struct("stage", "feature"))
    return ring_centroids(both, "key", "ring").select("key.stage", "key.feature", "area", "cx", "cy")


def scored_stages(pairs: DataFrame, ref: DataFrame, moving: DataFrame, stages: DataFrame, anchor: str, threshold: float = 0.5, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """By stage: overlap and displacement of the same pairs (a of ref, b of moving), and how far they are from the anchor stage's.

    ref and moving: rings (feature, hole, ring).  Pairs are found once, at the anchor, by the caller.
    """
    here = ring_centroids(ref, "feature", "ring").select(F.col("feature").alias("a"), F.col("area").alias("area_a"), F.col("cx").alias("ax"), F.col("cy").alias("ay"))
    there = geometry_at(moving, stages).select("stage", F.col("feature").alias("b"), F.col("area").alias("area_b"), "cx", "cy")
    each = pairs.select("a", "b").join(here, "a").join(there, "b").select("stage", "a", "b", "area_a", "area_b", F.hypot(F.col("ax") - F.col("cx"), F.col("ay") - F.col("cy")).alias("distance"))
    name = lambda s: F.concat_ws(":", s, F.col("feature"))
    iou = pair_overlap(each.select("a", F.concat_ws(":", "stage", "b").alias("b")), ref, staged(moving, stages).select(name("stage").alias("feature"), "hole", "ring"))
    scored = _kept(each.withColumn("key", F.concat_ws(":", "stage", "b")).join(iou.select("a", F.col("b").alias("key"), "iou"), ["a", "key"]), "scored")
    by = keep(stage_summary(scored, "stage", "iou", "distance", "area_a", "area_b", threshold))
    base = by.where(F.col("stage") == anchor).select(F.col("iou_mean").alias("_i"), F.col("d_p50").alias("_d"))
    return by.join(F.broadcast(base), how="left").withColumns({"delta_iou": F.col("iou_mean") - F.col("_i"), "delta_d_p50": F.col("d_p50") - F.col("_d")}).drop("_i", "_d")


def paired_stages(ref: DataFrame, moving: DataFrame, stages: DataFrame, anchor: str, factor: float = 1.5, radius: float | None = None, method: str = "lsa", threshold: float = 0.5) -> tuple[DataFrame, DataFrame, Callable[[], DataFrame]]:
    """Pairs found once, at the anchor stage, and what becomes of them at every stage: (matching, residuals, scores).

    ref and moving: rings (feature, hole, ring); stages (stage, m).  Pairs are `match_cells` of centroids within a
    radius: `factor` times that of a circle of the median area of both sides, if none is given.
    matching, one row: pairs, features and those left alone on each side, the radius, how many pairs aren't of an exact assignment.
    residuals: stage, a, b, distance of each pair.  scores, when called: `scored_stages`.
    """
    here = _kept(ring_centroids(ref, "feature", "ring").select(F.col("feature").alias("id"), "area", F.col("cx").alias("x"), F.col("cy").alias("y")), "reference")
    there = _kept(geometry_at(moving, stages).select("stage", F.col("feature").alias("id"), "area", F.col("cx").alias("x"), F.col("cy").alias("y")), "moving")
    held = there.where(F.col("stage") == anchor)
    if radius is None:
        radius = factor * equivalent_radius(here.select("area").unionAll(held.select("area")), "area").head()["radius"]
    pairs = _kept(match_cells(here, held, radius, method), "pairs")
    n = pairs.agg(F.count("*").alias("n_pairs"), F.count_if(~F.col("exact")).alias("n_inexact"))
    sides = here.agg(F.count("*").alias("n_ref")).join(held.agg(F.count("*").alias("n_moving")))
    matching = n.join(sides).select(
        F.lit(anchor).alias("stage"), F.lit(float(radius)).alias("radius"), "n_pairs", "n_inexact", "n_ref", "n_moving", (F.col("n_ref") - F.col("n_pairs")).alias("unmatched_ref"), (F.col("n_moving") - F.col("n_pairs")).alias("unmatched_moving"),
        (F.col("n_pairs") / F.greatest(F.least("n_ref", "n_moving"), F.lit(1))).alias("pair_fraction"),
    )
    both = pairs.select("a", "b").join(here.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay")), "a").join(there.select("stage", F.col("id").alias("b"), "x", "y"), "b")
    residuals = both.select("stage", "a", "b", F.hypot(F.col("ax") - F.col("x"), F.col("ay") - F.col("y")).alias("distance"))
    return matching, residuals, lambda: scored_stages(pairs, ref, moving, stages, anchor, threshold)


def stage_plan(checkpoint: bool, micro: bool) -> tuple[list[str], bool]:
    """The stages that a run can tell apart, in order, and whether the non-rigid one can be: without a checkpoint only the last field is
    known, and without micro registration there is no fourth.
    """
    if not checkpoint:
        return ["native", "rigid", "micro"], False
    return ["native", "rigid", "non_rigid", *(["micro"] if micro else [])], True
