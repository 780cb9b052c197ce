"""Exports: wide tables and GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import centre_to_corner, json_text, round_even
from .shapes import contours, feature_text, write_collection


def wide(rows: DataFrame, key: str, marker: str, value: str, markers: list[str]) -> DataFrame:
    """A row for each key with the sum of each marker's values, NULL without any; the markers are declared, so no extra pass finds them."""
    return rows.groupBy(key).pivot(marker, markers).agg(F.sum(value))


#: Shown names of shape columns, and the power of the pixel size that each is multiplied by.
SHAPES = {
    "eccentricity": ("Eccentricity", 0),
    "perimeter": ("Perimeter µm", 1),
    "solidity": ("Solidity", 0),
    "convex_area": ("Convex Area µm²", 2),
    "axis_major_length": ("Major Axis Length µm", 1),
    "axis_minor_length": ("Minor Axis Length µm", 1),
}


def measurements(label: Column, cx: Column, cy: Column, markers: list[str], pixel: float, shapes: list[str] = ()) -> Column:
    """name, value structs of what isn't NULL or NaN: the label, the centroid from pixel corners in micrometres (3 places), markers (4 places),
    and of shape columns the area (3 places) and the rest (4 places), in units of the pixel size.
    """
    one = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"))
    real = lambda c: F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan")))
    known = [one("label", label), one("Centroid X µm", round_even(centre_to_corner(cx) * pixel, 3)), one("Centroid Y µm", round_even(centre_to_corner(cy) * pixel, 3))]
    marks = [one(m, round_even(real(m), 4)) for m in markers]
    area = [one("Area µm²", round_even(real("area") * pixel * pixel, 3))] if "area" in shapes else []
    rest = [one(name, round_even(real(c) * pixel**power, 4)) for c, (name, power) in SHAPES.items() if c in shapes]
    return F.filter(F.array(*known, *marks, *area, *rest), lambda m: m["value"].isNotNull())


def features(cells: DataFrame, label: str, cx: str, cy: str, markers: list[str], pixel: float) -> DataFrame:
    """label, feature: a GeoJSON point feature for each cell, as JSON text, made row by row in place."""
    shape = F.struct(F.lit("Point").alias("type"), F.array(F.col(cx).cast("double"), F.col(cy).cast("double")).alias("coordinates"))
    props = F.struct(F.lit("detection").alias("objectType"), measurements(F.col(label), F.col(cx), F.col(cy), markers, pixel).alias("measurements"))
    one = F.struct(F.lit("Feature").alias("type"), F.col(label).cast("string").alias("id"), shape.alias("geometry"), props.alias("properties"))
    return cells.select(label, json_text(one, cells.select(one.alias("f")).schema["f"].dataType).alias("feature"))


def write_features(cells: DataFrame, path: str) -> None:
    """Feature lines as text files, one a task, each line a feature."""
    cells.select("feature").write.mode("overwrite").text(path)


def write_slide(cells: DataFrame, pixels: DataFrame, path: str, label: str, cx: str, cy: str, markers: list[str], pixel: float, shapes: list[str] = (), tolerance: float = 1.0) -> None:
    """A slide's cells as one FeatureCollection (`shapes.write_collection`): their outlines, traced from pixels (label, x, y), or else their
    centroids, with their measurements; cells without a centroid are left out.
    """
    of = F.struct(F.lit("detection").alias("objectType"), measurements(F.col(label), F.col(cx), F.col(cy), markers, pixel, shapes).alias("measurements"))
    rings = contours(pixels, tolerance).withColumnRenamed("label", label)
    write_collection(feature_text(cells, rings, label, cx, cy, of), path, label)
