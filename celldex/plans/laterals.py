"""Queries that join slides laterally with table functions: parts stand in for slides."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tables import lateral
from ..sources.tables import table
from .registry import query

_SLIDES = "s as (select p_partkey as slide, 100 + p_partkey % 900 as width, 60 + p_size * 10 as height from part)"


def _slides(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("slide"), (100 + F.col("p_partkey") % 900).alias("width"), (60 + F.col("p_size") * 10).cast("long").alias("height"))


@query(f"with {_SLIDES}, t as (select slide, width, height, unnest(range((width + 255) // 256)) as ix from s), u as (select *, unnest(range((height + 255) // 256)) as iy from t) select slide, ix, iy, greatest(ix * 256 - 16, 0) as x0, greatest(iy * 256 - 16, 0) as y0, least((ix + 1) * 256 + 16, width) as x1, least((iy + 1) * 256 + 16, height) as y1 from u")
def tile_grid(spark, d):
    return lateral(_slides(spark, d), "tile_grid(s.width, s.height, 256, 16)", "s.slide, t.*")


@query(f"with {_SLIDES}, t as (select slide, width, unnest(range(7)) as i from s) select slide, i, width // 7 + (i < width % 7)::integer as size, width // 7 * i + least(i, width % 7) as start from t")
def fov_split(spark, d):
    return lateral(_slides(spark, d), "fov_split(s.width, 7)", "s.slide, t.*")


@query(f"with {_SLIDES}, t as (select slide, width, height, unnest(range(2)) as iy from s), u as (select *, unnest(range(3)) as ix from t) select slide, iy * 3 + ix as index, iy, ix, height // 2 * iy + least(iy, height % 2) as y0, width // 3 * ix + least(ix, width % 3) as x0, height // 2 + (iy < height % 2)::integer as h, width // 3 + (ix < width % 3)::integer as w, (height + 1) // 2 as pad_h, (width + 2) // 3 as pad_w from u")
def fov_grid(spark, d):
    return lateral(_slides(spark, d), "fov_grid(s.height, s.width, 2, 3)", "s.slide, t.*")


@query(f"with recursive {_SLIDES}, l as (select slide, 0::bigint as level, height as h, width as w from s union all select slide, level + 1, h // 2, w // 2 from l where least(h // 2, w // 2) >= 64 and level < 9) select * from l")
def pyramid_levels(spark, d):
    return lateral(_slides(spark, d), "pyramid_levels(s.height, s.width, 64, 10)", "s.slide, t.*")
