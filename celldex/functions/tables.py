"""Table functions for lateral joins with a table of slides: tiles, fields of view, pyramid levels.

    SELECT s.id, t.* FROM slides s, LATERAL tile_grid(s.width, s.height, 256, 16) t

A slide gives some hundred rows or more, made in the tasks that hold the slides; nothing is shuffled.  NULL
sizes give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf


def parts(length: int, n: int) -> list[tuple[int, int]]:
    """Size and start of near-equal parts of a length; the first ones take the remainder."""
    each, more = divmod(length, n)
    return [(each + (i < more), i * each + min(i, more)) for i in range(n)]


@udtf(returnType="ix bigint, iy bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
class TileGrid:
    """Tiles of a plane, each grown by overlap on every side and clipped."""

    def eval(self, width: int, height: int, tile: int, overlap: int) -> Iterator[tuple]:
        if width is None or height is None:
            return
        for iy in range(-(-height // tile)):
            for ix in range(-(-width // tile)):
                yield ix, iy, max(0, ix * tile - overlap), max(0, iy * tile - overlap), min(width, (ix + 1) * tile + overlap), min(height, (iy + 1) * tile + overlap)


@udtf(returnType="i bigint, size bigint, start bigint")
class FovSplit:
    """Near-equal parts of a length."""

    def eval(self, length: int, n: int) -> Iterator[tuple]:
        if length is not None:
            for i, (size, start) in enumerate(parts(length, n)):
                yield i, size, start


@udtf(returnType="index bigint, iy bigint, ix bigint, y0 bigint, x0 bigint, h bigint, w bigint, pad_h bigint, pad_w bigint")
class FovGrid:
    """Near-equal fields, row by row, and the size that all are padded to."""

    def eval(self, height: int, width: int, down: int, across: int) -> Iterator[tuple]:
        if width is None or height is None:
            return
        for iy, (h, y0) in enumerate(parts(height, down)):
            for ix, (w, x0) in enumerate(parts(width, across)):
                yield iy * across + ix, iy, ix, y0, x0, h, w, -(-height // down), -(-width // across)


@udtf(returnType="level bigint, h bigint, w bigint")
class PyramidLevels:
    """Halved sizes, rounding down, while the shorter side keeps `least`; `most` levels at most."""

    def eval(self, height: int, width: int, least: int, most: int) -> Iterator[tuple]:
        if width is None or height is None:
            return
        for level in range(most):
            if level and min(height, width) >> level < least:
                return
            yield level, height >> level, width >> level


FUNCTIONS = {"tile_grid": TileGrid, "fov_split": FovSplit, "fov_grid": FovGrid, "pyramid_levels": PyramidLevels}


def register(spark: SparkSession) -> None:
    """The functions under their names, for SQL of this session."""
    for name, f in FUNCTIONS.items():
        spark.udtf.register(name, f)


def lateral(slides: DataFrame, call: str, columns: str = "s.*, t.*") -> DataFrame:
    """slides (as s) joined with what the table function `call` gives for each (as t)."""
    register(slides.sparkSession)
    return slides.sparkSession.sql(f"SELECT {columns} FROM {{slides}} s, LATERAL {call} t", slides=slides)
