"""Queries on planes as tiles: label growth, foreground, registration, warps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import planes, registration, tile_registration
from ..sources.tables import table
from .registry import query

TILE, WIDTH = 32, 100


def _plane(spark, d):
    e = table(spark, d, "events")
    return e.select(F.lit(0).cast("long").alias("plane"), (F.col("event_id") % WIDTH).alias("x"), F.floor(F.col("event_id") / WIDTH).alias("y"), F.col("value").alias("v"), F.col("user_id").cast("double").alias("u"))


def _height(spark, d) -> int:
    """Rows of the plane of events: one number of one aggregate."""
    return table(spark, d, "events").agg(F.max("event_id")).head()[0] // WIDTH + 1


_PX = "px as (select event_id % 100 as x, event_id // 100 as y, value as v, user_id::double as u from events), h as (select max(event_id) // 100 + 1 as h from events)"


def _grown_sql(least: int, reach: int) -> str:
    return (
        f"with {_PX}, l as (select x, y, x * 1000 + y as label from px where v > {least}), s as (select l.x + dx as x, l.y + dy as y, dx * dx + dy * dy as d, label from l, range(-{reach}, {reach + 1}) a(dx), range(-{reach}, {reach + 1}) b(dy) where dx * dx + dy * dy <= {reach * reach}), "
        "b as (select x, y, arg_min(label, {'d': d, 'l': label}) as label from s group by 1, 2) select p.x, q.y, coalesce(b.label, 0) as label from range(100) p(x) cross join (select unnest(range(h)) as y from h) q left join b on b.x = p.x and b.y = q.y"
    )


def _grown(spark, d, least: int, reach: int):
    px = _plane(spark, d).select("plane", "x", "y", F.when(F.col("v") > least, F.col("x") * 1000 + F.col("y")).otherwise(0).alias("label"))
    return planes.grown(px, _height(spark, d), WIDTH, reach, TILE).select("x", "y", "label")


@query(_grown_sql(150, 2))
def grown_labels(spark, d):
    return _grown(spark, d, 150, 2)


@query(_grown_sql(250, 20))
def grown_far(spark, d):
    return _grown(spark, d, 250, 20)


@query(f"with {_PX}, m as (select avg(v) as v, avg(u) as u from px) select px.x, px.y, (px.v > m.v)::integer + (px.u > m.u)::integer as v from px, m")
def thresholded_plane(spark, d):
    return planes.thresholded(_plane(spark, d), ["v", "u"]).select("x", "y", "v")


@query(None)
def separated_foreground(spark, d):
    """Tests hold it against a plain version."""
    px = planes.packed(planes.thresholded(_plane(spark, d), ["v", "u"]), _height(spark, d), WIDTH, TILE)
    return planes.unpacked(planes.foreground_separation(px, (1, 2, 4, 3), (400, 60))).select("x", "y", "v")


@query(None)
def closed_areas(spark, d):
    """Tests hold it against a plain version."""
    px = _plane(spark, d).select("plane", "x", "y", F.when(F.col("v") > 120, 2).when(F.col("v") > 40, 1).otherwise(0).alias("v"))
    return planes.unpacked(planes.area_closing(planes.packed(px, _height(spark, d), WIDTH, TILE), 30)).select("x", "y", "v")


def _layers(spark, d) -> planes.Planes:
    return planes.packed(_plane(spark, d), _height(spark, d), WIDTH, TILE, ["v", "u"], "<f8")


#: A turn and stretch of a few pixels over the plane, and a mesh that bends by two pixels.
_TURN = np.array([[1.004, 0.006, 3.3], [-0.006, 1.004, -2.4], [0, 0, 1]])


def _bend(side: int) -> registration.Mesh:
    at = np.linspace(0, side - 1, max(2, side // 32))
    return registration.Mesh(at, at, np.stack(np.broadcast_arrays(1.2 * np.sin(at / side / 0.6)[None], 1.2 * np.cos(at / side / 0.6)[:, None]), -1))


@query("with s as (select ceil(sqrt(max(event_id) + 1))::bigint as side from events), t as (select unnest(range((side + 31) // 32)) as i from s) select a.i::integer as ix, b.i::integer as iy, true as near from t a, t b")
def registered(spark, d):
    """Events as a square plane, moved by a known transform and mesh, brought back: rows are tiles of the reference and whether they are within half a pixel."""
    side = int(np.ceil(np.sqrt(table(spark, d, "events").agg(F.max("event_id")).head()[0] + 1)))
    square = table(spark, d, "events").select(F.lit(0).alias("plane"), (F.col("event_id") % side).alias("x"), F.floor(F.col("event_id") / side).alias("y"), F.col("value").alias("v"))
    reference, bend = planes.packed(square, side, side, TILE, kind="<f8"), _bend(side)
    found = tile_registration.register(reference, tile_registration.warped_planes(reference, {0: (_TURN, bend)}, side, side), halo=16, gate=0.1)
    m, mesh = found.moves[0]
    at = found.steps["mesh"].select("ix", "iy", "cx", "cy").toPandas().sort_values(["iy", "ix"])  # a row a tile
    q = at[["cx", "cy"]].to_numpy()
    away = np.hypot(*(registration.source(_TURN, bend, registration.source(m, mesh, q), 20) - q).T)
    return spark.createDataFrame([(int(ix), int(iy), bool(a < 0.5)) for ix, iy, a in zip(at["ix"], at["iy"], away, strict=True)], "ix int, iy int, near boolean")


_SHIFT = np.array([[1.0, 0, -2.0], [0, 1, -1.0], [0, 0, 1]])


@query(f"with {_PX}, t as (select x, y, least(x + 2.25, 99) as sx, least(y + 1, (select max(y) from px)) as sy from range(100) a(x) cross join (select unnest(range(h)) as y from h) b) select t.x, t.y, round(coalesce(a.v, 0) * (1 - (sx - floor(sx))) + coalesce(b.v, 0) * (sx - floor(sx)), 6) as v, round(coalesce(a.u, 0) * (1 - (sx - floor(sx))) + coalesce(b.u, 0) * (sx - floor(sx)), 6) as u from t left join px a on a.x = floor(sx) and a.y = sy left join px b on b.x = least(floor(sx) + 1, 99) and b.y = sy")
def warped_channels(spark, d):
    mesh = registration.Mesh([0.0, 50.0], [0.0], np.tile([-0.25, 0.0], (1, 2, 1)))
    out = tile_registration.warped_planes(_layers(spark, d), {0: (_SHIFT, mesh)}, _height(spark, d), WIDTH)
    return planes.unpacked(out, ["v", "u"]).select("x", "y", F.round("v", 6).alias("v"), F.round("u", 6).alias("u"))


@query(f"with {_PX} select 0::bigint as plane, 7e0 as dx, -4e0 as dy from px limit 1")
def coarse_anchor(spark, d):
    """The plane of events and the same moved by whole pixels; what is found is rounded to them."""
    height = _height(spark, d)
    reference = _layers(spark, d)
    moving = planes.packed(_plane(spark, d).withColumns({"x": F.col("x") - 7, "y": F.col("y") + 4}), height, WIDTH, TILE, ["v"], "<f8")
    return tile_registration.coarse_anchor(reference, moving, max(height, WIDTH)).select("plane", F.round("dx").alias("dx"), F.round("dy").alias("dy"))
