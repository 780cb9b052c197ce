"""Queries on pixels, tiles, points and shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geometry, matching, raster
from ..sources.tables import table
from .registry import query


def _pixels(spark, d):
    return table(spark, d, "events").select(F.col("event_type").alias("label"), (F.col("event_id") % 100).alias("x"), F.floor(F.col("event_id") / 100).alias("y"), F.col("value").alias("v"))


_PX = "with px as (select event_type as label, event_id % 100 as x, event_id // 100 as y, value as v from events)"


@query(
    "with s as (select l_orderkey as label, count(*) as area, sum(l_partkey) as sx, sum(l_suppkey) as sy, sum(l_partkey * l_partkey) as sxx, sum(l_suppkey * l_suppkey) as syy, sum(l_partkey * l_suppkey) as sxy, min(l_partkey) as x0, min(l_suppkey) as y0, max(l_partkey) as x1, max(l_suppkey) as y1 from lineitem group by 1), "
    "c as (select *, cast(area * sxx - sx * sx as double) / (area * area) as cxx, cast(area * syy - sy * sy as double) / (area * area) as cyy, cast(area * sxy - sx * sy as double) / (area * area) as cxy from s), "
    "e as (select *, (cxx + cyy) / 2 as h, sqrt((cxx - cyy) / 2 * (cxx - cyy) / 2 + cxy * cxy) as r from c) "
    "select label, area, round(sx / cast(area as double), 4) as cx, round(sy / cast(area as double), 4) as cy, x0, y0, x1, y1, round(4 * sqrt(h + r), 3) as major, round(4 * sqrt(greatest(h - r, 0)), 3) as minor, round(case when h + r > 0 then sqrt(1 - greatest(h - r, 0) / (h + r)) else 0 end, 4) as eccentricity from e"
)
def morphology(spark, d):
    px = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("label"), F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y"))
    return geometry.morphology(px).withColumns({c: F.round(c, p) for c, p in (("cx", 4), ("cy", 4), ("major", 3), ("minor", 3), ("eccentricity", 4))})


def _height(spark, d) -> int:
    """Rows of the plane of events: one number of one aggregate."""
    return _pixels(spark, d).agg(F.max("y")).head()[0] + 1


_BORDER = _PX + ", own as (select p.label, p.x, p.y from px p where (select count(*) from (values (1, 0), (-1, 0), (0, 1), (0, -1)) s(dx, dy) join px q on q.label = p.label and q.x = p.x + dx and q.y = p.y + dy) < 4 - %s)"


@query(_BORDER.replace("%s", "(p.x = 0)::integer - (p.x = 99)::integer - (p.y = 0)::integer - (p.y = (select max(y) from px))::integer") + " select * from own")
def inner_boundary(spark, d):
    return geometry.boundary(_pixels(spark, d), _height(spark, d), 100)


@query(_BORDER.replace("%s", "0") + ", c as (select a.label, a.x, a.y, sum(case when a.x = b.x and a.y = b.y then 1 when a.x = b.x or a.y = b.y then 2 else 10 end)::integer as code from own a join own b on b.label = a.label and abs(a.x - b.x) <= 1 and abs(a.y - b.y) <= 1 group by 1, 2, 3) select label, round(sum(case when code in (5, 7, 15, 17, 25, 27) then 1 when code in (21, 33) then sqrt(2) when code in (13, 23) then (1 + sqrt(2)) / 2 else 0 end), 6) as perimeter from c group by 1")
def perimeter(spark, d):
    return geometry.perimeter(_pixels(spark, d)).withColumn("perimeter", F.round("perimeter", 6))


# Doubled, so that halves are whole, and moved by 2000, so that quotients round one way.
_HULL = (
    _PX + ", rows as (select label, y, min(x) as low, max(x) as high, count(distinct x) as n from px where label is not null group by 1, 2), "
    "r as (select label, 2 * high + 1 + 2000 as x, 2 * y as y from rows union all select label, 2 * high + 2000, 2 * y + unnest([-1, 1]) from rows), l as (select label, 2 * low - 1 + 2000 as x, 2 * y as y from rows union all select label, 2 * low + 2000, 2 * y + unnest([-1, 1]) from rows), "
    "ys as (select label, unnest(range(min(y), max(y) + 1)) as y from rows group by 1), "
    "hi as (select ys.label, ys.y, max(case when u.y = v.y then u.x // 2 else (u.x * (v.y - 2 * ys.y) + v.x * (2 * ys.y - u.y)) // (2 * (v.y - u.y)) end) as x from ys join r u on u.label = ys.label and u.y <= 2 * ys.y join r v on v.label = ys.label and v.y >= 2 * ys.y group by 1, 2), "
    "lo as (select ys.label, ys.y, min(case when u.y = v.y then (u.x + 1) // 2 else (u.x * (v.y - 2 * ys.y) + v.x * (2 * ys.y - u.y) + 2 * (v.y - u.y) - 1) // (2 * (v.y - u.y)) end) as x from ys join l u on u.label = ys.label and u.y <= 2 * ys.y join l v on v.label = ys.label and v.y >= 2 * ys.y group by 1, 2)"
)


@query(_HULL + " select label, a.area, c.convex_area, a.area / c.convex_area::double as solidity from (select label, sum(n)::bigint as area from rows group by 1) a join (select label, sum(hi.x - lo.x + 1)::bigint as convex_area from hi join lo using (label, y) group by 1) c using (label)")
def convex_area(spark, d):
    return geometry.convex_area(_pixels(spark, d))


@query(_PX + " select a.x, a.y, round(median(b.v), 6) as v from px a join px b on b.x between a.x - 1 and a.x + 1 and b.y between a.y - 1 and a.y + 1 and b.v < 200 group by 1, 2")
def median_filter(spark, d):
    return raster.median_filter(_pixels(spark, d), F.col("v") < 200, 1).withColumn("v", F.round("v", 6))


@query(_PX + ", f as (select x % 10 as px, y % 10 as py, avg(v) as flat, min(v) as dark from px group by 1, 2) select x, y, round(least(greatest((v - dark) / flat * 100, 0), 255), 4) as v from px join f on px = x % 10 and py = y % 10")
def flat_field(spark, d):
    px = _pixels(spark, d)
    profile = px.groupBy((F.col("x") % 10).alias("px"), (F.col("y") % 10).alias("py")).agg((F.avg("v") / 100).alias("flat"), F.min("v").alias("dark"))
    return raster.flat_field(px, profile, 10, 255.0).select("x", "y", F.round("v", 4).alias("v"))


@query(_PX + ", n as (select label, avg(v) as m from px group by 1) select label, cast(count_if(v > m) as bigint) as above, count(*) as n from px join n using (label) group by 1")
def mean_threshold(spark, d):
    return raster.above_mean(_pixels(spark, d), "label")


@query(_PX + ", p as (select *, quantile_cont(v, 0.01) over (partition by label) as lo, quantile_cont(v, 0.998) over (partition by label) as hi from px) select x, y, round(case when hi > lo then least(greatest((v - lo) / (hi - lo), 0), 1) else 0 end, 6) as v from p")
def percentile_normalise(spark, d):
    return raster.percentile_scale(_pixels(spark, d), "label", 0.01, 0.998).select("x", "y", F.round("v", 6).alias("v"))


@query("with t as (select ix, iy, ix * 256 as x0, iy * 256 as y0, least(ix * 256 + 256, 2000) as x1, least(iy * 256 + 256, 1500) as y1 from range(8) a(ix), range(6) b(iy)), w as (select p_partkey as id, p_partkey % 1900 as x0, p_size * 20 as y0, p_partkey % 1900 + 300 as x1, p_size * 20 + 100 as y1 from part) select id, ix, iy, cast(greatest(t.x0, w.x0) as bigint) as x0, cast(greatest(t.y0, w.y0) as bigint) as y0, cast(least(t.x1, w.x1) as bigint) as x1, cast(least(t.y1, w.y1) as bigint) as y1 from w join t on t.x0 < w.x1 and w.x0 < t.x1 and t.y0 < w.y1 and w.y0 < t.y1")
def fov_overlap(spark, d):
    x, y = F.col("p_partkey") % 1900, (F.col("p_size") * 20).cast("long")
    windows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), x.alias("x0"), y.alias("y0"), (x + 300).alias("x1"), (y + 100).alias("y1"))
    return raster.tile_overlaps(windows, 2000, 1500, 256)


@query(
    "with p as (select vec_id, least(greatest((embedding[1]::double * 40 + 5), 0), 10) as x, least(greatest((embedding[2]::double * 40 + 5), 0), 10) as y from embeddings), m as (select i, j, sin(i * 0.5) * 3 as dx, cos(j * 0.5) * 2 as dy from range(11) a(i), range(11) b(j)), "
    "c as (select vec_id, (case when di = 1 then x - floor(x) else 1 - (x - floor(x)) end) * (case when dj = 1 then y - floor(y) else 1 - (y - floor(y)) end) as w, dx, dy from p, range(2) a(di), range(2) b(dj), m where m.i = least(cast(floor(x) as bigint) + di, 10) and m.j = least(cast(floor(y) as bigint) + dj, 10)) select vec_id, round(sum(w * dx), 5) as dx, round(sum(w * dy), 5) as dy from c group by 1"
)
def mesh_displacement(spark, d):
    at = lambda i: F.get("embedding", F.lit(i)).cast("double") * 40 + 5
    points = table(spark, d, "embeddings").select("vec_id", at(0).alias("x"), at(1).alias("y"))
    node = spark.range(121).select(F.floor(F.col("id") / 11).alias("i"), (F.col("id") % 11).alias("j"))
    return raster.mesh_displacement(points, "vec_id", node.select("i", "j", (F.sin(F.col("i") * 0.5) * 3).alias("dx"), (F.cos(F.col("j") * 0.5) * 2).alias("dy"))).select("vec_id", F.round("dx", 5).alias("dx"), F.round("dy", 5).alias("dy"))


def _points(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), (F.col("c_nationkey") * 10).cast("double").alias("y"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("x"), (F.col("s_nationkey") * 10).cast("double").alias("y"))
    return a, b


_PAIRS = "a as (select c_custkey as a, c_acctbal as x, cast(c_nationkey * 10 as double) as y from customer), b as (select s_suppkey as b, s_acctbal as x, cast(s_nationkey * 10 as double) as y from supplier), p as (select a * 2 as a, b * 2 + 1 as b from a, b where (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 900)"


@query(f"with recursive {_PAIRS}, e as (select a, b from p union select b, a from p), r(node, reach) as (select a, a from e union select r.node, e.b from r join e on e.a = r.reach) select node, min(reach) as component from r group by 1")
def spatial_components(spark, d):
    return matching.linked(*_points(spark, d), 30.0)


@query(None)
def best_matches(spark, d):
    return matching.best_matches(*_points(spark, d), 30.0).withColumn("distance", F.round("distance", 6))


@query("with v as (select vec_id, label, [{'x': embedding[1]::double, 'y': embedding[2]::double}, {'x': embedding[3]::double, 'y': embedding[4]::double}, {'x': embedding[5]::double, 'y': embedding[6]::double}] as r from embeddings), e as (select vec_id, r[i] as p, r[i % 3 + 1] as q from v, range(1, 4) t(i)), s as (select vec_id, sum(p.x * q.y - q.x * p.y) as a, sum((p.x + q.x) * (p.x * q.y - q.x * p.y)) as ax, sum((p.y + q.y) * (p.x * q.y - q.x * p.y)) as ay from e group by 1) select vec_id, round(abs(a) / 2, 6) as area, round(ax / (3 * a), 3) as cx, round(ay / (3 * a), 3) as cy from s")
def feature_centroid(spark, d):
    at = lambda i: F.struct(F.get("embedding", F.lit(i)).cast("double").alias("x"), F.get("embedding", F.lit(i + 1)).cast("double").alias("y"))
    rings = table(spark, d, "embeddings").select("vec_id", F.array(at(0), at(2), at(4)).alias("ring"))
    return geometry.ring_centroids(rings, "vec_id", "ring").select("vec_id", F.round("area", 6).alias("area"), F.round("cx", 3).alias("cx"), F.round("cy", 3).alias("cy"))
