"""Queries on planes, shapes, registration and the quality of segmentations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import raster, registration, seg_quality, shapes
from ..sources.tables import table
from .registry import query


def _pixels(spark, d):
    return table(spark, d, "events").select(F.col("event_type").alias("label"), (F.col("event_id") % 100).alias("x"), F.floor(F.col("event_id") / 100).alias("y"), F.col("value").alias("v"))


_PX = "px as (select event_type as label, event_id % 100 as x, event_id // 100 as y, value as v from events)"
_FOVS = "z as (select max(event_id) // 100 + 1 as z from events), y as (select iy, z // 7 * iy + least(iy, z % 7) as y0, z // 7 + cast(iy < z % 7 as integer) as h from z, range(7) t(iy)), x as (select ix, 20 * ix as x0, 20 as w from range(5) t(ix)), g as (select iy * 5 + ix as index, iy, ix, y0, x0, h, w from y, x)"


def _height(spark, d) -> int:
    """Rows of the plane of events: one number of one aggregate."""
    return table(spark, d, "events").agg(F.max("event_id")).head()[0] // 100 + 1


@query(f"with {_PX}, {_FOVS} select index, px.y - y0 as y, px.x - x0 as x, v from px join g on px.y >= y0 and px.y < y0 + h and px.x >= x0 and px.x < x0 + w")
def fov_pixels(spark, d):
    return raster.split_fovs(_pixels(spark, d), _height(spark, d), 100, 7, 5)


@query(f"with {_PX} select x, y, v from px")
def fov_round_trip(spark, d):
    height = _height(spark, d)
    fields = raster.split_fovs(_pixels(spark, d), height, 100, 7, 5)
    grid = raster.fov_grid(spark, height, 100, 7, 5)
    return raster.join_fovs(raster.padded_fovs(fields, grid), grid)


@query(f"with {_PX} select x // 3 as x, y // 3 as y, v from px where x % 3 = 0 and y % 3 = 0")
def strided_pixels(spark, d):
    return raster.every_nth(_pixels(spark, d), 3)


@query(f"with {_PX}, e as (select label, min(v) as lo, max(v) as hi from px group by 1) select x, y, cast(round_even((v - lo) / (hi - lo) * 255, 0) as integer) as v from px join e using (label)")
def display_bytes(spark, d):
    return raster.to_bytes(_pixels(spark, d), "label").select("x", "y", "v")


@query(f"with {_PX} select x, y, x % 256 as r, case when x < 60 then y % 256 else 0 end as g, 0 as b from px")
def overlay_colors(spark, d):
    px = _pixels(spark, d)
    ref, mov = px.select("x", "y", (F.col("x") % 256).cast("double").alias("v")), px.where("x < 60").select("x", "y", (F.col("y") % 256).cast("double").alias("v"))
    return raster.overlay(registration.on_canvas(ref, mov))


@query(f"with {_PX} select x, y, v from px union all select x + 110, y, v from px where x < 10")
def before_after(spark, d):
    px = _pixels(spark, d).select("x", "y", "v")
    return raster.side_by_side(px, px.where("x < 10"), 100, 10)


@query(f"with {_PX}, p as (select x % 10 as px, y % 10 as py, avg(v) - 90 as flat from px group by 1, 2) select 'not positive' as problem, count(*) as n from p where flat <= 0 having count(*) > 0")
def profile_problems(spark, d):
    px = _pixels(spark, d)
    return raster.profile_problems(px.groupBy((F.col("x") % 10).alias("px"), (F.col("y") % 10).alias("py")).agg((F.avg("v") - 90).alias("flat")), 10, True)


@query("select vec_id, least(x0, x1, x2) as x0, least(y0, y1, y2) as y0, greatest(x0, x1, x2) as x1, greatest(y0, y1, y2) as y1 from (select vec_id, embedding[1]::double x0, embedding[2]::double y0, embedding[3]::double x1, embedding[4]::double y1, embedding[5]::double x2, embedding[6]::double y2 from embeddings)")
def feature_boxes(spark, d):
    at = lambda i: F.struct(F.get("embedding", F.lit(i)).cast("double").alias("x"), F.get("embedding", F.lit(i + 1)).cast("double").alias("y"))
    return shapes.boxes(table(spark, d, "embeddings").select("vec_id", F.array(at(0), at(2), at(4)).alias("ring")), "vec_id")


@query("select p_partkey as feature, part, hole, n from part, (values (0, false, 4), (0, true, 3)) t(part, hole, n) where p_partkey % 3 = 0 union all select p_partkey, part, false, 3 from part, (values (0), (1)) t(part) where p_partkey % 3 = 1")
def parsed_polygons(spark, d):
    k = F.col("p_partkey")
    one = F.format_string('{"type":"Polygon","coordinates":[[[0,0],[%d,0],[4,4],[0,4]],[[1,1],[2,1],[1,2]],[[1,1]]]}', k)
    two = F.lit('{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[0,1]]],[[[5,5],[6,5],[5,6]]]]}')
    features = table(spark, d, "part").select(k.alias("feature"), F.when(k % 3 == 0, one).when(k % 3 == 1, two).otherwise('{"type":"Point","coordinates":[1,2]}').alias("geometry"))
    return shapes.polygons(features, "geometry", "feature").select("feature", "part", "hole", F.size("ring").alias("n"))


@query(None)
def contours(spark, d):
    px = _pixels(spark, d).select((F.floor(F.col("x") / 10) * 100 + F.floor(F.col("y") / 10) + 1).alias("label"), "x", "y", "v")
    return shapes.contours(px.where("v > 20"))


_EDGE = "case when (y{0} <= y) <> (y{1} <= y) then x{0} + (y - y{0}) * (x{1} - x{0}) / (y{1} - y{0}) end"
_ROWS = ", ".join(f"greatest(0, ceil(least({c})))::bigint as lo{s}, floor(greatest({c}))::bigint as hi{s}" for s, c in ((s, ", ".join(_EDGE.format(f"{s}{i}", f"{s}{i % 3 + 1}") for i in (1, 2, 3))) for s in "ab"))
_AT = ", ".join(f"({c}{s}{i} - o{c}) * 2 as {c}{s}{i}" for c in "xy" for s in "ab" for i in (1, 2, 3))
_TRIANGLES = (
    "t as (select vec_id as f, embedding[1]::double * 20 as x1, embedding[2]::double * 20 as y1, embedding[3]::double * 20 as x2, embedding[4]::double * 20 as y2, embedding[5]::double * 20 as x3, embedding[6]::double * 20 as y3 from embeddings), "
    "p as (select a.f as a, " + ", ".join(f"{s}.{c}{i} as {c}{s}{i}" for s in "ab" for c in "xy" for i in (1, 2, 3)) + " from t a join t b on b.f = a.f + 1), "
    "w as (select *, least(xa1, xa2, xa3, xb1, xb2, xb3) - 0.5e0 as ox, least(ya1, ya2, ya3, yb1, yb2, yb3) - 0.5e0 as oy, ceil((greatest(ya1, ya2, ya3, yb1, yb2, yb3) - least(ya1, ya2, ya3, yb1, yb2, yb3)) * 2)::bigint + 2 as h from p), "
    f"g as (select a, h, {_AT} from w), r as (select *, unnest(range(h)) as y from g), c as (select a, {_ROWS} from r), "
    "n as (select a, greatest(coalesce(hia - loa + 1, 0), 0) as m, greatest(coalesce(hib - lob + 1, 0), 0) as n, case when hia is null or hib is null then 0 else greatest(least(hia, hib) - greatest(loa, lob) + 1, 0) end as i from c)"
)


@query(f"with {_TRIANGLES}, o as (select a, sum(i)::double as i, sum(m + n)::double as s from n group by 1) select vec_id as a, vec_id + 1 as b, round(case when s - i > 0 then i / (s - i) end, 6) as iou from embeddings left join o on a = vec_id")
def pair_overlap(spark, d):
    at = lambda i: F.struct((F.get("embedding", F.lit(i)).cast("double") * 20).alias("x"), (F.get("embedding", F.lit(i + 1)).cast("double") * 20).alias("y"))
    rings = table(spark, d, "embeddings").select(F.col("vec_id").alias("feature"), F.lit(False).alias("hole"), F.array(at(0), at(2), at(4)).alias("ring"))
    return shapes.pair_overlap(rings.select(F.col("feature").alias("a"), (F.col("feature") + 1).alias("b")), rings, rings).withColumn("iou", F.round("iou", 6))


_POLYGON = "'[[[' || cx || ',' || cy || '],[' || (cx + 4) || ',' || cy || '],[' || (cx + 4) || ',' || (cy + 4) || '],[' || cx || ',' || cy || ']]]'"


@query(
    f"""with c as (select c_custkey as label, c_acctbal as cx, c_nationkey * 10e0 as cy from customer), k as (select *, unnest(['detection', 'annotation']) as kind from c) select label, '{{"type":"Feature","id":"' || label || '","geometry":' || case when label % 2 = 0 then '{{"type":"Polygon","coordinates":' || {_POLYGON} || '}}' else '{{"type":"Point","coordinates":[' || cx || ',' || cy || ']}}' end || ',"properties":{{"objectType":"' || kind || '"}}}}' as feature from k"""
)
def combined_features(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("label"), F.col("c_acctbal").alias("cx"), (F.col("c_nationkey") * 10.0).alias("cy"))
    ring = F.array(*[F.struct((F.col("cx") + a).alias("x"), (F.col("cy") + b).alias("y")) for a, b in ((0, 0), (4, 0), (4, 4), (0, 0))])
    rings = c.where("label % 2 = 0").select("label", ring.alias("ring"))
    nuclei, cells = shapes.combined_features(c, rings, rings, "label", "cx", "cy", F.struct(F.lit("detection").alias("objectType")))
    return nuclei.unionByName(cells)


@query(
    "with e as (select event_type as slide, case when event_id % 2 = 0 then 'before' else 'after' end as state, value * case when event_id % 2 = 0 then 2 else 1 end as d, event_id // 2 % 100 as x, event_id // 200 as y, value as a, value + case when event_id % 2 = 0 then user_id else 0 end as b from events), "
    "w as (select slide, state, d from e where d <= 50), r as (select slide, state, quantile_cont(d, 0.5) as p50, quantile_cont(d, 0.9) as p90, count(*) as n from w group by 1, 2), "
    "z as (select slide, state, max(x) + 1 as w, max(y) + 1 as h from e group by 1, 2), c as (select slide, state, corr(a, b) as correlation from e join z using (slide, state) where x >= floor(w * 0.15) and x < w - floor(w * 0.15) and y >= floor(h * 0.15) and y < h - floor(h * 0.15) group by 1, 2), "
    "j as (select * from r join c using (slide, state)) select slide, "
    + ", ".join(f"round(max({c}) filter (state = '{s}'), 6) as {c}_{s}" for s in ("before", "after") for c in ("p50", "p90", "correlation")) + ", " + ", ".join(f"max(n) filter (state = '{s}') as n_{s}" for s in ("before", "after"))
    + ", round(max(p50) filter (state = 'before') - max(p50) filter (state = 'after'), 6) as improvement from j group by 1"
)
def registration_benchmark(spark, d):
    k = F.col("event_id")
    e = table(spark, d, "events").select(F.col("event_type").alias("slide"), F.when(k % 2 == 0, "before").otherwise("after").alias("state"), (F.col("value") * F.when(k % 2 == 0, 2).otherwise(1)).alias("distance"), (F.floor(k / 2) % 100).alias("x"), F.floor(k / 200).alias("y"), F.col("value").alias("a"), (F.col("value") + F.when(k % 2 == 0, F.col("user_id")).otherwise(0)).alias("b"))
    out = registration.before_after(e, e, "slide")
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "slide" and not c.startswith("n_")})


@query("with px as (select event_id % 100 as x, event_id // 100 as y, value as v, event_type as channel from events), f as (select channel, x % 10 as px, y % 10 as py, avg(v) / 100 as flat, min(v) as dark from px group by 1, 2, 3) select channel, x, y, round(case when channel in ('click', 'view') then coalesce(least(greatest((v - dark) / flat, 0), 255), v) else v end, 4) as v from px left join f using (channel) where px = x % 10 and py = y % 10")
def corrected_channels(spark, d):
    px = table(spark, d, "events").select(F.col("event_type").alias("channel"), (F.col("event_id") % 100).alias("x"), F.floor(F.col("event_id") / 100).alias("y"), F.col("value").alias("v"))
    profiles = px.groupBy("channel", (F.col("x") % 10).alias("px"), (F.col("y") % 10).alias("py")).agg((F.avg("v") / 100).alias("flat"), F.min("v").alias("dark"))
    return raster.corrected_channels(px, profiles, raster.correctable(["click", "view"], ["DAPI"]), 10, 255.0).withColumn("v", F.round("v", 4))


def _controls(spark, d):
    e = table(spark, d, "embeddings")
    v = lambda i: F.get("embedding", F.lit(i)).cast("double")
    error = F.when(F.col("vec_id") % 11 == 0, F.lit(float("nan"))).when(F.col("vec_id") % 7 != 0, F.abs(v(2)))
    return e.select((F.col("vec_id") % 20).alias("ix"), F.floor(F.col("vec_id") / 20).alias("iy"), (F.col("vec_id") % 20 * 100.0).alias("cx"), (F.floor(F.col("vec_id") / 20) * 100.0).alias("cy"), (v(0) * 10).alias("dx"), (v(1) * 10).alias("dy"), F.hypot(v(0) * 10, v(1) * 10).alias("tre"), error.alias("error"))


_CTRL = "c as (select vec_id % 20 as ix, vec_id // 20 as iy, embedding[1]::double * 10 as dx, embedding[2]::double * 10 as dy, case when vec_id % 11 = 0 then 'nan'::double when vec_id % 7 <> 0 then abs(embedding[3]::double) end as error from embeddings), w as (select *, sqrt(dx * dx + dy * dy) as tre, case when sqrt(dx * dx + dy * dy) >= 3 then 'disp' when error is not null and not (error <= 0.25) then 'error' end as why from c)"


@query(f"with {_CTRL}, g as (select ix, iy, why is null as ok, case when why is null and tre >= 1 then dx else 0 end as dx, case when why is null and tre >= 1 then dy else 0 end as dy from w), m as (select a.ix, a.iy, median(b.dx) as dx, median(b.dy) as dy from g a join g b on abs(a.ix - b.ix) <= 1 and abs(a.iy - b.iy) <= 1 and b.ok group by 1, 2) select g.ix, g.iy, g.ix * 100e0 as cx, g.iy * 100e0 as cy, round(case when ok then m.dx else 0 end, 6) as dx, round(case when ok then m.dy else 0 end, 6) as dy from g left join m using (ix, iy)")
def control_grid(spark, d):
    return registration.control_grid(_controls(spark, d), 1.0, 0.25, 3.0).withColumns({c: F.round(c, 6) for c in ("dx", "dy")})


@query(f"with {_CTRL} select count_if(why is null)::bigint as accepted, count_if(why = 'error')::bigint as n_error, count_if(why = 'disp')::bigint as n_disp, count_if(error is null and why is null)::bigint as n_legacy from w")
def gate_counts(spark, d):
    return registration.gate_counts(_controls(spark, d), 0.25, 3.0)


@query("with t as (select event_id // 1024 as tile, count(*) as n from events group by 1) select tile, (tile % 4)::double as dx, 0e0 as dy from t where n = 1024")
def tile_residuals(spark, d):
    """Tiles of 32 x 32 events, and the same turned round by the tile's number of columns: what brings them back."""
    k = F.col("event_id")
    e = table(spark, d, "events").select(F.floor(k / 1024).alias("tile"), (k % 32).alias("x"), F.floor(k % 1024 / 32).alias("y"), F.col("value").alias("v"))
    full = e.groupBy("tile").agg(F.count("*").alias("n")).where("n = 1024").select("tile")
    moved = e.select("tile", F.pmod(F.col("x") - F.col("tile") % 4, F.lit(32)).alias("x"), "y", F.col("v").alias("mov"))
    tiles = e.withColumnRenamed("v", "ref").join(moved, ["tile", "x", "y"]).join(full, "tile", "left_semi")
    return registration.tile_residuals(tiles).select("tile", F.round("dx").alias("dx"), F.round("dy").alias("dy"))


@query("with t as (select event_id // 1000 as tile, count_if(event_id % 1000 < 250) / count(*)::double as fraction, count(*) as n from events group by 1) select tile, round(case when tile % 2 = 0 then fraction else 0 end, 6) as fraction from t where n = 1000")
def foreground_share(spark, d):
    """Tiles of 1000 events: even ones with a quarter far brighter than the rest, odd ones all alike."""
    k = F.col("event_id")
    e = table(spark, d, "events").select(F.floor(k / 1000).alias("tile"), (k % 1000).alias("i"))
    v = F.when(F.col("tile") % 2 == 1, 7.0).when(F.col("i") < 250, 1000.0 + F.col("i") % 5).otherwise(F.col("i") % 7)
    full = e.groupBy("tile").agg(F.count("*").alias("n")).where("n = 1000").select("tile")
    return registration.foreground(e.select("tile", v.alias("v")).join(full, "tile", "left_semi"), "tile", "v").withColumn("fraction", F.round("fraction", 6))


@query("select s_nationkey as slide, 0.8e0 as cosine, 0.6e0 as sine, 6e0 as ox, -10e0 as oy, count_if(s_suppkey % 5 > 0)::bigint as inliers from supplier group by 1 having count_if(s_suppkey % 5 > 0) >= 4 and count_if(s_suppkey % 5 = 0) <= 1")
def slide_transforms(spark, d):
    x, y = F.col("s_acctbal") / 10, ((F.col("s_suppkey") * 37) % 211).cast("double")
    off = F.when(F.col("s_suppkey") % 5 == 0, 500.0).otherwise(0.0)
    s = table(spark, d, "supplier")
    sizes = s.groupBy("s_nationkey").agg(F.count_if(F.col("s_suppkey") % 5 > 0).alias("good"), F.count_if(F.col("s_suppkey") % 5 == 0).alias("bad")).where("good >= 4 and bad <= 1")
    matches = s.join(sizes, "s_nationkey", "left_semi").select(F.col("s_nationkey").alias("slide"), x.alias("sx"), y.alias("sy"), (0.8 * x - 0.6 * y + 3 + off).alias("dx"), (0.6 * x + 0.8 * y - 5).alias("dy"))
    m = registration.full_scale(F.col("m"), F.lit(2.0))
    at = lambda i: F.round(F.get(m, F.lit(i)), 4)
    return registration.transforms(matches, "slide").select("slide", at(0).alias("cosine"), at(3).alias("sine"), at(2).alias("ox"), at(5).alias("oy"), "inliers")


@query(f"with {_PX} select x.i as x, y.i as y, round(0.75 * a.v + 0.25 * b.v, 6) as v from range(90) x(i), range(50) y(i) join px a on a.x = x.i + 2 and a.y = y.i + 1 join px b on b.x = x.i + 3 and b.y = y.i + 1".replace("from range(90) x(i), range(50) y(i) join", "from range(90) x(i) cross join range(50) y(i) join"))
def warped_plane(spark, d):
    mesh = registration.Mesh([0.0, 50.0], [0.0], np.tile([-0.25, 0.0], (1, 2, 1)))
    m = np.array([[1.0, 0, -2.0], [0, 1, -1.0], [0, 0, 1]])
    return registration.warped(_pixels(spark, d), m, mesh, 50, 90, (100, 100)).withColumn("v", F.round("v", 6))


@query(f"with {_PX} select label, round(corr(v, x * 2 + v), 6) as correlation from px join (select label, max(x) + 1 as w, max(y) + 1 as h from px group by 1) using (label) where x >= floor(w * 0.15) and x < w - floor(w * 0.15) and y >= floor(h * 0.15) and y < h - floor(h * 0.15) group by 1")
def interior_correlation(spark, d):
    px = _pixels(spark, d).select("label", "x", "y", F.col("v").alias("a"), (F.col("x") * 2 + F.col("v")).alias("b"))
    return registration.interior_correlation(px, "label").withColumn("correlation", F.round("correlation", 6))


@query("with e as (select event_type, value + case when event_type = 'click' then 1000 else 0 end as v from events), g as (select event_type, v from e where v <= 50 union all select event_type, v from e where event_type = 'click') select event_type, round(quantile_cont(v, 0.5), 6) as p50, round(quantile_cont(v, 0.9), 6) as p90, count(*) as n from g group by 1")
def feature_residuals(spark, d):
    e = table(spark, d, "events").withColumn("v", F.col("value") + F.when(F.col("event_type") == "click", 1000.0).otherwise(0.0))
    return registration.feature_residuals(e, "event_type", "v").withColumns({c: F.round(c, 6) for c in ("p50", "p90")})


@query(f"with {_PX} select label, count_if(v > 60 and x < 50)::double / count_if(v > 60) as foreground_fraction, count_if(v <= 60 and x < 50)::double / count_if(v <= 60) as background_fraction, count_if(v > 60 and x < 50)::double / count_if(x < 50) as mask_fraction from px group by 1")
def mask_shares(spark, d):
    return seg_quality.shares(_pixels(spark, d), "label", F.col("v") > 60, F.col("x") < 50)


@query("with n as (select count(distinct l_partkey) as c, count(distinct l_suppkey) as n, count(distinct case when l_suppkey < 40 then l_suppkey else 0 end) as m from lineitem) select m / (c + n - m)::double as fraction from n")
def matched_fraction(spark, d):
    px = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.when(F.col("l_suppkey") < 40, F.col("l_suppkey")).alias("matched"))
    return seg_quality.matched_fraction(px, "l_partkey", "l_suppkey", "matched")


@query("select round((stddev_pop(l_quantity) filter (l_returnflag = 'R') / (select avg(l_quantity) from lineitem) + stddev_pop(l_tax) filter (l_returnflag = 'R') / (select avg(l_tax) from lineitem)) / 2, 6) as cv from lineitem")
def channel_uniformity(spark, d):
    return seg_quality.channel_uniformity(table(spark, d, "lineitem"), ["l_quantity", "l_tax"], F.col("l_returnflag") == "R").withColumn("cv", F.round("cv", 6))


@query("select c_custkey, round(exp((((c_acctbal - 4000) / 3000) * 0.6 + ((c_nationkey - 12) / 7.0) * 0.8) * 0.5 + (((c_acctbal - 4000) / 3000) * 0.8 - ((c_nationkey - 12) / 7.0) * 0.6) * 0.3), 6) as score from customer")
def quality_score(spark, d):
    score = seg_quality.quality_score([F.col("c_acctbal"), F.col("c_nationkey")], [4000.0, 12.0], [3000.0, 7.0], [[0.6, 0.8], [0.8, -0.6]], [0.5, 0.3])
    return table(spark, d, "customer").select("c_custkey", F.round(score, 6).alias("score"))


_CELLS = (
    "c as (select p_partkey as label, p_size::double as a, p_retailprice as b, (p_size - avg(p_size) over ()) / stddev_pop(p_size) over () as a_z, (p_retailprice - avg(p_retailprice) over ()) / stddev_pop(p_retailprice) over () as b_z from part), "
    "l as (select k, case when k = 1 then 0 else label % k end as cluster, c.* from c, range(1, 11) r(k)), "
    "t as (select k::integer as k, cluster::integer as cluster, count(*) as n, case when count(*) = 1 then 0 else (stddev_pop(a) / avg(a) + stddev_pop(b) / avg(b)) / 2 end as cv, var_pop(a_z) as p, var_pop(b_z) as q, covar_pop(a_z, b_z) as r from l group by 1, 2), "
    "u as (select k, cluster, n, cv, case when n = 1 then 1 else ((p + q) / 2 + sqrt((p - q) * (p - q) / 4 + r * r)) / (p + q) end as fraction from t)"
)


def _clustered(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("label"), F.col("p_size").cast("double").alias("a"), F.col("p_retailprice").alias("b"))
    s = p.agg(*[f(c).alias(f"{c}_{n}") for c in "ab" for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    return p.join(s).select("label", "a", "b", *[((F.col(c) - F.col(f"{c}_m")) / F.col(f"{c}_s")).alias(f"{c}_z") for c in "ab"], F.lit(0).alias("k1"), *[(F.col("label") % k).cast("int").alias(f"k{k}") for k in range(2, 11)])


@query(f"with {_CELLS} select k, cluster, n, round(cv, 6) as cv, round(fraction, 6) as fraction from u")
def cluster_terms(spark, d):
    return seg_quality.cluster_terms(_clustered(spark, d), ["a", "b"]).withColumns({c: F.round(c, 6) for c in ("cv", "fraction")})


@query(f"with {_CELLS}, x as (select l.k, l.label, m.cluster as other, l.cluster, avg(sqrt((l.a_z - m.a_z) ** 2 + (l.b_z - m.b_z) ** 2)) * count(*) as total, count(*) as size from l join l m using (k) group by 1, 2, 3, 4), s as (select k, label, max(case when other = cluster then total / nullif(size - 1, 0) end) as near, min(case when other <> cluster then total / size end) as far from x group by 1, 2), w as (select k, avg(case when k = 1 then 1 when near is null then 0 else (far - near) / greatest(near, far) end) as silhouette from s group by 1), v as (select k, sum(cv * n) / sum(n) as cv, sum(fraction * n) / sum(n) as fraction from u group by 1) select v.k, round(cv, 6) as cv, round(fraction, 6) as fraction, round(silhouette, 6) as silhouette from v join w using (k)")
def cell_uniformity(spark, d):
    return seg_quality.uniformity(_clustered(spark, d), ["a", "b"]).withColumns({c: F.round(c, 6) for c in ("cv", "fraction", "silhouette")})


@query(None)
def segmentation_row(spark, d):
    """Tests hold it against a plain version, but for the clusters that k-means finds."""
    k = F.col("event_id")
    px = table(spark, d, "events").select(
        (k % 100).alias("x"), F.floor(k / 100).alias("y"), F.when(k % 100 % 6 < 5, F.floor((k % 100) / 6) * 1000 + F.floor(k / 600) + 1).otherwise(0).alias("cell"), F.when((k % 6).isin(2, 3) & (F.floor(k / 100) % 6).isin(2, 3), F.floor((k % 100) / 6) * 1000 + F.floor(k / 600) + 1).otherwise(0).alias("nucleus"),
        (~((k % 100 % 6).isin(0, 4) | (F.floor(k / 100) % 6).isin(0, 5))).alias("interior"), (F.col("value") > 20).alias("foreground"), F.col("value").alias("a"), F.col("user_id").cast("double").alias("b"),
    )
    out = seg_quality.evaluation(px, ["a", "b"], 0.25)
    return out.select(*[F.round(c, 6).alias(c) for c in seg_quality.MEASURES])
