"""Queries on tables put together."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble
from ..sources.tables import table
from .registry import query


@query("select count_if(o_orderstatus = 'F')::bigint as reference, count_if(o_orderstatus <> 'F' or o_orderstatus is null)::bigint as moving from orders")
def branched_slides(spark, d):
    ref, moving = assemble.branched(table(spark, d, "orders"), F.col("o_orderstatus") == "F")
    return ref.agg(F.count("*").alias("reference")).join(moving.agg(F.count("*").alias("moving")))


@query("select event_id, event_type as kind from events where event_type = 'click'")
def artifacts_of_kind(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("event_type").alias("kind"))
    return assemble.of_kind(rows, "click", ["click", "view"])


@query("""select o_custkey, max(o_totalprice) filter (o_orderstatus = 'F') as "m::F", max(o_totalprice) filter (o_orderstatus = 'O') as "m::O" from orders where o_orderstatus in ('F', 'O') group by 1""")
def metrics_side_by_side(spark, d):
    rows = table(spark, d, "orders").where("o_orderstatus in ('F', 'O')").groupBy("o_custkey", F.concat(F.lit("m::"), "o_orderstatus").alias("name")).agg(F.max("o_totalprice").alias("value"), F.min("o_orderstatus").alias("place"))
    return assemble.metrics_table(rows, "o_custkey")


@query("select s_suppkey, 'm1' as moving, printf('%.4f', s_acctbal) as ref_x, printf('%.4f', s_suppkey / 8.0) as ref_y, printf('%.6f', s_nationkey * 1.0) as residual_px, 'rigid' as stage from supplier")
def residual_rows(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("ref_x"), (F.col("s_suppkey") / 8).alias("ref_y"), F.col("s_nationkey").cast("double").alias("residual_px"), F.lit("rigid").alias("stage"))
    rows = assemble.per_cell_rows(s.withColumn("stage", F.struct("stage", "s_suppkey")), "m1")
    return rows.select("stage.s_suppkey", "moving", "ref_x", "ref_y", "residual_px", "stage.stage")


@query("select p_partkey as label, case when p_size % 3 = 0 then 3 else 4 end as points from part where p_size % 3 < 2 and p_partkey in (select l_partkey from lineitem)")
def label_polygons(spark, d):
    at = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    ring = F.when(F.col("p_size") % 3 == 0, F.array(at(0, 0), at(1, 0), at(1, 1))).when(F.col("p_size") % 3 == 1, F.array(at(0, 0), at(1, 0), at(1, 1), at(0, 0.5))).otherwise(F.array(at(0, 0), at(0, 0), at(1, 1)))
    contours = table(spark, d, "part").select(F.col("p_partkey").alias("label"), ring.alias("ring"))
    return assemble.polygon_rows(contours, table(spark, d, "lineitem").select(F.col("l_partkey").alias("label"))).select("label", F.size("ring").alias("points"))


@query("select p_partkey, 0.5::double as pixel_size, case when p_size = 50 then null when abs(0.5 - p_size / 100.0) > 0.1 * p_size / 100.0 then 'not what was detected' end as problem from part")
def preflight_sizes(spark, d):
    slides = table(spark, d, "part").select(F.col("p_partkey").alias("path"), (F.col("p_size") / 100).alias("detected"))
    return assemble.preflight(slides, "0.5", 0.1).withColumnRenamed("path", "p_partkey")


_STAGED = "b as (select p_partkey as k, p_partkey % 3 as s from part where p_partkey % 10 <> 0), e as (select stage, k, off + s as d, ((greatest(5 - off - s, 0) * 2 + 1) * 10)::double as common from b, (values ('native', 3), ('rigid', 1)) t(stage, off)), o as (select stage, k, d, common / (220 - common) as iou from e)"


def _staged(spark, d):
    """Boxes of 5 pixels, the same moved by 3 to 5 (a tenth isn't there), and stages: as they are, and moved back by 2."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    ring = lambda dx: F.array(*[F.struct((k * 50 + dx + a).cast("double").alias("x"), (F.col("p_size") * 10 + b).cast("double").alias("y")) for a, b in ((0, 0), (5, 0), (5, 5), (0, 5))])
    of = lambda rows, dx: rows.select(k.alias("feature"), F.lit(False).alias("hole"), ring(dx).alias("ring"))
    stages = spark.createDataFrame([("native", [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]), ("rigid", [1.0, 0.0, -2.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0])], "stage string, m array<double>")
    return assemble.paired_stages(of(p, F.lit(0)), of(p.where(k % 10 != 0), 3 + k % 3), stages, "rigid")


@query("select 'rigid' as stage, round(1.5e0 * sqrt(25 / pi()), 6) as radius, (select count(*) from part where p_partkey % 10 <> 0) as n_pairs, 0::bigint as n_inexact, count(*) as n_ref, count_if(p_partkey % 10 <> 0)::bigint as n_moving, count_if(p_partkey % 10 = 0)::bigint as unmatched_ref, 0::bigint as unmatched_moving, 1e0 as pair_fraction from part")
def stage_matching(spark, d):
    return _staged(spark, d)[0].withColumn("radius", F.round("radius", 6))


@query(f"with {_STAGED} select stage, k as a, k as b, d::double as distance from o")
def stage_residuals(spark, d):
    return _staged(spark, d)[1].withColumn("distance", F.round("distance", 6))


@query(f"with {_STAGED}, s as (select stage, count(*) as n, count(iou) as n_scored, avg(iou) as iou_mean, avg((iou >= 0.5)::integer) as share_good, median(d)::double as d_p50 from o group by 1) select s.stage, s.n, s.n_scored, round(s.iou_mean, 6) as iou_mean, round(s.share_good, 6) as share_good, s.d_p50, round(s.iou_mean - r.iou_mean, 6) as delta, s.d_p50 - r.d_p50 as delta_d from s, s r where r.stage = 'rigid'")
def stage_scores(spark, d):
    out = _staged(spark, d)[2]()
    return out.select("stage", "n", "n_scored", F.round("iou_mean", 6).alias("iou_mean"), F.round("share_good", 6).alias("share_good"), F.round("d_p50", 6).alias("d_p50"), F.round("delta_iou", 6).alias("delta"), F.round("delta_d_p50", 6).alias("delta_d"))
