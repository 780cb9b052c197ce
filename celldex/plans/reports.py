"""Queries for summaries, validation and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import export, manifest, quality_control
from ..sources.tables import table
from .registry import query


@query(
    "with p as (select l_returnflag as stage, l_discount * 10 as iou, l_quantity as d, l_partkey as a, l_suppkey as b from lineitem) select stage, count(*) as n, count(iou) as n_scored, round(avg(iou), 6) as iou_mean, round(avg(case when iou >= 0.5 then 1.0 else 0.0 end), 6) as share_good, round(sum(2 * iou / (1 + iou) * (a + b)) / sum(a + b), 6) as dice, round(avg(d), 6) as d_mean, max(d) as d_max, quantile_cont(d, 0.1) as d_p10, quantile_cont(d, 0.5) as d_p50, quantile_cont(d, 0.9) as d_p90 from p group by 1"
)
def stage_summary(spark, d):
    pairs = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("stage"), (F.col("l_discount") * 10).alias("iou"), F.col("l_quantity").alias("d"), F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    return quality_control.stage_summary(pairs, "stage", "iou", "d", "a", "b").withColumns({c: F.round(c, 6) for c in ("iou_mean", "share_good", "dice", "d_mean")})


@query("select l_linenumber, cast(count_if(l_tax < 0.04) as bigint) as n_accepted, cast(count_if(not (l_tax < 0.04)) as bigint) as n_rejected, round(avg(l_quantity) filter (l_tax < 0.04), 6) as mean, quantile_cont(l_quantity, 0.5) filter (l_tax < 0.04) as p50, quantile_cont(l_quantity, 0.9) filter (l_tax < 0.04) as p90, max(l_quantity) filter (l_tax < 0.04) as worst from lineitem group by 1")
def tile_report(spark, d):
    return quality_control.tile_report(table(spark, d, "lineitem"), "l_linenumber", F.col("l_tax") < 0.04, "l_quantity").withColumn("mean", F.round("mean", 6))


@query("select l_suppkey, count_if(l_tax < 0.04)::bigint as n_accepted, count_if(not l_tax < 0.04)::bigint as n_rejected, coalesce(bool_or(l_tax < 0.04 and l_discount = 0.1 and l_quantity > 30), false) as mesh_refined, quantile_cont(l_quantity, 0.9) filter (l_tax < 0.04) as p90 from lineitem group by 1")
def mesh_report(spark, d):
    moved = (F.col("l_discount") == 0.1) & (F.col("l_quantity") > 30)
    return quality_control.tile_report(table(spark, d, "lineitem"), "l_suppkey", F.col("l_tax") < 0.04, "l_quantity", moved).select("l_suppkey", "n_accepted", "n_rejected", "mesh_refined", "p90")


@query("with s as (select o_custkey as slide, array_to_string(list_sort([lower(x) for x in list(distinct o_orderpriority)]), '|') as sig from orders group by 1), u as (select sig, min(slide) as slide from s group by 1 having count(*) = 1) select 's' || slide as slide, 'f' || slide as file from u")
def paired_by_signature(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("channels"))
    one = s.groupBy(manifest.signature(F.col("channels")).alias("sig")).agg(F.count("*").alias("n"), F.min("o_custkey").alias("o_custkey")).where("n = 1").select("o_custkey")
    some = s.join(one, "o_custkey")
    named = lambda p: some.select(F.concat(F.lit(p), "o_custkey").alias("name"), "channels")
    return manifest.pair_by_signature(named("s"), named("f"))


@query("with h as (select l_returnflag as g, cast(l_quantity as bigint) as bin, count(*) as n from lineitem group by 1, 2), w as (select g, bin, sum(n) over (partition by g order by bin) as low, sum(n * bin) over (partition by g order by bin) as ls, sum(n) over (partition by g) as al, sum(n * bin) over (partition by g) as s from h), v as (select g, bin, (al - low)::double / al::double as share, round(coalesce(low::double * (al - low)::double * power(ls::double / low::double - (s - ls)::double / nullif(al - low, 0)::double, 2), 0), 3) as score from w) select g as l_returnflag, arg_max(bin, {'s': score, 'm': -bin}) as cut, round(arg_max(share, {'s': score, 'm': -bin}), 6) as share from v group by 1")
def otsu_cut(spark, d):
    return quality_control.otsu(table(spark, d, "lineitem"), "l_returnflag", "l_quantity", 64).withColumn("share", F.round("share", 6))


@query("with c as (select l_suppkey, count(*) as n, case when stddev_pop(l_quantity) = 0 then 0 else stddev_pop(l_quantity) / avg(l_quantity) end as a, case when stddev_pop(l_extendedprice) = 0 then 0 else stddev_pop(l_extendedprice) / avg(l_extendedprice) end as b from lineitem group by 1) select round(sum(n * (a + b) / 2) / sum(n), 6) as cv, count(*) as clusters from c")
def cluster_uniformity(spark, d):
    return quality_control.uniformity(table(spark, d, "lineitem"), "l_suppkey", ["l_quantity", "l_extendedprice"]).withColumn("cv", F.round("cv", 6))


@query("select event_type, count(*) as n, cast(count_if(user_id % 3 <> 0) as bigint) as failed, round(sum(value / 60 * 2), 4) as gb_h, round(sum(case when user_id % 3 <> 0 then value / 60 * 2 else 0 end), 4) as lost_gb_h from events group by 1")
def failure_cost(spark, d):
    out = quality_control.failures(table(spark, d, "events"), "event_type", (F.col("user_id") % 3).cast("string"), F.col("value") / 60, F.lit(2))
    return out.withColumns({c: F.round(c, 4) for c in ("gb_h", "lost_gb_h")})


@query("with t as (select l_suppkey from lineitem group by 1 order by round(sum(l_extendedprice), 4) desc, 1 limit 8) select * from (select l_suppkey, l_orderkey, l_linenumber, l_extendedprice, row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey * 8 + l_linenumber) as rank from lineitem where l_suppkey in (from t)) where rank <= 20")
def top_groups(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("place"))
    return quality_control.top_groups(rows, "l_suppkey", "l_extendedprice", 8, 20, "place").drop("place")


@query("with r as (select case when l_orderkey % 5 = 0 then 0 else l_orderkey end as l_orderkey, l_linenumber from lineitem) select l_orderkey, l_linenumber, dense_rank() over (order by l_orderkey) - cast(exists (select 1 from r where l_orderkey = 0) as integer) as label from r")
def dense_labels(spark, d):
    rows = table(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 5 == 0, 0).otherwise(F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber")
    return manifest.dense_labels(rows, "l_orderkey")


@query("select (select count(*) from (select c_custkey from customer except select o_custkey from orders)) as missing, (select count(*) from (select o_custkey from orders except select c_custkey from customer)) as extra, (select count(*) from (select c_custkey from customer intersect select o_custkey from orders)) as both")
def label_agreement(spark, d):
    return manifest.agreement(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders"), "o_custkey")


@query("select o_custkey, o_orderkey, cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as bigint) as row_index, o_orderstatus = 'F' and sum(case when o_orderstatus = 'F' then 1 else 0 end) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) = 1 as is_reference from orders")
def reference_rows(spark, d):
    return manifest.reference_rows(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F").select("o_custkey", "o_orderkey", "row_index", "is_reference")


@query("with s as (select c_custkey, case when c_acctbal < 0 then 'negative balance' end as e1, case when c_mktsegment is null or trim(c_mktsegment) = '' then 'blank segment' end as e2, case when c_nationkey > 20 then 'unknown nation' end as e3 from customer) select c_custkey, unnest(list_filter([e1, e2, e3], lambda x: x is not null)) as problem from s")
def validation(spark, d):
    rules = {"negative balance": F.col("c_acctbal") < 0, "blank segment": F.coalesce(F.trim("c_mktsegment") == "", F.lit(True)), "unknown nation": F.col("c_nationkey") > 20}
    return manifest.problems(table(spark, d, "customer"), ["c_custkey"], rules)


@query("select part.p_partkey, cast(round(part.p_size * 1.5 * 1024) as varchar) as a, case when p_partkey % 3 = 0 then p_size else p_size * 60e0 + 30 end as seconds, p_size / 2e0 as percent from part")
def parsed_trace(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat(F.col("p_size") * 1.5, F.lit(" KB")).alias("mem"), F.concat(F.col("p_size"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise("m 30s")).alias("time"), F.concat(F.col("p_size") / 2, F.lit(" %")).alias("cpu"))
    return p.select("p_partkey", F.round(scalars.parse_bytes(F.col("mem"))).cast("long").cast("string").alias("a"), scalars.parse_duration(F.col("time")).alias("seconds"), scalars.parse_percent(F.col("cpu")).alias("percent"))


@query("with w as (select c_mktsegment as marker, c_nationkey as label, sum(c_acctbal) as v from customer group by 1, 2) select label, round(sum(v) filter (marker = 'AUTOMOBILE'), 4) as automobile, round(sum(v) filter (marker = 'FURNITURE'), 4) as furniture from w group by 1")
def wide_markers(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("label"), F.col("c_mktsegment").alias("marker"), F.col("c_acctbal").alias("value"))
    out = export.wide(c, "label", "marker", "value", ["AUTOMOBILE", "FURNITURE"])
    return out.select("label", F.round("AUTOMOBILE", 4).alias("automobile"), F.round("FURNITURE", 4).alias("furniture"))


_NAMED = "'{\"name\":\"%s\",\"value\":' || cast(%s as varchar) || '}'"
_MEASURED = " || ',' || ".join(_NAMED % (n, v) for n, v in (("label", "c_custkey::double"), ("Centroid X µm", "round_even((c_acctbal + 0.5) * 0.5e0, 3)"), ("Centroid Y µm", "round_even((c_nationkey * 10e0 + 0.5) * 0.5e0, 3)"), ("CD3", "round_even(c_acctbal, 4)")))


@query(f"""select c_custkey as label, '{{"type":"Feature","id":"' || c_custkey || '","geometry":{{"type":"Point","coordinates":[' || cast(c_acctbal as varchar) || ',' || cast(c_nationkey * 10e0 as varchar) || ']}},"properties":{{"objectType":"detection","measurements":[' || {_MEASURED} || ']}}}}' as feature from customer""")
def geojson_features(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("label"), F.col("c_acctbal").alias("cx"), (F.col("c_nationkey") * 10.0).alias("cy"), F.col("c_acctbal").alias("CD3"), F.lit(None).cast("double").alias("CD8"))
    return export.features(c, "label", "cx", "cy", ["CD3", "CD8"], 0.5)


_SHAPED = ", ".join(f"{{'name': '{n}', 'value': {v}}}" for n, v in (("label", "p_partkey::double"), ("Centroid X µm", "round_even((p_size + 0.5) * 0.5e0, 3)"), ("Centroid Y µm", "round_even((p_size * 2 + 0.5) * 0.5e0, 3)"), ("CD3", "round_even(p_retailprice, 4)"), ("Area µm²", "round_even(p_size * 0.25e0, 3)"), ("Eccentricity", "0.5e0"), ("Perimeter µm", "case when p_partkey % 3 > 0 then p_size * 0.5e0 end"), ("Solidity", "0.75e0"), ("Convex Area µm²", "p_size * 0.5e0"), ("Major Axis Length µm", "p_size * 0.25e0"), ("Minor Axis Length µm", "p_size * 0.125e0")))


@query(f"with m as (select p_partkey, unnest([{_SHAPED}]) as m from part) select p_partkey, m.name as name, m.value as value from m where m.value is not null")
def cell_measurements(spark, d):
    n = F.col("p_size")
    c = table(spark, d, "part").select(
        "p_partkey", n.alias("x"), (n * 2).alias("y"), F.col("p_retailprice").alias("CD3"), n.alias("area"), F.lit(0.5).alias("eccentricity"), F.when(F.col("p_partkey") % 3 > 0, n.cast("double")).otherwise(float("nan")).alias("perimeter"),
        F.lit(0.75).alias("solidity"), (n * 2).alias("convex_area"), (n * 0.5).alias("axis_major_length"), (n * 0.25).alias("axis_minor_length"),
    )
    m = export.measurements(F.col("p_partkey"), F.col("x"), F.col("y"), ["CD3"], 0.5, ["area", *export.SHAPES])
    return c.select("p_partkey", F.inline(m))
