"""The engine's queries over the driver tables, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import measure, merge, pairing, raster
from ..sources import sheets
from ..sources.tables import table
from ..streaming.groups import groups_and_rest, sized_groups
from . import assembled, joins, kernels, laterals, reports, slides, spatial, tiled  # noqa: F401  (they enter theirs)
from .registry import ALL, query

__all__ = ["ALL"]

_PARTS = "".join(f", avg({v}) as {n}_mean, median({v}) as {n}_median, coalesce(sum({v}), 0.0) as {n}_sum" for n, v in (("cell", "l_quantity"), ("nucleus", "case when l_returnflag = 'R' then l_quantity end"), ("cytoplasm", "case when l_returnflag <> 'R' then l_quantity end")))


@query(f"select l_orderkey as label{_PARTS} from lineitem where l_orderkey is not null group by 1")
def compartment_intensity(spark, d):
    return measure.compartments(table(spark, d, "lineitem"), "l_orderkey", "l_quantity", F.col("l_returnflag") == "R")


@query("with n as (select l_partkey, l_suppkey, count(*) as n from lineitem group by 1, 2) select l_partkey, arg_max(l_suppkey, {'n': n, 's': -l_suppkey}) as l_suppkey, max(n) as n from n group by 1")
def overlap_argmax(spark, d):
    return pairing.overlap_argmax(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query("with s as (select c_mktsegment, avg(c_acctbal) as m, stddev_samp(c_acctbal) as sample, stddev_pop(c_acctbal) as sd from customer group by 1) select c_custkey, round(case when c_acctbal is null then null when coalesce(sample, 0) = 0 then 0.0 else (c_acctbal - m) / sd end, 6) as z from customer left join s using (c_mktsegment)")
def zscore(spark, d):
    return measure.zscore(table(spark, d, "customer"), "c_mktsegment", "c_acctbal").select("c_custkey", F.round("z", 6).alias("z"))


@query("select o_custkey, l_partkey, o_orderdate, o_orderkey, l_linenumber from (select o_custkey, l_partkey, o_orderdate, o_orderkey, l_linenumber, row_number() over (partition by o_custkey, l_partkey order by o_orderdate, o_orderkey, l_linenumber) as r from orders join lineitem on o_orderkey = l_orderkey) where r = 1")
def first_claim(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return merge.first_claim(rows.select("o_custkey", "l_partkey", "o_orderdate", "o_orderkey", "l_linenumber"), ["o_custkey", "l_partkey"], ["o_orderdate", "o_orderkey", "l_linenumber"])


@query("select event_type, count(*) as n, cast(count_if(value > 100) as bigint) as n_large, round(sum(value), 4) as total, round(max(value), 6) as peak from events group by 1")
def process_rollup(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 100).alias("n_large"), F.round(F.sum("value"), 4).alias("total"), F.round(F.max("value"), 6).alias("peak"))


@query("select event_type, min(value) as p90 from (select event_type, value, row_number() over (partition by event_type order by value) as r, count(*) over (partition by event_type) as n from events where value is not null) where r >= ceil(n * 90 / 100.0) group by 1")
def nearest_rank_p90(spark, d):
    return measure.nearest_rank(table(spark, d, "events"), "event_type", "value", 90)


_POINTS = "with a as (select c_custkey as a, c_acctbal as x, cast(c_nationkey * 10 as double) as y from customer), b as (select s_suppkey as b, s_acctbal as x, cast(s_nationkey * 10 as double) as y from supplier), p as (select a, b, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) as d2 from a, b where (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 625), na as (select a, arg_min(b, {'d': d2, 'b': b}) as b, min(d2) as d2 from p group by 1), nb as (select b, arg_min(a, {'d': d2, 'a': a}) as a from p group by 1) "


def _points(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), (F.col("c_nationkey") * 10).cast("double").alias("y"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("x"), (F.col("s_nationkey") * 10).cast("double").alias("y"))
    return a, b, 25.0


@query(_POINTS + "select a, b, round(d2, 4) as d2 from na join nb using (a, b)")
def mutual_nn(spark, d):
    return pairing.mutual_nearest(*_points(spark, d)).withColumn("d2", F.round("d2", 4))


@query(_POINTS + "select b, max(round(d2, 4)) as worst, count(*) as n from na group by 1")
def nearest_max_residual(spark, d):
    return pairing.nearest_within(*_points(spark, d)).groupBy("b").agg(F.max(F.round("d2", 4)).alias("worst"), F.count("*").alias("n"))


@query("select conv_id, array_to_string((list_sort(list(turn)))[1:3], ',') as items from conversations group by 1 having count(turn) >= 3")
def sized_group(spark, d):
    return sized_groups(table(spark, d, "conversations"), "conv_id", "turn", 3)


@query("select conv_id, array_to_string((list_sort(list(turn)))[1:4], ',') as items, count(turn) >= 4 as complete from conversations group by 1")
def flushed_groups(spark, d):
    return groups_and_rest(table(spark, d, "conversations"), "conv_id", "turn", 4)


@query("select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 200000)")
def orphan_anti_join(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 200000")
    return table(spark, d, "customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query("select o_custkey, array_to_string(list_sort(list(distinct o_orderpriority)), '|') as channels from orders group by 1")
def distinct_channels(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_set("o_orderpriority")), "|").alias("channels"))


@query("with f1 as (select o_custkey as k, max(o_totalprice) as top, count(*) as n from orders where o_orderstatus = 'O' group by 1), f2 as (select o_custkey as k, count(*) as n from orders where o_orderstatus = 'F' group by 1) select c_custkey as k, c_acctbal as area, top, f2.n as n from customer left join f1 on f1.k = c_custkey left join f2 on f2.k = c_custkey")
def merge_last_wins(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("area"))
    one = o.where("o_orderstatus = 'O'").groupBy("k").agg(F.max("o_totalprice").alias("top"), F.count("*").alias("n"), F.min("o_totalprice").alias("area"))
    two = o.where("o_orderstatus = 'F'").groupBy("k").agg(F.count("*").alias("n"))
    return merge.merge_last_wins(base, [one, two], "k", protected=("area",)).select("k", "area", "top", "n")


@query("select o_orderkey, o_totalprice * 2 as price from orders where o_orderkey % 2 = 0 union all select o_orderkey, o_totalprice from orders where o_orderkey % 3 = 0 and o_orderkey % 2 <> 0")
def upsert_cycle(spark, d):
    o = table(spark, d, "orders")
    new = o.where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("price"))
    return merge.upsert(o.where("o_orderkey % 3 = 0").select("o_orderkey", F.col("o_totalprice").alias("price")), new, "o_orderkey")


@query("select doc_id, coalesce(quality = 1, false) as positive, case when quality is null then 'unclassified' else 'classified' end as phenotype from documents left join labels using (doc_id)")
def positivity(spark, d):
    sign = F.when(F.col("quality") == 1, " + ").when(F.col("quality") == 0, "-")
    return merge.positivity(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", sign)


@query("select c_custkey as id, c_acctbal as acctbal, c_mktsegment as segment, cast(null as integer) as nation from customer union all select s_suppkey, s_acctbal, null, s_nationkey from supplier")
def cohort_outer_union(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nation"))
    return merge.outer_union(a, b)


@query("select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events")
def json_flatten(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("with e as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem) select cast(least(floor((l_extendedprice - lo) * 50 / (hi - lo)), 49) as bigint) as bin, count(*) as n from lineitem, e group by 1")
def histogram(spark, d):
    return measure.histogram(table(spark, d, "lineitem"), "l_extendedprice", 50)


@query("select l_suppkey, round(quantile_cont(l_extendedprice, 0.25), 6) as q25, round(quantile_cont(l_extendedprice, 0.5), 6) as q50, round(quantile_cont(l_extendedprice, 0.95), 6) as q95 from lineitem group by 1")
def interp_percentiles(spark, d):
    return measure.interpolated(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q95": 0.95})


@query(
    "with t as (select distinct p_size as process, p_brand || '_' || p_type as tag from part union select distinct p_size, p_brand from part), s as (select p_size as process, p_brand || case when p_partkey % 2 = 0 then '' else '_' || p_type end as name, min(p_partkey) as place, cast(count(*) as bigint) as size from part where p_brand <= 'Brand#3' group by 1, 2) "
    "select process, tag, arg_min(size, {'o': name <> tag, 'p': place}) as size from t left join s using (process) where name is null or tag = name or starts_with(tag, name || '_') group by 1, 2 "
    "union all select process, tag, null from t where exists (select 1 from s where s.process = t.process) and not exists (select 1 from s where s.process = t.process and (tag = name or starts_with(tag, name || '_')))"
)
def size_prefix_join(spark, d):
    p = table(spark, d, "part").withColumnRenamed("p_size", "process")
    tags = p.select("process", F.concat_ws("_", "p_brand", "p_type").alias("tag")).union(p.select("process", "p_brand")).distinct()
    name = F.concat("p_brand", F.when(F.col("p_partkey") % 2 == 0, "").otherwise(F.concat(F.lit("_"), "p_type")))
    sizes = p.where("p_brand <= 'Brand#3'").groupBy("process", name.alias("name")).agg(F.min("p_partkey").alias("place"), F.count("*").alias("size"))
    return merge.prefix_join(tags, sizes, "process", "tag", "name", "size", "place").select("process", "tag", "size")


@query("select conv_id, min(turn) as turn, arg_min(role, turn) as role from conversations group by 1")
def keep_first_dedup(spark, d):
    return merge.first_claim(table(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"])


@query("select sig, count(*) as n, min(l_orderkey) as first_order from (select l_orderkey, array_to_string(list_sort(list(distinct l_partkey)), '|') as sig from lineitem group by 1) group by 1")
def signature_match(spark, d):
    sig = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_set("l_partkey")), "|").alias("sig"))
    return sig.groupBy("sig").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first_order"))


@query(
    "with s as (select page_id, cast(page_id % 7 as varchar) as patient_id, split_part(regexp_extract(url, '([^/]*)$', 1), '.', 1) as stem from pages) select page_id, (case when starts_with(stem, patient_id) then stem else patient_id || '_' || stem end) || case when count(*) over (partition by patient_id, stem) > 1 then printf('_%03d', row_number() over (partition by patient_id order by page_id) - 1) else '' end as identity from s"
)
def identity_ids(spark, d):
    rows = table(spark, d, "pages").select("page_id", (F.col("page_id") % 7).cast("string").alias("patient_id"), "url")
    return sheets.identities(rows, "url", "page_id").select("page_id", F.col("id").alias("identity"))


@query("with g as (select p_brand, p_retailprice, case when p_retailprice - lag(p_retailprice) over (partition by p_brand order by p_retailprice) > 0.002 * abs(lag(p_retailprice) over (partition by p_brand order by p_retailprice)) then 1 else 0 end as s from part), r as (select p_brand, p_retailprice, sum(s) over (partition by p_brand order by p_retailprice range unbounded preceding) as island from g) select p_brand, cast(island as bigint) as island, count(*) as n, min(p_retailprice) as lo, max(p_retailprice) as hi from r group by 1, 2")
def gaps_islands(spark, d):
    return merge.islands(table(spark, d, "part"), "p_brand", "p_retailprice", 0.002)


@query("with s as (select o_orderstatus, count(*) as n, round(avg(o_totalprice), 6) as mean, round(median(o_totalprice), 6) as p50 from orders group by 1), a as (select mean as m, p50 as p from s where o_orderstatus = 'F') select o_orderstatus, n, mean, p50, round(mean - m, 4) as delta_mean, round(p50 - p, 4) as delta_p50 from s left join a on true")
def stage_delta(spark, d):
    return measure.stage_delta(table(spark, d, "orders"), "o_orderstatus", "o_totalprice", "F")


@query("select event_id % 100 // 4 as bx, event_id // 100 // 4 as by, round(avg(value), 6) as mean, count(*) as n from events group by 1, 2")
def block_mean(spark, d):
    px = table(spark, d, "events").select((F.col("event_id") % 100).alias("x"), F.floor(F.col("event_id") / 100).alias("y"), F.col("value").alias("v"))
    return raster.block_mean(px, 4)


@query("select vec_id, round((0.9 * x + -0.1 * y) + 3.0, 6) as u, round((0.1 * x + 1.1 * y) + -2.0, 6) as v from (select vec_id, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y from embeddings)")
def affine_points(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    out = raster.affine(e, [[0.9, -0.1, 3.0], [0.1, 1.1, -2.0]])
    return out.select("vec_id", F.round("u", 6).alias("u"), F.round("v", 6).alias("v"))


@query("select vec_id, round(abs(x0*y1 - x1*y0 + x1*y2 - x2*y1 + x2*y0 - x0*y2) / 2, 6) as area from (select vec_id, cast(embedding[1] as double) x0, cast(embedding[2] as double) y0, cast(embedding[3] as double) x1, cast(embedding[4] as double) y1, cast(embedding[5] as double) x2, cast(embedding[6] as double) y2 from embeddings)")
def shoelace_area(spark, d):
    ring = F.transform(F.slice("embedding", 1, 6), lambda v: v.cast("double"))
    return raster.ring_area(table(spark, d, "embeddings").select("vec_id", ring.alias("ring")), "ring").select("vec_id", F.round("area", 6).alias("area"))
