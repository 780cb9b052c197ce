"""Queries on joins, merged tables and resources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching, measure, merge, pairing, resources
from ..sources.tables import table
from .registry import query


@query("select c_custkey as label, c_name, arg_max(o_totalprice, o_orderkey) as price from customer left join orders on o_custkey = c_custkey group by 1, 2")
def attach_last(spark, d):
    right = table(spark, d, "orders").select(F.col("o_custkey").alias("label"), F.col("o_totalprice").alias("price"), "o_orderkey")
    return merge.attach(table(spark, d, "customer").select(F.col("c_custkey").alias("label"), "c_name"), right, "label", "o_orderkey", last=True)


@query("select c_custkey as label, c_name, arg_min(o_totalprice, o_orderkey) as price from customer left join orders on o_custkey = c_custkey group by 1, 2")
def attach_first(spark, d):
    right = table(spark, d, "orders").select(F.col("o_custkey").alias("label"), F.col("o_totalprice").alias("price"), "o_orderkey")
    return merge.attach_all_or_fail(table(spark, d, "customer").select(F.col("c_custkey").alias("label"), "c_name"), right, "label", "o_orderkey")


_A = "a as (select c_custkey as a, c_acctbal / 0.5 as x, c_nationkey * 10 / 0.5 as y from customer), b as (select s_suppkey as b, s_acctbal / 0.5 as x, s_nationkey * 10 / 0.5 as y from supplier), p as (select a, b, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) as d2 from a, b where (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 1600), na as (select a, arg_min(b, {'d': d2, 'b': b}) as b, min(d2) as d2 from p group by 1), nb as (select b, arg_min(a, {'d': d2, 'a': a}) as a from p group by 1)"


def _cells(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), (F.col("c_nationkey") * 10).cast("double").alias("y"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_acctbal") / 0.5).alias("x"), (F.col("s_nationkey") * 10 / 0.5).alias("y"))
    return a, b


@query(f"with {_A}, j as (select b, a from na join nb using (a, b)) select b.b, j.a, 'centroid' as method, (select count(*) from j) as matched, (select count(*) from b) as cells, (select count(*) from j) / (select count(*)::double from b) as match_fraction from b left join j using (b)")
def centroid_join(spark, d):
    return pairing.resolve_join(*_cells(spark, d), pixel=0.5, radius=40.0, least=0.0)


_LABELS = "f as (select o_orderkey as id, case when o_orderkey % 7 > 0 then o_custkey end as label, case when o_orderkey % 5 = 0 then ' ' else o_orderpriority end as phenotype, o_orderstatus = 'F' as outlier, case when o_orderkey % 3 = 0 then '+' when o_orderkey % 3 = 1 then '-' end as \"CD3_sign\", case when o_orderkey % 2 = 0 then ' + ' end as \"CD8_sign\" from orders), l as (select label as b, max(id) as a from f where label is not null group by 1), j as (select c_custkey as b, a from customer left join l on b = c_custkey)"


def _labelled(spark, d):
    k = F.col("o_orderkey")
    flow = table(spark, d, "orders").select(
        k.alias("id"), F.when(k % 7 > 0, F.col("o_custkey")).alias("label"), F.when(k % 5 == 0, " ").otherwise(F.col("o_orderpriority")).alias("phenotype"), (F.col("o_orderstatus") == "F").alias("outlier"),
        F.when(k % 3 == 0, "+").when(k % 3 == 1, "-").alias("CD3_sign"), F.when(k % 2 == 0, " + ").alias("CD8_sign"),
    )
    cells = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return flow, pairing.resolve_join(flow, cells, 0.5, 40.0, 0.1)


@query(f"with {_LABELS} select b, a, 'label' as method, (select count(a) from j) as matched, (select count(*) from j) as cells, (select count(a) / count(*)::double from j) as match_fraction from j")
def label_join(spark, d):
    return _labelled(spark, d)[1]


@query(f"""with {_LABELS} select b, a, coalesce(case when trim(phenotype) <> '' then phenotype end, 'unclassified') as phenotype, coalesce(outlier, false) as outlier, array_to_string(list_filter([case when trim("CD3_sign") = '+' then 'CD3_sign' end, case when trim("CD8_sign") = '+' then 'CD8_sign' end], lambda x: x is not null), '|') as positive, a is not null as matched_row from j left join f on f.id = a""")
def annotated_cells(spark, d):
    flow, joined = _labelled(spark, d)
    out = pairing.annotated(joined, flow, "phenotype", ["outlier"], ["CD3_sign", "CD8_sign"])
    return out.select("b", "a", "phenotype", "outlier", F.array_join("positive", "|").alias("positive"), "matched_row")


@query(f"with {_A.replace('/ 0.5 + 0.5', '').replace('/ 0.5', '').replace('1600', '900')}, r as (select b as label, a % 3 as slide, max(c_acctbal) as r from na join customer on c_custkey = a group by 1, 2) select label, max(r) filter (slide = 0) as s0, max(r) filter (slide = 1) as s1, max(r) filter (slide = 2) as s2 from r group by 1")
def residual_slides(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("s"), F.col("c_custkey") % 3).alias("slide"), F.col("c_acctbal").alias("x"), (F.col("c_nationkey") * 10).cast("double").alias("y"), F.col("c_acctbal").alias("residual"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("x"), (F.col("s_nationkey") * 10).cast("double").alias("y"))
    return pairing.residuals_by_slide(a, b, 30.0, ["s0", "s1", "s2"])


@query("select s_nationkey as label, arg_max(s_name, {'area': s_acctbal, 'minus': -s_suppkey}) as ring from supplier group by 1")
def rekeyed_rings(spark, d):
    s = table(spark, d, "supplier").withColumnRenamed("s_suppkey", "nucleus")
    return pairing.rekey_contours(s.select("nucleus", F.col("s_name").alias("ring"), F.col("nucleus").alias("at")), s.select("nucleus", F.col("s_nationkey").alias("label")), s.select("nucleus", F.col("s_acctbal").alias("area")))


_MASKS = (
    "recursive px as (select l_orderkey, l_linenumber, l_orderkey % 3 as slide, l_partkey % 40 as cell, l_suppkey % 30 as nucleus, l_linenumber < 6 as interior from lineitem), size as (select slide, nucleus, count(*) as size from px where nucleus > 0 group by 1, 2), over as (select slide, cell, nucleus, count(*) as n from px where nucleus > 0 and cell > 0 and interior group by 1, 2, 3), "
    "cand as (select slide, cell, list(nucleus order by (size - n) / size::double, nucleus) as ns, row_number() over (partition by slide order by cell) as i from over join size using (slide, nucleus) where n > 0 group by 1, 2), "
    "r as (select slide, 0::bigint as i, []::bigint[] as taken, 0::bigint as cell, null::bigint as nucleus from (select distinct slide from cand) union all select c.slide, c.i, case when c.p is null then c.taken else list_append(c.taken, c.p) end, c.cell, c.p from (select n.slide, n.i, r.taken, n.cell, list_filter(n.ns, lambda x: not list_contains(r.taken, x))[1] as p from r join cand n on n.slide = r.slide and n.i = r.i + 1) c), "
    "m as (select slide, cell, nucleus, row_number() over (partition by slide order by cell) as label from r where nucleus is not null)"
)


def _mask_pixels(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 3).alias("slide"), (F.col("l_partkey") % 40).alias("cell"), (F.col("l_suppkey") % 30).alias("nucleus"), (F.col("l_linenumber") < 6).alias("interior"))


@query(f"with {_MASKS} select slide, cell, nucleus, label from m")
def matched_masks(spark, d):
    return matching.matched_masks(_mask_pixels(spark, d), "slide")


@query(f"with {_MASKS}, p as (select px.*, coalesce(a.label, 0) as c, case when px.interior and b.label = a.label then a.label else 0 end as n from px left join m a on a.slide = px.slide and a.cell = px.cell left join m b on b.slide = px.slide and b.nucleus = px.nucleus) select l_orderkey, l_linenumber, c as cell_matched, n as nucleus_matched, c - n as cell_outside from p")
def painted_masks(spark, d):
    px = _mask_pixels(spark, d)
    return matching.painted_masks(px, matching.matched_masks(px, "slide"), "slide").select("l_orderkey", "l_linenumber", "cell_matched", "nucleus_matched", "cell_outside")


@query("select o_orderkey, o_custkey, c_name, n_name, r_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where o_orderstatus = 'F'")
def joined_assets(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("nation"))
    place = merge.join_all([table(spark, d, "nation").select(F.col("n_nationkey").alias("nation"), "n_name", F.col("n_regionkey").alias("region")), table(spark, d, "region").select(F.col("r_regionkey").alias("region"), "r_name")], ["region"])
    return merge.join_all([merge.join_all([o, c], ["o_custkey"]), place], ["nation"]).select("o_orderkey", "o_custkey", "c_name", "n_name", "r_name")


@query("with m as (select l_orderkey, array_to_string(list_sort(list(distinct lower(l_linestatus))), '|') as sig from lineitem group by 1) select a.l_orderkey as a, b.o_orderkey as b from m a join orders b on b.o_orderkey = a.l_orderkey and a.sig = lower(b.o_orderstatus)")
def combined_keys(spark, d):
    m = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("a")).agg(F.array_join(F.array_sort(F.collect_set(F.lower("l_linestatus"))), "|").alias("sig"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("b"), F.lower("o_orderstatus").alias("sig"))
    return merge.join_all([m.withColumn("key", F.col("a")), o.withColumn("key", F.col("b"))], ["key", "sig"]).select("a", "b")


@query("select c_custkey, coalesce(n, 0) as n, coalesce(last, '') as last from customer left join (select o_custkey, count(*) as n, max(o_orderpriority) as last from orders group by 1) on o_custkey = c_custkey")
def outer_defaults(spark, d):
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_orderpriority").alias("last"))
    return merge.join_or(table(spark, d, "customer").select("c_custkey"), n, ["c_custkey"], {"n": 0, "last": ""})


@query("select p.page_id, '/r/' || split_part(url, '/', -1) as report from pages p where (select count(*) from pages q where split_part(q.url, '/', -1) = split_part(p.url, '/', -1)) = 1 union all select p.page_id, null from pages p where (select count(*) from pages q where split_part(q.url, '/', -1) = split_part(p.url, '/', -1)) > 1")
def reported_items(spark, d):
    p = table(spark, d, "pages")
    name = F.regexp_extract("url", r"([^/]*)$", 1)
    single = p.groupBy(name.alias("name")).count().where("count = 1").select(F.concat(F.lit("/r/"), "name").alias("url"))
    return pairing.with_report(p.select("page_id", "url"), single, "url").drop("url")


@query("select c_custkey as id, c_acctbal as v, null::integer as nation, 's0' as sample from customer union all select s_suppkey, s_acctbal, s_nationkey, 's1' from supplier")
def cohort(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"))
    return merge.cohort([a, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v"), F.col("s_nationkey").alias("nation"))])


@query("select event_id, event_type || '::k' as name, cast(json_extract_string(props, '$.k') as double) as value from events where json_extract_string(props, '$.k') is not null")
def flat_metrics(spark, d):
    docs = table(spark, d, "events").select("event_id", F.create_map("event_type", F.from_json("props", "map<string,double>")).alias("metrics"))
    return merge.flat_metrics(docs, "event_id", "metrics").where("name like '%::k'")


@query("select o_custkey, o_orderpriority, arg_min(o_orderkey, {'s': o_orderstatus, 'k': o_orderkey}) as o_orderkey from orders group by 1, 2")
def priority_dedup(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderpriority", F.struct("o_orderstatus", "o_orderkey").alias("priority"), "o_orderkey")
    return merge.by_priority(rows, ["o_custkey", "o_orderpriority"], "priority").select("o_custkey", "o_orderpriority", "o_orderkey")


def _tasks(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id")
    return e.select(
        F.col("event_type").alias("process"), F.when(k % 7 == 0, "1").when(k % 3 == 0, "-").otherwise("0").alias("exit"), F.when(k % 5 != 0, F.col("value")).alias("realtime_s"), (F.col("user_id") % 400).cast("double").alias("cpu_pct"),
        F.when(k % 4 != 0, F.col("user_id") * 1e6).alias("memory_b"), (k * 1e5).alias("peak_rss_b"), (k * 2e5).alias("peak_vmem_b"), F.col("value").alias("rchar_b"), F.lit(None).cast("double").alias("wchar_b"),
    )


_TASKS = "t as (select event_type as process, event_id % 7 = 0 as failed, case when event_id % 5 <> 0 then value end as s, user_id % 400::double as cpu, case when event_id % 4 <> 0 then user_id * 1e6 end as m, event_id * 1e5 as r, value as rc from events)"
_ROLLUP = f"{_TASKS}, g as (select process, count(*) as n_tasks, round(sum(s), 4) as realtime_total_s, max(cpu)::double as cpu_max_pct, max(r) as peak_rss_max_b, max(r) * 2 as peak_vmem_max_b, round(sum(rc), 4) as rchar_total_b, 0.0::double as wchar_total_b, count_if(failed)::bigint as n_failed, max(m) as mem_req_max_b, round(coalesce(sum(s) filter (failed), 0), 4) as failed_realtime_s, round(coalesce(sum(coalesce(m, r) / 1073741824 * s / 3600) filter (failed), 0), 4) as failed_gb_h from t group by 1)"


def _rollup(spark, d):
    out = resources.rollup_by_process(_tasks(spark, d)).drop("realtime_mean_s")
    return out.withColumns({c: F.round(c, 4) for c in ("realtime_total_s", "rchar_total_b", "failed_realtime_s", "failed_gb_h")})


@query(f"with {_ROLLUP} select * from g")
def resource_rollup(spark, d):
    return _rollup(spark, d)


@query(f"with {_ROLLUP} select process, realtime_total_s, mem_req_max_b - peak_rss_max_b as headroom_b from g order by realtime_total_s desc, process limit 3")
def top_processes(spark, d):
    r = resources.headroom(_rollup(spark, d))
    return resources.top(r, F.col("realtime_total_s"), 3, "process").select("process", "realtime_total_s", "headroom_b")


@query("select l_suppkey, l_orderkey, l_linenumber from (select *, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber) - 1 as place, ceil(count(*) over (partition by l_suppkey) / 50.0) as step from lineitem) where place % step = 0")
def stride_sample(spark, d):
    return resources.stride_sample(table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber"), "l_suppkey", ["l_orderkey", "l_linenumber"], 50)


@query(
    "with r as (select cast(s_suppkey as varchar) as slide, s_acctbal as f, case when s_suppkey % 3 > 0 then s_acctbal / 7 end as p, s_suppkey * 1.0 as n from supplier), st as (select unnest(['rigid', 'non_rigid', 'micro']) as stage), "
    "c as (select cast(p_partkey as varchar) as slide, case p_size % 3 when 0 then 'rigid' when 1 then 'non_rigid' else 'micro' end as stage, p_retailprice as value from part where p_partkey <= 150), "
    "x as (select s.slide, stage, case stage when 'rigid' then f when 'non_rigid' then coalesce(p, n) else n end as f from (select distinct slide from c) s cross join st left join r using (slide)) "
    "select slide, stage, f as feature_tre_um, value as cell_disp_um, case when f is null or value is null then null when least(abs(f), abs(value)) > 0 then greatest(abs(f), abs(value)) > 3 * least(abs(f), abs(value)) else greatest(abs(f), abs(value)) > 0 end as divergent from x left join c using (slide, stage)"
)
def reconciled(spark, d):
    s, k = table(spark, d, "supplier"), F.col("s_suppkey")
    final = s.select(k.cast("string").alias("slide"), F.lit("final").alias("which"), F.col("s_acctbal").alias("rigid_D"), (k * 1.0).cast("double").alias("non_rigid_D"))
    early = s.where(k % 3 > 0).select(k.cast("string").alias("slide"), F.lit("premicro").alias("which"), F.lit(None).cast("double").alias("rigid_D"), (F.col("s_acctbal") / 7).alias("non_rigid_D"))
    stage = F.when(F.col("p_size") % 3 == 0, "rigid").when(F.col("p_size") % 3 == 1, "non_rigid").otherwise("micro")
    cells = table(spark, d, "part").where("p_partkey <= 150").select(F.col("p_partkey").cast("string").alias("slide"), stage.alias("stage"), F.col("p_retailprice").alias("value"))
    return resources.reconcile(final.unionByName(early), cells)


@query("select cast(event_id as varchar) as slide, event_type as stage, value * case when event_id % 2 = 0 then 0.5 else 1 end as value, case when event_id % 2 = 0 then 'um' else 'px' end as unit from events")
def stage_displacements(spark, d):
    e = table(spark, d, "events")
    px, um = F.create_map(F.lit("displacement_px_p50"), F.col("value")), F.create_map(F.lit("displacement_um_p50"), F.col("value") * 0.5)
    docs = e.select(F.col("event_id").cast("string").alias("moving"), F.create_map("event_type", F.when(F.col("event_id") % 2 == 0, F.map_concat(px, um)).otherwise(px)).alias("stages"))
    return resources.displacements(docs)


@query("select l_orderkey as slide, case when l_orderkey % 2 = 0 then 7 else count_if(l_tax < 0.04) end::bigint as n_accepted, count_if(not l_tax < 0.04)::bigint as n_rejected from lineitem group by 1")
def report_tiles(spark, d):
    docs = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("moving")).agg(F.collect_list(F.struct((F.col("l_tax") < 0.04).alias("accepted"))).alias("tiles"))
    return resources.tile_counts(docs.withColumns({"n_accepted": F.when(F.col("moving") % 2 == 0, F.lit(7).cast("long")), "n_rejected": F.lit(None).cast("long")}))


@query("select cast(user_id as varchar) as slide, arg_max(event_id % 1000, printf('%08d', event_id)) as n_pairs from events where event_id % 4 < 2 group by 1")
def match_counts(spark, d):
    k = F.col("event_id")
    text = F.when(k % 4 == 0, F.format_string('{"moving":"%d","matching":{"n_pairs":%d}}', "user_id", k % 1000)).when(k % 4 == 1, F.format_string('{"moving":"%d","matching":{"n_pairs":"%d.5"}}', "user_id", k % 1000)).when(k % 4 == 2, F.format_string('{"moving":"%d"}', "user_id"))
    return resources.match_counts(table(spark, d, "events").select(F.format_string("%08d", k).alias("file"), text.alias("text")))


@query(
    "with t as (select cast(s_suppkey as varchar) as slide, case when s_suppkey % 2 = 0 then 'premicro' else 'final' end as which, s_acctbal as r, s_nationkey * 1e0 as n from supplier), j as (select cast(c_custkey as varchar) as slide, 'final' as which, c_acctbal as r, c_nationkey * 1e0 as n from customer where c_custkey % 3 = 0) "
    "select slide, which, coalesce(j.r, t.r) as \"rigid_D\", coalesce(j.n, t.n) as \"non_rigid_D\" from t full join j using (slide, which)"
)
def intrinsic_residuals(spark, d):
    s = table(spark, d, "supplier").select(F.concat(F.lit("/in/"), "s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "_summary_premicro.csv").otherwise("_summary.csv")).alias("file"), F.when(F.col("s_suppkey") % 5 > 0, F.col("s_suppkey").cast("string")).alias("from"), F.col("s_suppkey").cast("string").alias("filename"), F.col("s_acctbal").cast("string").alias("rigid_D"), F.col("s_nationkey").cast("string").alias("non_rigid_D"))
    c = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.concat(F.lit("/in/"), "c_custkey", F.lit("_tre.json")).alias("file"), F.to_json(F.struct(F.col("c_custkey").cast("string").alias("moving"), F.col("c_acctbal").alias("coarse_tre_px"), F.struct(F.col("c_nationkey").alias("p50")).alias("residual_after_px"))).alias("text"))
    return resources.intrinsic_residuals(s, c)


@query("select event_type, count(*) as n, count_if(event_id % 9 = 0)::bigint as n_dropped, median(value) filter (event_id % 9 <> 0) as p50 from events group by 1")
def residual_summary(spark, d):
    rows = table(spark, d, "events").select("event_type", F.when(F.col("event_id") % 18 == 0, "nan").when(F.col("event_id") % 9 == 0, "?").otherwise(F.col("value").cast("string")).alias("r"))
    return resources.residual_summary(rows, "event_type", "r")


@query("select o_orderstatus, count(distinct o_custkey) as slides, min(o_orderkey) as least_pairs, median(o_orderkey)::double as median_pairs, median(o_totalprice) as p50 from orders group by 1")
def stage_distributions(spark, d):
    return resources.stage_distributions(table(spark, d, "orders"), "o_orderstatus", "o_custkey", "o_orderkey", "o_totalprice")


@query("with s as (select c_mktsegment, avg(c_acctbal::float::double) as m, stddev_pop(c_acctbal::float::double) as sd from customer group by 1) select c_custkey, round(case when sd > 0 then (c_acctbal::float::double - m) / sd else 0 end, 5) as z from customer join s using (c_mktsegment)")
def table_zscore(spark, d):
    return measure.table_zscore(table(spark, d, "customer"), "c_mktsegment", "c_acctbal").select("c_custkey", F.round("z", 5).alias("z"))


@query("select c_mktsegment, count(*) as n, min(c_acctbal) as least, max(c_acctbal) as greatest, round(sum(c_acctbal), 2) as total, count_if(c_acctbal < 0)::bigint as negative, count_if(c_acctbal > 9000)::bigint as wrapped, round(100.0 * count_if(c_acctbal < 0) / count(*), 6) as negative_pct, 100.0 * count_if(c_acctbal > 9000) / count(*) > 0.01 as is_wrapped from customer group by 1")
def pixel_stats(spark, d):
    return measure.pixel_stats(table(spark, d, "customer"), "c_mktsegment", "c_acctbal", 10_000).withColumns({"total": F.round("total", 2), "negative_pct": F.round("negative_pct", 6)})


@query("with l as (select 'q' as marker, l_quantity as v from lineitem union all select 't', l_tax from lineitem), e as (select marker, min(v) as lo, max(v) as hi, median(v) as median from l group by 1) select marker, cast(least(floor((v - lo) / (hi - lo) * 50), 49) as bigint) as bin, count(*) as n, any_value(median) as median from l join e using (marker) group by 1, 2")
def marker_histograms(spark, d):
    return measure.long_histograms(table(spark, d, "lineitem").select(F.col("l_quantity").alias("q"), F.col("l_tax").alias("t")), ["q", "t"], 50)


@query("with s as (select l_orderkey, count(*) as n from lineitem group by 1) select round(stddev_pop(n) / avg(n), 6) as cv, round(stddev_pop(n), 6) as sd, count(*) as labels from s")
def size_uniformity(spark, d):
    return measure.size_uniformity(table(spark, d, "lineitem"), "l_orderkey").withColumns({c: F.round(c, 6) for c in ("cv", "sd")})


@query("select round(sqrt(median(c_acctbal) filter (c_acctbal > 0) / pi()), 6) as radius from customer")
def equivalent_radius(spark, d):
    return measure.equivalent_radius(table(spark, d, "customer"), "c_acctbal").withColumn("radius", F.round("radius", 6))


@query("""select l_orderkey as label, avg(l_quantity) as "CD3", median(l_quantity) filter (l_returnflag = 'R') as "CD3: Nucleus: Median", median(l_quantity) filter (l_returnflag <> 'R') as "CD3: Cytoplasm: Median", median(l_quantity) as "CD3: Cell: Median" from lineitem group by 1""")
def quantified(spark, d):
    px = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("label"), (F.col("l_returnflag") == "R").alias("in_nucleus"), F.col("l_quantity").alias("value"))
    return measure.quantify(px, "CD3", expanded=False)
