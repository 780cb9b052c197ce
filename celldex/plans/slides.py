"""Queries on slides and their sheets: orders stand in for slides of patients (customers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import merge
from ..sources import sheets
from ..sources.tables import table
from .registry import query


def _slides(spark, d):
    channels = F.array(F.substring("o_orderpriority", 3, 20), F.lower("o_orderstatus"), F.lit("DAPI"))
    return table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("patient_id"), F.col("o_orderkey").alias("row"), (F.col("o_orderstatus") == "F").alias("is_reference"), channels.alias("channels"), F.concat(F.lit("/in/"), "o_orderpriority", F.lit(".ome.tif")).alias("image"))


_SLIDES = "s as (select cast(o_custkey as varchar) as patient_id, o_orderkey as row, o_orderstatus = 'F' as is_reference, [substring(o_orderpriority, 3, 20), lower(o_orderstatus), 'DAPI'] as channels, '/in/' || o_orderpriority || '.ome.tif' as image from orders)"
_KEPT = _SLIDES + ", e as (select patient_id, row, is_reference, generate_subscripts(channels, 1) as place, unnest(channels) as channel from s), f as (select patient_id, row, place, channel from e qualify row_number() over (partition by patient_id, upper(channel) order by not is_reference, row, place) = 1), k as (select patient_id, row, array_to_string(list(channel order by place), '|') as channels, count(*) as n from f group by 1, 2)"


@query(f"with {_KEPT} select patient_id, row, coalesce(k.channels, '') as channels from s left join k using (patient_id, row)")
def kept_channels(spark, d):
    return sheets.kept_channels(_slides(spark, d), "row").withColumn("channels", F.array_join("channels", "|"))


@query(f"with {_KEPT}, g as (select patient_id, row, place, channel from e where not (patient_id < '5' and upper(channel) = 'DAPI') qualify row_number() over (partition by patient_id, upper(channel) order by not is_reference, row, place) = 1) select patient_id, row, array_to_string(list(channel order by place), '|') as channels from g group by 1, 2")
def kept_unclaimed(spark, d):
    s = _slides(spark, d)
    claimed = s.where("patient_id < '5'").select("patient_id", F.lit(" dapi").alias("channel"))
    return sheets.kept_channels(s, "row", claimed).where(F.size("channels") > 0).withColumn("channels", F.array_join("channels", "|"))


@query(f"with {_KEPT} select patient_id, cast(sum(n) as bigint) as n from k group by 1")
def channel_totals(spark, d):
    return sheets.channel_totals(sheets.kept_channels(_slides(spark, d), "row"))


@query(f"with {_KEPT} select patient_id, (select count(*) from s where s.patient_id = k.patient_id) as images, cast(sum(n) as bigint) as channels from k group by 1 union all select null, (select count(*) from s), cast(sum(n) as bigint) from k")
def run_manifest(spark, d):
    s = _slides(spark, d)
    return sheets.run_manifest(s, sheets.kept_channels(s, "row"))


@query(f"with {_SLIDES} select patient_id, count(*) as images from s group by 1")
def image_counts(spark, d):
    return sheets.image_counts(_slides(spark, d))


@query(f"with {_SLIDES} select patient_id, split_part(split_part(image, '/', -1), '.', 1) as stem, count(*) as n from s group by 1, 2")
def stem_counts(spark, d):
    return sheets.stem_counts(_slides(spark, d), "image")


@query(f"with {_SLIDES} select patient_id, count(distinct upper(c)) as n from (select patient_id, unnest(channels) as c from s) group by 1")
def declared_channels(spark, d):
    return sheets.declared_channels(_slides(spark, d))


@query(f"with {_SLIDES} select patient_id, array_to_string(arg_max(channels, row), '|') as channels from s where is_reference group by 1")
def reference_channels(spark, d):
    return sheets.reference_channels(_slides(spark, d), "row").withColumn("channels", F.array_join("channels", "|"))


@query(
    "with s as (select case when o_orderkey % 50 = 0 then '' else cast(o_custkey as varchar) end as patient_id, o_orderkey as row, case when o_orderkey % 31 = 0 then 'yes' when o_orderstatus = 'F' then 'True' else 'false' end as ref, case when o_orderkey % 37 = 0 then ' | ' when o_orderkey % 41 = 0 then 'CD3' else 'CD3|dapi_1' end as channels from orders), "
    "own as (select patient_id, row, unnest(list_filter([case when patient_id = '' then 'missing patient' end, case when ref = 'yes' then 'is_reference isn''t true or false' end, case when channels = ' | ' then 'no channels' end, case when channels = 'CD3' then 'no nuclear channel' end], lambda x: x is not null)) as problem from s), "
    "refs as (select patient_id, count_if(ref = 'True') as n from s where patient_id <> '' group by 1) select * from own union all select patient_id, null, case when n > 1 then 'several references' else 'no reference' end from refs where n <> 1"
)
def sheet_problems(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        F.when(k % 50 == 0, " ").otherwise(F.col("o_custkey").cast("string")).alias("patient_id"), k.alias("row"),
        F.when(k % 31 == 0, "yes").when(F.col("o_orderstatus") == "F", "True").otherwise("false").alias("is_reference"),
        F.when(k % 37 == 0, " | ").when(k % 41 == 0, "CD3").otherwise("CD3|dapi_1").alias("channels"),
    )
    return sheets.sheet_problems(rows, ["DAPI"]).withColumn("patient_id", F.trim("patient_id"))


@query("""select c_custkey, '"' || replace(c_name || ',"' || c_mktsegment, '"', '""') || '",' || c_mktsegment || ',' as line from customer""")
def quoted_rows(spark, d):
    c = table(spark, d, "customer")
    line = F.concat_ws(",", scalars.quoted(F.concat("c_name", F.lit(',"'), "c_mktsegment")), scalars.quoted(F.col("c_mktsegment")), scalars.quoted(F.lit(None)))
    return c.select("c_custkey", line.alias("line"))


_SHOWN = "case when b is null then 'N/A' when b < 1024 then printf('%.1f B', b) when b < 1048576 then printf('%.1f KB', b / 1024) when b < 1073741824 then printf('%.1f MB', b / 1048576) when b < 1099511627776 then printf('%.1f GB', b / 1073741824) else printf('%.1f TB', b / 1099511627776) end"


@query(
    f"with p as (select p_partkey, case when p_partkey % 9 = 0 then null else pow(7.0, p_partkey % 17) * 1.013 end as b, case when p_partkey % 7 = 0 then null else p_partkey * p_size end as s from part) select p_partkey, {_SHOWN} as bytes, "
    "case when s is null then 'N/A' when s >= 3600 then printf('%dh %dm %ds', s // 3600, s % 3600 // 60, s % 60) when s >= 60 then printf('%dm %ds', s // 60, s % 60) else printf('%ds', s) end as seconds, 'C' || p_partkey as process, p_partkey as whole, null::double as number from p"
)
def shown_values(spark, d):
    k = F.col("p_partkey")
    p = table(spark, d, "part")
    return p.select(
        k, scalars.shown_bytes(F.when(k % 9 != 0, F.pow(F.lit(7.0), k % 17) * 1.013)).alias("bytes"), scalars.shown_seconds(F.when(k % 7 != 0, k * F.col("p_size"))).alias("seconds"),
        scalars.short_process(F.concat(F.lit("A:B:C"), k)).alias("process"), scalars.whole_or_null(F.concat(k, F.lit(".7"))).alias("whole"), scalars.float_or_null(F.lit("nan")).alias("number"),
    )


@query(
    "with c as (select p_partkey, [p_type, p_brand, ' dapi ' || p_size, ''] as ch from part) select p_partkey, list_contains(list_transform(ch, lambda c: contains(upper(trim(c)), 'DAPI')), true) as any_nuclear, "
    "2 as nuclear, case when contains(upper(p_type), 'STEEL') then 0 else 2 end as preferred, p_brand || ': Cell: Mean' as key, p_brand as marker, 'Cell' as compartment, 'Mean' as statistic, null::varchar as bare from c join part using (p_partkey)"
)
def channel_rules(spark, d):
    p = table(spark, d, "part")
    ch = F.array("p_type", "p_brand", F.concat(F.lit(" dapi "), "p_size"), F.lit(""))
    key = scalars.key_of(F.col("p_brand"), F.lit("Cell"), F.lit("Mean"))
    back = scalars.measurement_key(key)
    return p.select(
        "p_partkey", F.exists(ch, lambda c: scalars.is_nuclear(c, ["DAPI"])).alias("any_nuclear"), scalars.nuclear_index(ch, ["dapi"]).alias("nuclear"), scalars.nuclear_index(ch, ["STEEL", "DAPI"]).alias("preferred"),
        key.alias("key"), back["marker"].alias("marker"), back["compartment"].alias("compartment"), back["statistic"].alias("statistic"), scalars.measurement_key(F.col("p_brand"))["compartment"].alias("bare"),
    )


@query(
    "select p_partkey, case p_partkey % 4 when 0 then p_size * 1e0 when 1 then p_size * 0.001e0 when 2 then p_size * 1000e0 end as um, case when p_partkey % 2 = 0 then p_size / 100e0 else 0.325e0 end as pixel, abs(p_size / 100.0 - 0.325) > 0.05 * 0.325 as differs, p_size + 0.5e0 as corner from part"
)
def pixel_sizes(spark, d):
    k, n = F.col("p_partkey"), F.col("p_size")
    unit = F.element_at(F.array(F.lit("µm"), F.lit("nm"), F.lit(" MM"), F.lit("furlong")), (k % 4 + 1).cast("int"))
    return table(spark, d, "part").select(
        k, scalars.in_micrometres(n.cast("string"), unit).alias("um"), scalars.pixel_size(F.when(k % 2 == 0, "auto").otherwise("0.325"), n / 100).alias("pixel"),
        scalars.sizes_differ(n / 100, F.lit(0.325), 0.05).alias("differs"), scalars.centre_to_corner(n).alias("corner"),
    )


@query("select c_custkey, cast(round_even(least(greatest(c_acctbal * 10, 0), 65535), 0) as integer) as stored, greatest(c_acctbal, 0) as clipped from customer")
def stored_values(spark, d):
    v = F.col("c_acctbal")
    return table(spark, d, "customer").select("c_custkey", scalars.stored(v * 10, 0, 65535, "int").alias("stored"), scalars.clipped(v).alias("clipped"))


@query(
    "with c as (select p_partkey, p_partkey % 100 as i from part), h as (select p_partkey, i, (i * 0.618033988749895e0) % 1.0e0 * 6 as h, 0.7e0 + (i % 3) * 0.1e0 as s, 0.85e0 + (i % 2) * 0.1e0 as v from c), x as (select *, floor(h)::integer as k, v * (1 - s) as p, v * (1 - s * (h - floor(h))) as q, v * (1 - s * (1 - (h - floor(h)))) as t from h) "
    "select p_partkey, floor(([v, q, p, p, t, v])[k + 1] * 255)::integer as r, floor(([t, v, v, q, p, p])[k + 1] * 255)::integer as g, floor(([p, p, t, v, v, q])[k + 1] * 255)::integer as b, case when i % 2 = 0 then 'x|y' else 'channel_0|channel_1|channel_2' end as names from x"
)
def channel_colors(spark, d):
    i = F.col("p_partkey") % 100
    c = scalars.channel_color(i)
    names = scalars.channel_names(F.array(F.lit("x"), F.lit("y")), F.when(i % 2 == 0, 2).otherwise(3))
    return table(spark, d, "part").select("p_partkey", c["r"].alias("r"), c["g"].alias("g"), c["b"].alias("b"), F.array_join(names, "|").alias("names"))


_KNOWN = ", ".join(f"('{k.upper()}', {r}, {g}, {b})" for k, (r, g, b) in scalars.MARKER_COLORS.items())


@query(
    f"with k(name, r, g, b) as (values {_KNOWN}), c as (select p_partkey, ['DAPI', 'cd45', 'CD3', 'CD1', 'Foxp3', 'segmentation', 'X'][p_partkey % 7 + 1] as marker, p_partkey % 40 as i from part), h as (select *, (i * 0.618033988749895e0) % 1.0e0 * 6 as h, 0.7e0 + (i % 3) * 0.1e0 as s, 0.85e0 + (i % 2) * 0.1e0 as v from c), x as (select *, floor(h)::integer as f, v * (1 - s) as p, v * (1 - s * (h - floor(h))) as q, v * (1 - s * (1 - (h - floor(h)))) as t from h) "
    "select p_partkey, coalesce(k.r, floor(([v, q, p, p, t, v])[f + 1] * 255)::integer) as r, coalesce(k.g, floor(([t, v, v, q, p, p])[f + 1] * 255)::integer) as g, coalesce(k.b, floor(([p, p, t, v, v, q])[f + 1] * 255)::integer) as b from x left join k on k.name = upper(marker)"
)
def marker_colors(spark, d):
    k = F.col("p_partkey")
    name = F.element_at(F.array(*[F.lit(n) for n in ("DAPI", "cd45", "CD3", "CD1", "Foxp3", "segmentation", "X")]), (k % 7 + 1).cast("int"))
    return table(spark, d, "part").select(k, F.inline(F.array(scalars.marker_color(name, k % 40))))


@query("""select event_id, case when event_id % 3 = 0 then '{"k": NaN, "v": [' || user_id || ', NaN]}' when event_id % 3 = 1 then '{"a": {"b": NaN}}' end as clean, '/out/csv/' || event_type || '.csv' as checkpoint from events""")
def cleaned_documents(spark, d):
    k = F.col("event_id")
    text = F.when(k % 3 == 0, F.format_string('{"k":null,"v":[%d,null]}', "user_id")).when(k % 3 == 1, '{"a":{"b":null}}').otherwise("not one")
    return table(spark, d, "events").select("event_id", scalars.clean_document(text).alias("clean"), scalars.checkpoint_path(F.lit("/out/"), F.col("event_type")).alias("checkpoint"))


@query("select o_orderpriority as process, o_orderstatus as tool, cast(year(o_orderdate::date) as varchar) as version from orders group by all")
def unique_versions(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderpriority").alias("process"), F.col("o_orderstatus").alias("tool"), F.year(F.col("o_orderdate").cast("date")).cast("string").alias("version")).distinct()


@query(
    "with p as (select p_partkey, p_partkey + 100 as h, p_size * 37 + 50 as w from part) select p_partkey, case when h * w <= 9000 then 1 else (select min(f) from range(1, 200) t(f) where ceil(h / f::double) * ceil(w / f::double) <= 9000)::integer end as blocks, greatest(ceil(greatest(h, w) / 512.0), 1)::integer as decimation, cast(greatest(floor(greatest(floor(65536 / (w * 4)), 3) / 3) * 3, 3) as bigint) as band from p"
)
def plane_factors(spark, d):
    h, w = F.col("p_partkey") + 100, F.col("p_size") * 37 + 50
    return table(spark, d, "part").select("p_partkey", scalars.downsample_factor(h, w, 9000).alias("blocks"), scalars.decimation_factor(F.greatest(h, w), 512).alias("decimation"), scalars.band_rows(w, 3, 65536).alias("band"))


@query("select page_id, '/out/' || lang || '/pages/' || split_part(url, '/', -1) as published, case when page_id % 2 = 0 then '/out/' || lang || '/pages/' || split_part(url, '/', -1) else '/prior/x' end as kept from (select page_id, url, cast(page_id % 5 as varchar) as lang from pages)")
def published_paths(spark, d):
    path = scalars.published_path(F.lit("/out/"), (F.col("page_id") % 5).cast("string"), F.lit("pages"), F.lit(None).cast("string"), F.col("url"))
    file = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/work/"), "url")).otherwise("/prior/x")
    return table(spark, d, "pages").select("page_id", path.alias("published"), scalars.published_or_as_is(file, "/work", path).alias("kept"))


@query("with p as (select p_partkey, p_size / 3.0 - 2 as v from part), w as (select p_partkey, least(greatest(v, 0), 10) as v from p) select p_partkey, case when v < 1 then 0 when v < 4 then 1 else 2 end as i0, case when v < 1 then 1 when v < 4 then 2 else 3 end as i1, round(case when v < 1 then v when v < 4 then (v - 1) / 3 else (v - 4) / 6 end, 6) as t from w")
def grid_weights(spark, d):
    w = scalars.bilinear_weights(F.col("p_size") / 3.0 - 2, F.array(*[F.lit(float(x)) for x in (0, 1, 4, 10)]))
    return table(spark, d, "part").select("p_partkey", w["i0"].alias("i0"), w["i1"].alias("i1"), F.round(w["t"], 6).alias("t"))


@query("select distinct p_brand, p_size from part where p_size not in (select l_linenumber from lineitem)")
def unconsumed_kinds(spark, d):
    known = table(spark, d, "part").select("p_brand", "p_size")
    used = known.join(table(spark, d, "lineitem").select(F.col("l_linenumber").alias("p_size")).distinct(), "p_size")
    return merge.unconsumed(known, used)
