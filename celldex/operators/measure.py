"""Grouped measurement: compartments, z-scores, percentiles, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compartments(pixels: DataFrame, label: str, value: str, nucleus: Column) -> DataFrame:
    """Mean, exact median and sum of value by label, for the cell, its nucleus and the rest of it.

    An empty compartment has NULL mean and median, and sum 0.  Label NULL is background and left out.  Labels are
    cells: a task holds and sorts the values of one at a time, which is quicker than counting different ones.
    """
    inside = {"cell": F.lit(True), "nucleus": nucleus, "cytoplasm": ~nucleus}
    out, shown = [], [F.col("label")]
    for name, where in inside.items():
        v, each = F.when(where, F.col(value)), F.col(f"_{name}")
        out += [F.avg(v).alias(f"{name}_mean"), F.coalesce(F.sum(v), F.lit(0.0)).alias(f"{name}_sum"), F.sort_array(F.collect_list(v)).alias(f"_{name}")]
        low, high = (F.get(each, F.floor((F.size(each) - k) / 2).cast("int")).cast("double") for k in (1, 0))
        shown += [F.col(f"{name}_mean"), ((low + high) / 2).alias(f"{name}_median"), F.col(f"{name}_sum")]
    return pixels.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(*out).select(*shown)


def zscore(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Adds z, by the population's deviation; 0 where the sample's is 0 or unknown, NULL where the value is."""
    stats = rows.groupBy(group).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sample"), F.stddev_pop(value).alias("_sd"))
    z = F.when(F.col(value).isNull(), None).when(F.coalesce(F.col("_sample"), F.lit(0.0)) == 0, 0.0).otherwise((F.col(value) - F.col("_mean")) / F.col("_sd"))
    return rows.join(stats, group, "left").withColumn("z", z).drop("_mean", "_sample", "_sd")


def table_zscore(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Adds z of values as 4-byte floats; 0 wherever there is no deviation, and for missing values too."""
    v = F.col(value).cast("float").cast("double")
    stats = rows.groupBy(group).agg(F.avg(v).alias("_mean"), F.stddev_pop(v).alias("_sd"))
    return rows.join(stats, group, "left").withColumn("z", F.coalesce(F.when(F.col("_sd") > 0, (v - F.col("_mean")) / F.col("_sd")), F.lit(0.0))).drop("_mean", "_sd")


def pixel_stats(pixels: DataFrame, group: str, value: str, most: float) -> DataFrame:
    """By group: n, least, greatest, sum, negative values and their percentage, values beyond 0.9 of the type's
    greatest, and whether more than 0.01 % are (as wrapped negatives would be).  One grouped aggregate: tasks fold their own part.
    """
    v = F.col(value)
    by = pixels.groupBy(group).agg(
        F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("greatest"), F.coalesce(F.sum(v), F.lit(0.0)).alias("total"),
        F.count_if(v < 0).alias("negative"), F.count_if(v > 0.9 * most).alias("wrapped"),
    )
    share = lambda c: F.coalesce(F.try_divide(100.0 * F.col(c), F.col("n")), F.lit(0.0))
    return by.select("*", share("negative").alias("negative_pct"), (share("wrapped") > 0.01).alias("is_wrapped"))


def long_histograms(rows: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """marker, bin, n, median: a histogram of each column over its own range, from one unpivot; NULL and NaN don't count."""
    long = rows.unpivot([], columns, "marker", "v").where("v is not null and not isnan(v)")
    ends = long.groupBy("marker").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).join(quantiles(long, "marker", "v", {"median": 0.5}), "marker")
    width = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(1.0)
    at = F.least(F.floor((F.col("v") - F.col("lo")) / width * bins), F.lit(bins - 1)).cast("long")
    return long.join(F.broadcast(ends), "marker").groupBy("marker", at.alias("bin")).agg(F.count("*").alias("n"), F.first("median").alias("median"))


def size_uniformity(pixels: DataFrame, label: str) -> DataFrame:
    """cv and sd of the labels' sizes (population), from their counts; label NULL and 0 are background."""
    size = pixels.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return size.agg(F.try_divide(F.stddev_pop("n"), F.avg("n")).alias("cv"), F.stddev_pop("n").alias("sd"), F.count("*").alias("labels"))


def equivalent_radius(areas: DataFrame, area: str) -> DataFrame:
    """radius: of a circle of the median positive area; 0 without one."""
    rows = areas.select(F.lit(0).alias("_all"), F.when(F.col(area) > 0, F.col(area)).alias("_area"))
    return quantiles(rows, "_all", "_area", {"m": 0.5}).agg(F.coalesce(F.sqrt(F.max("m") / F.pi()), F.lit(0.0)).alias("radius"))


def quantify(pixels: DataFrame, marker: str, expanded: bool) -> DataFrame:
    """label and a marker's measurements under their keys: its mean by its bare name, medians by compartment and,
    if expanded, means and sums.  pixels (label, in_nucleus, value); without labelled pixels, no rows and the same columns.
    """
    by = compartments(pixels, "label", "value", F.col("in_nucleus"))
    names = {"nucleus": "Nucleus", "cytoplasm": "Cytoplasm", "cell": "Cell"}
    out = [F.col("cell_mean").alias(marker)]
    for statistic in ("median", "mean", "sum") if expanded else ("median",):
        out += [F.col(f"{k}_{statistic}").alias(f"{marker}: {v}: {statistic.title()}") for k, v in names.items()]
    return by.select("label", *out)


BINS = 1 << 16


def _scale(v: Column) -> Column:
    """A bin that never falls as v rises: by sign and sixteenths of a doubling; no two doubles are in more than some 70,000 bins."""
    x = v.cast("double")
    size = F.floor((F.log2(F.abs(x)) + 1100) * 16).cast("long")
    return F.when(x == 0, 0).when(F.abs(x) == float("inf"), F.signum(x) * 100_000).otherwise(F.signum(x) * size).cast("long")


def at_ranks(rows: DataFrame, group: str, value: str, ranks: dict[str, Column]) -> DataFrame:
    """group, n and for each name the value at a rank (from 0, of `n`, the group's values) among the group's, in order.

    Ranks are found by leading digits: counts of different values are binned by size, and again evenly over the
    values that the bin of a rank really holds, whatever lies outside it, so a far value spoils no bins.  What is
    sorted in the end is one of 65,536 bins of values within a sixteenth of a doubling, and no task sees a group.
    NULL and NaN don't count; a group without other values has NULLs.
    """
    g, v = F.struct(group).alias("g"), F.when(~F.isnan(F.col(value).cast("double")), F.col(value))
    counts = rows.groupBy(g, v.alias("v")).agg(F.count(v).alias("k"))
    totals = counts.groupBy("g").agg(F.sum("k").alias("n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), r.cast("long").alias("rank")) for k, r in ranks.items()])).alias("w")
    asked = totals.where("n > 0").select("g", wanted).groupBy("g", F.col("w.rank").alias("rank")).agg(F.collect_set("w.name").alias("names"))
    cells = counts.where("k > 0").withColumns({"path": F.lit(0).cast("long"), "bin": _scale(F.col("v"))})
    asked = asked.withColumn("path", F.lit(0).cast("long"))  # the rank within what the path has left
    for step in range(2):
        if step:
            ends = cells.groupBy("g", "path").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
            width = (F.col("hi") - F.col("lo")).cast("double")
            even = F.when((width > 0) & (width < float("inf")), F.least(F.floor((F.col("v") - F.col("lo")) / width * BINS), F.lit(BINS - 1))).otherwise(0)
            cells = cells.join(ends, ["g", "path"]).withColumn("bin", even.cast("long")).drop("lo", "hi")
        sizes = cells.groupBy("g", "path", "bin").agg(F.sum("k").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("g", "path").orderBy("bin"))  # bins of a path
        sizes = sizes.withColumn("upto", upto)
        hit = asked.join(sizes, ["g", "path"]).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("size")))
        new = F.xxhash64("path", "bin", F.lit(step))
        asked = hit.select("g", (F.col("rank") - F.col("upto") + F.col("size")).alias("rank"), "names", new.alias("path"))
        cells = cells.join(hit.select("g", "path", "bin").distinct(), ["g", "path", "bin"], "left_semi").select("g", "v", "k", new.alias("path"), "bin")
    upto = F.sum("k").over(Window.partitionBy("g", "path").orderBy("v"))
    found = asked.join(cells.withColumn("upto", upto), ["g", "path"]).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("k")))
    each = found.groupBy("g").agg(*[F.max(F.when(F.array_contains("names", k), F.col("v"))).alias(k) for k in ranks])
    return totals.join(each, "g", "left").select(F.col(f"g.{group}").alias(group), "n", *ranks)


def quantiles(rows: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """group and linearly interpolated percentiles, for groups of any size."""
    place = {k: (F.col("n") - 1) * F.lit(q) for k, q in shares.items()}
    ranks = {f"{k}_{e}": f(p) for k, p in place.items() for e, f in (("low", F.floor), ("high", F.ceil))}
    got = at_ranks(rows, group, value, ranks)
    part = lambda k: F.col(f"{k}_low") + (F.col(f"{k}_high") - F.col(f"{k}_low")) * (place[k] - F.floor(place[k]))
    return got.select(group, *[part(k).cast("double").alias(k) for k in shares])


def nearest_rank(rows: DataFrame, group: str, value: str, percent: int) -> DataFrame:
    """The value at rank ceil(n * percent / 100) of each group that has a value, for groups of any size."""
    rank = F.greatest(F.ceil(F.col("n") * percent / 100), F.lit(1)) - 1
    return at_ranks(rows, group, value, {f"p{percent}": rank}).where("n > 0").drop("n")


def interpolated(rows: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Linearly interpolated percentiles, to 6 places; a task holds a group's different values (`quantiles` doesn't)."""
    return rows.groupBy(group).agg(*[F.round(F.percentile(value, F.lit(q)), 6).alias(k) for k, q in shares.items()])


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in equal bins from the least value to the greatest, which lies in the last bin."""
    ends = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.least(F.floor((F.col(value) - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))), F.lit(bins - 1))
    return rows.where(F.col(value).isNotNull()).join(F.broadcast(ends)).groupBy(F.coalesce(at, F.lit(0)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def stage_delta(rows: DataFrame, stage: str, value: str, anchor: str) -> DataFrame:
    """Mean and median of each stage, and how far they are from the anchor stage's."""
    by = rows.groupBy(stage).agg(F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean"))
    by = by.join(quantiles(rows, stage, value, {"p50": 0.5}).withColumn("p50", F.round("p50", 6)), stage)
    base = by.where(F.col(stage) == anchor).select(F.col("mean").alias("_m"), F.col("p50").alias("_p"))
    delta = [F.round(F.col("mean") - F.col("_m"), 4).alias("delta_mean"), F.round(F.col("p50") - F.col("_p"), 4).alias("delta_p50")]
    return by.join(F.broadcast(base), how="left").select(stage, "n", "mean", "p50", *delta)
