"""Summaries for quality control: stages, tiles, thresholds, spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .measure import quantiles


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def stage_summary(pairs: DataFrame, stage: str, iou: str, distance: str, area_a: str, area_b: str, threshold: float = 0.5) -> DataFrame:
    """By stage: pairs, those scored, mean overlap, share at the threshold, mean Dice, and displacement percentiles.

    A pair is scored if its overlap is finite.  Dice comes from overlap: 2 iou / (1 + iou), weighted by area.
    """
    v, d = F.when(finite(F.col(iou)), F.col(iou)), F.when(finite(F.col(distance)), F.col(distance))
    both = F.when(v.isNotNull(), F.col(area_a) + F.col(area_b))
    dice = 2 * v / (1 + v)
    by = pairs.groupBy(stage).agg(
        F.count("*").alias("n"), F.count(v).alias("n_scored"), F.avg(v).alias("iou_mean"), F.avg((v >= threshold).cast("double")).alias("share_good"),
        F.try_divide(F.sum(dice * both), F.sum(both)).alias("dice"), F.avg(d).alias("d_mean"), F.max(d).alias("d_max"),
    )
    return by.join(quantiles(pairs.select(stage, d.alias("d")), stage, "d", {f"d_p{q}": q / 100 for q in (10, 50, 90)}), stage)


def tile_report(tiles: DataFrame, slide: str, accepted: Column, error: str, shifted: Column | None = None) -> DataFrame:
    """By slide: accepted and rejected tiles, and the spread of the accepted ones' errors (NULL where there is none).

    With `shifted` (whether a tile's node of the mesh moves anything): mesh_refined, whether any accepted tile's does.
    """
    if shifted is not None:
        out = tile_report(tiles, slide, accepted, error)
        mesh = tiles.groupBy(F.col(slide).alias("_slide")).agg(F.coalesce(F.bool_or(F.coalesce(accepted & shifted, F.lit(False))), F.lit(False)).alias("mesh_refined"))
        return out.join(mesh, F.col(slide).eqNullSafe(F.col("_slide"))).drop("_slide")
    e = F.when(F.coalesce(accepted, F.lit(False)) & finite(F.col(error)), F.col(error))
    ok = F.coalesce(accepted, F.lit(False))
    by = tiles.groupBy(slide).agg(F.count_if(ok).alias("n_accepted"), F.count_if(~ok).alias("n_rejected"), F.avg(e).alias("mean"), F.max(e).alias("worst"))
    both = by.join(quantiles(tiles.select(slide, e.alias("e")), slide, "e", {"p50": 0.5, "p90": 0.9}), slide)
    return both.select(slide, "n_accepted", "n_rejected", "mean", "p50", "p90", "worst")


def otsu(rows: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """By group: the bin (values are whole numbers from 0 to bins - 1) above which the foreground begins, and its share.

    The cut of most variance between classes, the least of equals; only counts of bins are shuffled and
    windowed, `bins` rows a group at most.
    """
    n = rows.where(F.col(value).isNotNull()).groupBy(group, F.least(F.greatest(F.col(value), F.lit(0)), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(group)
    upto = w.orderBy("bin")
    got = n.select(group, "bin", F.sum("n").over(upto).alias("low"), F.sum(F.col("n") * F.col("bin")).over(upto).alias("low_sum"), F.sum("n").over(w).alias("all"), F.sum(F.col("n") * F.col("bin")).over(w).alias("sum"))
    high = F.col("all") - F.col("low")
    apart = F.col("low_sum") / F.col("low") - (F.col("sum") - F.col("low_sum")) / F.nullif(high, F.lit(0))
    score = F.round(F.coalesce(F.col("low").cast("double") * high * apart * apart, F.lit(0.0)), 3)
    best = got.groupBy(group).agg(F.max(F.struct(score.alias("score"), (-F.col("bin")).alias("minus"), (high / F.col("all")).alias("share"))).alias("b"))
    return best.select(group, (-F.col("b.minus")).alias("cut"), F.col("b.share").alias("share"))


def uniformity(cells: DataFrame, cluster: str, features: list[str]) -> DataFrame:
    """Coefficient of variation of each feature, by cluster, and their mean weighted by the clusters' sizes.

    A constant feature counts 0; one with mean 0 is left out.
    """
    cv = lambda c: F.when(F.stddev_pop(c) == 0, 0.0).otherwise(F.try_divide(F.stddev_pop(c), F.avg(c)))
    by = cells.groupBy(cluster).agg(F.count("*").alias("n"), *[cv(c).alias(c) for c in features])
    real = F.filter(F.array(*features), lambda v: v.isNotNull())
    one = by.select("n", F.try_divide(F.aggregate(real, F.lit(0.0), lambda s, v: s + v), F.size(real)).alias("cv")).where("cv is not null")
    return one.agg((F.sum(F.col("n") * F.col("cv")) / F.sum("n")).alias("cv"), F.count("*").alias("clusters"))


def failures(trace: DataFrame, process: str, exit_code: Column, hours: Column, gb: Column) -> DataFrame:
    """By process: runs, failed runs, GB-hours reserved, and those lost to failures.  No exit code, "0" and "-" are no failures."""
    failed = ~F.coalesce(F.trim(exit_code), F.lit("")).isin("", "0", "-")
    spent = F.coalesce(hours * gb, F.lit(0.0))
    return trace.groupBy(process).agg(F.count("*").alias("n"), F.count_if(failed).alias("failed"), F.sum(spent).alias("gb_h"), F.sum(F.when(failed, spent).otherwise(0.0)).alias("lost_gb_h"))


def top_groups(rows: DataFrame, group: str, value: str, groups: int, each: int, order: str) -> DataFrame:
    """Of the `groups` groups with the greatest sums, the `each` rows of greatest value; ties by group and by order.

    Groups are picked from sums, and rows by a rank that each task bounds before the shuffle.
    """
    top = rows.groupBy(group).agg(F.round(F.sum(value), 4).alias("total")).orderBy(F.desc("total"), group).limit(groups).select(group)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(value), order))
    return rows.join(F.broadcast(top), group).withColumn("rank", rank).where(F.col("rank") <= each)
