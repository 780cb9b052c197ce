"""Resources of runs, and what is reported of registration: rollups, samples, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import numbered
from .measure import quantiles
from .quality_control import finite

GIB, HOUR = 1 << 30, 3600.0


def is_failure(exit_code: Column) -> Column:
    """Any exit code but none, "0" and "-"."""
    return ~F.coalesce(F.trim(exit_code.cast("string")), F.lit("")).isin("", "0", "-")


def reserved_gb_h(memory: Column, observed: Column, seconds: Column) -> Column:
    """GiB (those asked for, or else the peak) times hours; 0 where either is missing."""
    return F.coalesce(F.coalesce(memory, observed) / GIB * seconds / HOUR, F.lit(0.0))


def rollup_by_process(tasks: DataFrame) -> DataFrame:
    """By process: tasks, times, peaks, traffic, failures and what they cost; sums are 0 and peaks NULL without a number."""
    failed = is_failure(F.col("exit"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    spent = reserved_gb_h(F.col("memory_b"), F.col("peak_rss_b"), F.col("realtime_s"))
    return tasks.groupBy("process").agg(
        F.count("*").alias("n_tasks"), total("realtime_s").alias("realtime_total_s"), F.bround(total("realtime_s") / F.count("*"), 1).alias("realtime_mean_s"),
        F.max("cpu_pct").alias("cpu_max_pct"), F.max("peak_rss_b").alias("peak_rss_max_b"), F.max("peak_vmem_b").alias("peak_vmem_max_b"),
        total("rchar_b").alias("rchar_total_b"), total("wchar_b").alias("wchar_total_b"), F.count_if(failed).alias("n_failed"), F.max("memory_b").alias("mem_req_max_b"),
        total(F.when(failed, F.col("realtime_s"))).alias("failed_realtime_s"), F.sum(F.when(failed, spent).otherwise(0.0)).alias("failed_gb_h"),
    )


def top(rows: DataFrame, by: Column, most: int, tie: str) -> DataFrame:
    """The `most` rows of greatest value, those without one left out; a bounded sort, as each task keeps `most` rows."""
    return rows.where(by.isNotNull()).orderBy(by.desc(), tie).limit(most)


def headroom(rollup: DataFrame) -> DataFrame:
    """rollup with what was asked for beyond the peak, in bytes; NULL where either is missing."""
    return rollup.withColumn("headroom_b", F.col("mem_req_max_b") - F.col("peak_rss_max_b"))


def stride_sample(rows: DataFrame, group: str, order: list[str], most: int) -> DataFrame:
    """Of each group every k-th row in order, k the least whole number that leaves `most` rows or fewer."""
    step = rows.groupBy(F.col(group).alias("_key")).agg(F.ceil(F.count("*") / most).alias("_step"))
    at = numbered(rows, group, order, "_at")
    return at.join(step, F.col(group).eqNullSafe(F.col("_key"))).where((F.col("_at") - 1) % F.col("_step") == 0).drop("_key", "_step", "_at")


#: Stages in order, and which summary and column has each one's residual.
STAGES = [("rigid", "final", "rigid_D"), ("non_rigid", "premicro", "non_rigid_D"), ("micro", "final", "non_rigid_D")]
DIVERGENT = 3.0


def reconcile(residuals: DataFrame, cells: DataFrame) -> DataFrame:
    """slide, stage, feature_tre_um, cell_disp_um, divergent for each slide of cells and each stage.

    residuals (slide, which: final or premicro, rigid_D, non_rigid_D), one row each; cells (slide, stage, value).
    The non-rigid stage falls back to the final summary.  Divergent: one is more than `DIVERGENT` times the
    other, NULL where either is missing.
    """
    long = residuals.unpivot(["slide", "which"], ["rigid_D", "non_rigid_D"], "column", "v")
    value = {(w, c): F.max(F.when((F.col("which") == w) & (F.col("column") == c), F.col("v"))) for _, w, c in STAGES}
    by = long.groupBy("slide").agg(*[v.alias(f"{w}_{c}") for (w, c), v in value.items()])
    feature = F.array(*[F.struct(F.lit(s).alias("stage"), (F.coalesce(F.col(f"{w}_{c}"), F.col("final_non_rigid_D")) if s == "non_rigid" else F.col(f"{w}_{c}")).alias("f")) for s, w, c in STAGES])
    features = by.select("slide", F.inline(feature))
    stages = F.explode(F.array(*[F.lit(s) for s, _, _ in STAGES])).alias("stage")
    rows = cells.select("slide").distinct().select("slide", stages).join(features, ["slide", "stage"], "left").join(cells, ["slide", "stage"], "left")
    low, high = F.least(F.abs("f"), F.abs("value")), F.greatest(F.abs("f"), F.abs("value"))
    far = F.when(F.col("f").isNotNull() & F.col("value").isNotNull(), F.when(low > 0, high > DIVERGENT * low).otherwise(high > 0))
    return rows.select("slide", "stage", F.col("f").alias("feature_tre_um"), F.col("value").alias("cell_disp_um"), far.alias("divergent"))


def displacements(docs: DataFrame) -> DataFrame:
    """slide, stage, value, unit: each stage's median displacement, in micrometres if it has that, else in pixels.

    docs (moving, stages: a map of stage to a map of metrics).
    """
    each = docs.select(F.col("moving").alias("slide"), F.explode("stages").alias("stage", "m"))
    of = lambda unit: F.try_element_at("m", F.lit(f"displacement_{unit}_p50"))
    out = each.select("slide", "stage", F.coalesce(of("um"), of("px")).alias("value"), F.when(of("um").isNotNull(), "um").otherwise("px").alias("unit"))
    return out.where("value is not null")


def tile_counts(docs: DataFrame) -> DataFrame:
    """slide, n_accepted, n_rejected of tile reports: the counts they give, or else those of their tiles (moving, tiles: array of accepted, ...)."""
    own = lambda yes: F.size(F.filter("tiles", lambda t: t["accepted"] if yes else ~t["accepted"])).cast("long")
    return docs.select(F.col("moving").alias("slide"), F.coalesce("n_accepted", own(True)).alias("n_accepted"), F.coalesce("n_rejected", own(False)).alias("n_rejected"))


def residual_summary(rows: DataFrame, slide: str, value: str) -> DataFrame:
    """By slide: rows, those whose residual isn't a finite number, and the median of the others."""
    v = F.col(value).try_cast("double")
    by = rows.groupBy(slide).agg(F.count("*").alias("n"), F.count_if(~F.coalesce(finite(v), F.lit(False))).alias("n_dropped"))
    middle = quantiles(rows.select(F.col(slide).alias("_slide"), F.when(finite(v), v).alias("_v")), "_slide", "_v", {"p50": 0.5})
    return by.join(middle, F.col(slide).eqNullSafe(F.col("_slide")), "left").select(slide, "n", "n_dropped", "p50")


def stage_distributions(rows: DataFrame, stage: str, slide: str, pairs: str, value: str) -> DataFrame:
    """By stage: slides, least and median pairs, and the median value."""
    out = rows.groupBy(stage).agg(F.countDistinct(slide).alias("slides"), F.min(pairs).alias("least_pairs"))
    for column, name in ((pairs, "median_pairs"), (value, "p50")):
        middle = quantiles(rows.select(F.col(stage).alias("_stage"), F.col(column).alias("_v")), "_stage", "_v", {name: 0.5})
        out = out.join(middle, F.col(stage).eqNullSafe(F.col("_stage")), "left").drop("_stage")
    return out


def match_counts(docs: DataFrame) -> DataFrame:
    """slide, n_pairs of quality documents (JSON text) that name their moving slide and have a number of matched pairs; of several the greatest file's (file, text)."""
    n = F.get_json_object("text", "$.matching.n_pairs").try_cast("double")
    slide = F.get_json_object("text", "$.moving")
    rows = docs.select("file", slide.alias("slide"), F.floor(n).cast("long").alias("n_pairs")).where("slide <> '' and n_pairs is not null")
    return rows.groupBy("slide").agg(F.max_by("n_pairs", "file").alias("n_pairs"))


def intrinsic_residuals(summaries: DataFrame, docs: DataFrame) -> DataFrame:
    """slide, which (final or premicro), rigid_D, non_rigid_D, as `reconcile` takes them, from both kinds of source.

    summaries (file, from, filename, rigid_D, non_rigid_D: texts): rows of tables, `premicro` where the file's name ends in
    _summary_premicro.csv; the slide is `from`, else `filename`.  docs (file, text): JSON of tiled runs, whose coarse residual is the
    rigid one and whose median after refinement the non-rigid one.  A slide in both is merged; documents count over tables, later
    files over earlier ones.
    """
    num = lambda c: F.nullif(F.trim(c), F.lit("")).try_cast("double")
    slide = F.coalesce(F.nullif("from", F.lit("")), F.nullif("filename", F.lit("")))
    which = F.when(F.endswith("file", F.lit("_summary_premicro.csv")), "premicro").otherwise("final")
    tables = summaries.select(F.lit(0).alias("kind"), "file", slide.alias("slide"), which.alias("which"), num(F.col("rigid_D")).alias("rigid_D"), num(F.col("non_rigid_D")).alias("non_rigid_D"))
    part = lambda p: F.get_json_object("text", p).try_cast("double")
    name = F.coalesce(F.get_json_object("text", "$.moving"), F.regexp_extract("file", r"([^/]*)$", 1))
    tiled = docs.select(F.lit(1).alias("kind"), "file", name.alias("slide"), F.lit("final").alias("which"), part("$.coarse_tre_px").alias("rigid_D"), part("$.residual_after_px.p50").alias("non_rigid_D"))
    rows = tables.unionByName(tiled).where("slide is not null")
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("kind", "file", c)))[c].alias(c)
    return rows.groupBy("slide", "which").agg(last("rigid_D"), last("non_rigid_D"))
