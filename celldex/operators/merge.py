"""Merging tables: winning columns, upserts, outer unions, positivity, first claims and prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def merge_last_wins(base: DataFrame, files: list[DataFrame], label: str, protected: tuple[str, ...] = ()) -> DataFrame:
    """base with each measured column of the last file that has it, whole; labels a winner lacks are NULL.

    Columns of base in `protected`, and the label, are never replaced.
    """
    winner: dict[str, int] = {}
    for i, f in enumerate(files):
        winner |= {c: i for c in f.columns if c != label and c not in protected}
    out = base.drop(*[c for c in winner if c in base.columns])
    for i, f in enumerate(files):
        own = [c for c, w in winner.items() if w == i]
        if own:
            out = out.join(f.select(label, *own), label, "left")
    return out


def upsert(prior: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows of new, and the rows of prior whose key new lacks."""
    return new.unionByName(prior.join(new.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def outer_union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def first_claim(rows: DataFrame, claim: list[str], order: list[str]) -> DataFrame:
    """The first row of each claim; a grouped minimum, so repeated claims are combined before the shuffle."""
    rest = [c for c in rows.columns if c not in claim and c not in order]
    got = rows.groupBy(*claim).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return got.select(*claim, *[F.col(f"_first.{c}").alias(c) for c in [*order, *rest]])


def positivity(cells: DataFrame, signs: DataFrame, key: str, sign: Column) -> DataFrame:
    """cells with positive (false where unmatched) and phenotype ("unclassified" where unmatched)."""
    got = signs.select(key, sign.alias("_sign"))
    known = F.col("_sign").isNotNull()
    return cells.join(got, key, "left").select(*cells.columns, F.coalesce(F.trim("_sign") == "+", F.lit(False)).alias("positive"), F.when(known, F.lit("classified")).otherwise("unclassified").alias("phenotype"))


def prefix_join(tags: DataFrame, sizes: DataFrame, by: str, tag: str, name: str, size: str, order: str) -> DataFrame:
    """tags (by, tag) with the size of the name of the same `by` that equals the tag, else of the first name, in
    order, with which the tag and a "_" begin; NULL without one.

    A tag's own beginnings are looked up, so this is an equi-join.
    """
    head = F.filter(F.transform(F.sequence(F.lit(1), F.length(tag)), lambda i: F.when((i == F.length(tag)) | (F.substr(F.col(tag), i + 1, F.lit(1)) == "_"), F.substr(F.col(tag), F.lit(1), i))), lambda x: x.isNotNull())
    tried = tags.select(by, tag, F.explode(head).alias(name)).distinct()
    best = tried.join(sizes.where(F.col(name) != ""), [by, name]).groupBy(by, tag).agg(F.min(F.struct(F.col(name) != F.col(tag), order, size)).alias("_best"))
    return tags.join(best, [by, tag], "left").withColumn(size, F.col(f"_best.{size}")).drop("_best")


def islands(rows: DataFrame, group: str, value: str, share: float) -> DataFrame:
    """Runs of sorted values of which each is at most `share` of its forerunner above it: group, island (from 0), n, lo, hi."""
    w = Window.partitionBy(group).orderBy(value)
    before = F.lag(value).over(w)
    start = F.when(F.col(value) - before > share * F.abs(before), 1).otherwise(0)
    runs = rows.select(group, value, start.alias("s")).withColumn("island", F.sum("s").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(group, "island").agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))


def latest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """Of each key the row that comes last in order."""
    rest = [c for c in rows.columns if c not in key]
    got = rows.groupBy(*key).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("_last"))
    return got.select(*key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def attach(left: DataFrame, right: DataFrame, key: str, order: str, last: bool) -> DataFrame:
    """left with right's columns by key; of right's rows with one key the last, or else the first, in order."""
    one = latest(right, [key], order) if last else first_claim(right, [key], [order])
    return left.join(one.drop(order), key, "left")


def attach_all_or_fail(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """`attach` of first rows; an error if no row of left finds one."""
    if left.join(right.select(key), key, "left_semi").isEmpty() and not left.isEmpty():
        raise ValueError(f"no row has a partner by {key}")
    return attach(left, right, key, order, last=False)


def join_all(frames: list[DataFrame], key: list[str]) -> DataFrame:
    """The rows of keys that all frames have."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key)
    return out


def join_or(left: DataFrame, right: DataFrame, key: list[str], other: dict[str, object]) -> DataFrame:
    """All rows of left; `other` has what columns of right get where right has no row."""
    got = left.join(right, key, "left")
    return got.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in other.items()})


def cohort(frames: list[DataFrame]) -> DataFrame:
    """`outer_union` of the frames with `sample`: s0, s1, ...; a frame by itself as it is."""
    return frames[0] if len(frames) == 1 else outer_union(*[f.withColumn("sample", F.lit(f"s{i}")) for i, f in enumerate(frames)])


def by_priority(rows: DataFrame, key: list[str], priority: str) -> DataFrame:
    """Of each key the row of least priority."""
    return first_claim(rows, key, [priority])


def flat_metrics(docs: DataFrame, key: str, metrics: str) -> DataFrame:
    """key, name ("group::metric"), value of nested metrics (a map of maps), one row each."""
    groups = docs.select(key, F.explode(metrics).alias("group", "inner"))
    return groups.select(key, "group", F.explode("inner").alias("metric", "value")).select(key, F.concat_ws("::", "group", "metric").alias("name"), "value")


def unconsumed(known: DataFrame, consumed: DataFrame) -> DataFrame:
    """Distinct rows of known that consumed lacks; empty if all is well."""
    return known.subtract(consumed.select(*known.columns))


def marker_tables(spark: SparkSession, files: list[str] | None = None, folder: str | None = None, key: str = "label") -> list[tuple[str, DataFrame]]:
    """Name and table (the key as a long, the rest as doubles) of the CSV files named, or else of a folder's *_quant.csv by name; an error without any."""
    if not files:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*_quant.csv").load(folder).select("path").orderBy("path").collect() if folder else []
        files = [r["path"] for r in listed]  # a name a marker
    if not files:
        raise ValueError("no tables of markers")
    out = []
    for f in files:
        names = spark.read.option("header", True).csv(f).columns
        out.append((f, spark.read.schema(", ".join(f"`{c}` {'long' if c == key else 'double'}" for c in names)).option("header", True).csv(f)))
    return out


def merged_markers(base: DataFrame, tables: list[tuple[str, DataFrame]], key: str = "label", protected: tuple[str, ...] = ()) -> DataFrame:
    """base with the columns of each table, later ones over earlier ones and base's, but for those protected (`merge_last_wins`)."""
    return merge_last_wins(base, [t for _, t in tables], key, protected=protected)
