"""Sample sheets and labels: dense labels, agreement, references, problems, pairing by signature."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import shared_dir


def dense_labels(rows: DataFrame, label: str) -> DataFrame:
    """rows with label replaced, in a column of that name, by its place (from 1) among the distinct labels in order; NULL and 0 stay.

    Distinct labels are cut in ranges, numbered within each, and ranges get offsets from their sizes, so
    no task sees all labels.  The ranges are a table, as cutting them again could give others.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/celldex/ranges-{uuid.uuid4().hex}"
    cut = rows.where(F.col(label) != 0).select(F.col(label).alias("_old")).distinct().repartitionByRange("_old")
    cut.select("_old", F.spark_partition_id().alias("_range")).write.parquet(path)
    cut = spark.read.parquet(path)
    sizes = cut.groupBy("_range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_old"))
    new = cut.withColumn("_at", place).join(F.broadcast(sizes.select("_range", before.alias("_before"))), "_range").select("_old", (F.col("_at") + F.col("_before")).alias("label"))
    out = rows.withColumnRenamed(label, "_was") if label == "label" else rows.withColumn("_was", F.col(label))
    named = out.where("_was <> 0").join(new, F.col("_was") == F.col("_old")).drop("_old")
    rest = out.where("not coalesce(_was <> 0, false)").withColumn("label", F.when(F.col("_was") == 0, F.lit(0)))  # not joined, so background is no hot key
    return named.unionByName(rest).drop("_was")


def agreement(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """missing (only in a), extra (only in b) and both: counts of distinct labels, from one grouping."""
    ends = a.select(F.col(a_key).alias("k"), F.lit(1).alias("side")).unionAll(b.select(F.col(b_key).alias("k"), F.lit(2).alias("side")))
    by = ends.groupBy("k").agg(F.bit_or("side").alias("side"))
    return by.agg(*[F.count_if(F.col("side") == v).alias(c) for c, v in (("missing", 1), ("extra", 2), ("both", 3))])


def reference_rows(rows: DataFrame, group: str, order: list[str], flag: Column) -> DataFrame:
    """rows with row_index (from 0, in order) and is_reference: the first flagged row in order; without one, none is."""
    w = Window.partitionBy(group).orderBy(*order)
    nth = F.sum(F.when(flag, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"row_index": (F.row_number().over(w) - 1).cast("long"), "is_reference": F.coalesce(flag, F.lit(False)) & (nth == 1)})


def problems(rows: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """key, problem: a row for each rule that a row breaks; a rule that is NULL isn't broken."""
    broken = F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    return rows.select(*key, F.explode(broken).alias("problem"))


def signature(channels: Column) -> Column:
    """Lower-case channel names in order, joined by "|"."""
    return F.array_join(F.array_sort(F.transform(channels, F.lower)), "|")


def pair_by_signature(slides: DataFrame, files: DataFrame) -> DataFrame:
    """slide, file of equal signature; both have `name` and `channels`.  Raises unless that is one to one."""
    ends = slides.select(signature(F.col("channels")).alias("sig"), F.col("name").alias("slide"), F.lit(None).cast("string").alias("file"))
    ends = ends.unionByName(files.select(signature(F.col("channels")).alias("sig"), F.lit(None).cast("string").alias("slide"), F.col("name").alias("file")))
    by = ends.groupBy("sig").agg(F.count("slide").alias("a"), F.count("file").alias("b"), F.min("slide").alias("slide"), F.min("file").alias("file"))
    wrong = by.where("a <> 1 or b <> 1").orderBy("sig").head()
    if wrong:
        raise ValueError(f"signature {wrong['sig']!r} has {wrong['a']} slides and {wrong['b']} files")
    return by.select("slide", "file")
