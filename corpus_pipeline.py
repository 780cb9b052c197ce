"""A training corpus from documents: STAGES in order, each on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents.  Duplicates, windows and statistics are judged on a stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celldex.llm.common import fresh, row_key, set_batches, table, written
from celldex.llm.decontamination import decontaminate
from celldex.llm.language_id import with_language
from celldex.llm.line_dedup import line_dedup
from celldex.llm.ngram_join import ngram_join
from celldex.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null too) go, and no others: neither the language nor its score decides, nor whether there are labels."""
    set_batches(spark)  # also where the result is written by the caller
    name, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    return with_language(docs, name, score).where((F.col(name) != "und") | F.col("text").rlike("\\p{L}")).select(*[F.col(f"`{c}`") for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document of which nothing is left goes; n_chars is counted anew."""
    set_batches(spark)  # also where the result is written by the caller
    out = line_dedup(docs.drop("n_lines", "n_removed"))
    left = out.where(F.coalesce(F.col("text") != "", F.lit(True)) | (F.col("n_removed") == 0))
    new = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return left.select(*[new.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 80 % of their shingles of 5 words, the one with the least id stays; those without an id stay.

    Rows are judged by id and text; of those that repeat both, one stays.  Texts of one id that link with each other all stay.
    """
    set_batches(spark)  # also where the result is written by the caller
    key, stay_id, stay_key = (fresh(docs, c) for c in ("row_key", "stay_id", "stay_key"))
    stay = ngram_join(docs, percent=80, shingle=5).where("doc_id is null or doc_id = component_id")
    stay = written(stay.groupBy(F.col("doc_id").alias(stay_id), F.col("key").alias(stay_key)).agg(F.count("*").alias("copies")), "stay")
    rows, one = docs.withColumn(key, row_key()), F.col(stay_id).isNull() | (F.col("copies") == 1)
    of = lambda some: rows.join(some, (F.col(key) == F.col(stay_key)) & F.col("doc_id").eqNullSafe(F.col(stay_id)), "left_semi").drop(key)
    return of(stay.where(one)).unionAll(of(stay.where(~one)).dropDuplicates(["doc_id", "text"]))


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    set_batches(spark)  # also where the result is written by the caller
    key, hit_id, hit_key = (fresh(docs, c) for c in ("row_key", "hit_id", "hit_key"))
    hit = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("doc_id").alias(hit_id), F.col("key").alias(hit_key))
    rows = docs.withColumn(key, row_key())
    return rows.join(hit, (F.col(key) == F.col(hit_key)) & F.col("doc_id").eqNullSafe(F.col(hit_id)), "left_anti").drop(key)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmarks", benchmarks), ("sequences", sequences)]

#: Language prediction and packing are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
