"""The queries opN_<name> and pipeline, over the whole of their tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import written
    from .neighbours import nearest, usable

    vectors = written(usable(table(spark, sf_dir, "embeddings")), "vectors")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_join

    return ngram_join(table(spark, sf_dir, "documents"), percent=90, shingle=3).drop("key")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import known, license_scan

    return license_scan(table(spark, sf_dir, "documents"), known(spark))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_alignment import token_alignment

    return token_alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import hard_negatives

    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_rules import url_filter

    return url_filter(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from . import decontamination, hard_negatives, licenses, url_rules

    return {
        "op6_license_scan": licenses.oracle(),
        "op9_decontamination": decontamination.ORACLE,
        "op12_hard_negatives": hard_negatives.ORACLE,
        "op13_url_filters": url_rules.ORACLE,
    }
