"""Reading tables and writing layouts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header and a declared schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, spark.checkpoint.dir; on a local master one is set where there is none, else that is an error."""
    if not (at := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.conf.get("spark.master").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="celldex-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")
