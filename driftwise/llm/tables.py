"""The given tables, read with only the columns an operator needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwise.session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def unique_key(rows: DataFrame, key: str) -> bool:
    """Whether no key is missing or repeated."""
    repeated = rows.groupBy(key).agg(F.count("*").alias("n"))
    return not repeated.where(F.col(key).isNull() | (F.col("n") > 1)).take(1)


def with_row_key(rows: DataFrame, key: str) -> tuple[DataFrame, str, list[Column]]:
    """Rows with a column that names each of them, its name, and the columns of before.

    Missing or repeated keys cannot name a row: such a table is first written with a number
    for every row, so that a repeated task sees the same numbers. Rows with a key come before
    those without, in the order of their keys.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    if unique_key(rows, key):
        return rows, key, columns
    named = F.struct(F.col(key).isNull(), F.col(key), F.monotonically_increasing_id())
    name = "_row_key"
    while name in rows.columns:
        name += "_"
    return stage(rows.withColumn(name, named), "numbered"), name, columns
