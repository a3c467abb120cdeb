"""Registered queries of sharding and packing. SQL has neither the checksum nor the tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwise.llm.packing import pack
from driftwise.llm.sharding import interleaved_shards
from driftwise.llm.tables import documents, tokenizer_path


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved_shards(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
