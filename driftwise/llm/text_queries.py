"""Registered queries that read whole texts and pages. SQL cannot express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwise.llm.archives import archived
from driftwise.llm.extraction import extract_main_text
from driftwise.llm.licenses import scan_licenses
from driftwise.llm.pii import find_personal_data
from driftwise.llm.tables import documents, pages, tokenizer_path
from driftwise.llm.token_counts import token_counts


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))


def extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(pages(spark, sf_dir))


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(pages(spark, sf_dir)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))
