"""From raw documents to packed training sequences, one operator per stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet in the shared folder and reads it back as the next stage's docs, so a lost executor
never costs more than the stage it was in. All stages but the last keep the columns of the
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwise.llm.decontamination import drop_contaminated
from driftwise.llm.near_dedup import keep_one
from driftwise.llm.packing import pack
from driftwise.llm.pii import redact
from driftwise.llm.quality import keep_good
from driftwise.llm.tables import benchmark, documents, tokenizer_path
from driftwise.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return drop_contaminated(docs, benchmark(spark, sf_dir))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences that keep the mixture of sources."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The tokenizer and the alignment of the rewritten text are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
