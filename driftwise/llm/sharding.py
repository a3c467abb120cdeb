"""Proportional stratified interleaving: shards of equal row counts that all match the mixture.

Rows of each source are ranked in a seeded shuffle and get the fractional rank
``(rank - 1 + phase) / rows of the source``; the phase is a hash of the source, so that
sources of a single row do not all meet in the middle. Sorted by that fraction the sources
interleave evenly, and equal cuts give shards whose counts differ by at most one and whose
share of any source is off by about one row.

Nothing is sorted in one task: ranks come from small slices (of the shuffle order inside a
source, then of the fraction) plus the totals of the slices before, so one source may hold
any share of the rows.

Defined results: null text has size 1 and the checksum of nothing; a null source is a source
of its own; a null id is allowed; repeated rows get slots of their own; an empty table gives
empty shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwise.session import stage

SLICE_ROWS = 10_000


def _ranked(rows: DataFrame, keys: list[str], piece: Column, order: list[str], name: str):
    """Adds the 0-based rank by (piece, order) inside ``keys`` and the rows of each key."""
    cut = rows.withColumn("_piece", piece)
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
    totals = cut.groupBy(*keys, "_piece").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = totals.select(
        *keys,
        "_piece",
        (F.sum("_rows").over(whole.orderBy("_piece")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).alias(f"{name}_rows"),
    )
    return (
        cut.withColumn("_place", F.row_number().over(inside) - 1)
        .join(before, [*keys, "_piece"])
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_piece", "_place", "_before")
    )


def interleaved_shards(
    documents: DataFrame,
    shards: int = 16,
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and slot of every row."""
    rows = stage(
        documents.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        ),
        "shard-rows",
    ).select(
        "*",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_queue"),
        F.xxhash64(F.lit(seed), "doc_id", "text_crc32").alias("_shuffled"),
    )
    n = rows.count()
    slices = max(1, -(-n // slice_rows))
    order = ["_shuffled", "doc_id", "text_crc32"]
    # The shuffled order read as a fraction of the whole range of the hash.
    part = F.floor((F.col("_shuffled") / F.lit(2.0**64) + F.lit(0.5)) * slices)
    ranked = _ranked(rows, ["_queue"], part, order, "_rank")
    phase = F.pmod(F.xxhash64(F.lit(seed + 1), "_queue"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    spread = ranked.withColumn("_at", (F.col("_rank") + phase) / F.col("_rank_rows"))
    placed = _ranked(spread, [], F.floor(F.col("_at") * slices), ["_at", *order], "_position")
    small, larger = divmod(n, shards)
    edge = larger * (small + 1)
    position = F.col("_position")
    shard = F.when(position < edge, F.floor(position / (small + 1))).otherwise(
        larger + F.floor((position - edge) / max(small, 1))
    )
    start = F.col("shard") * small + F.least(F.col("shard"), F.lit(larger))
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "source", "size", "text_crc32", "shard", (position - start).alias("slot")
    )
