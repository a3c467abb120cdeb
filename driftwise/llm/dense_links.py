"""Exact candidates between sets of different components, by prefix filters.

Sets are sorted by how rare their tokens are. Two sets that are similar enough share a token
among the first ones of both: of the larger set a share of ``1 - t`` has to be looked at, of
the smaller one ``1 - 2t / (1 + t)``. Sizes and the places of the shared token rule out most of
what meets there. A token of all the sets that share a passage stands last in every one of
them, so it is not joined on unless the passage is nearly the whole text.

Where a set holds the token also bounds the sizes of its partners, so tokens are joined
together with a class of sizes: near copies just below the limit meet in no class.

Sets that are connected already never meet: tokens are first joined by the components that
hold them, then by the sets of two different ones. So a group of any size that is one
component costs a row per token and set, and no pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwise.session import stage

#: Sizes of one class differ by this factor at most.
SIZE_STEP = 1.04


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root, set) -> node, root, size, token, pos, short: the first tokens of every set
    that other sets have too; ``short`` marks those that count when the set is the smaller one."""
    tokens = sets.select("node", F.explode("set").alias("token"))
    # tokens of one set only come first and can not be shared: their number is enough
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    ranked = (
        tokens.join(shared, "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("ranked"))
    )
    long_part = F.expr(f"size - ({percent} * size + 99) div 100 + 1")
    short_part = F.expr(f"size - ({2 * percent} * size + {99 + percent}) div {100 + percent} + 1")
    alone = F.col("size") - F.size("ranked")
    return (
        ranked.join(sets.select("node", "root", F.size("set").cast("long").alias("size")), "node")
        .select(
            "node", "root", "size", alone.alias("alone"), short_part.alias("short_part"),
            F.posexplode(F.slice("ranked", F.lit(1), F.greatest(long_part - alone, F.lit(0)).cast("int"))).alias("k", "at"),
        )
        .select(
            "node", "root", "size", "at.token",
            (F.col("k") + F.col("alone")).alias("pos"),
            (F.col("k") + F.col("alone") < F.col("short_part")).alias("short"),
        )
    )


def _size_class(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / math.log(SIZE_STEP)).cast("int")


def cross_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with a < b of distinct nodes with different roots. Every pair whose sets
    reach the similarity is among them."""
    first = stage(prefixes(sets, percent), "prefixes")
    split = first.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    live = stage(first.join(split.where("low <> high").select("token"), "token"), "prefixes-split")
    names = ("node", "root", "size", "pos")
    small = live.where("short").select(
        "token", _size_class(F.col("size")).alias("sizes"), *[F.col(c).alias(f"small_{c}") for c in names]
    )
    # no more than what follows in both can be common: a bound on the size of the smaller set
    least = F.expr(f"({percent} * size + 99) div 100")
    most = F.expr(f"least(size, ({100 + percent} * (size - pos)) div {percent} - size)")
    large = (
        live.withColumn("least", least).withColumn("most", most).where("least <= most")
        .select(
            "token",
            F.explode(F.sequence(_size_class(F.col("least")), _size_class(F.col("most")))).alias("sizes"),
            *[F.col(c).alias(f"large_{c}") for c in names],
        )
    )
    meets = (
        small.select("token", "sizes", "small_root").distinct()
        .join(large.select("token", "sizes", "large_root").distinct(), ["token", "sizes"])
        .where("small_root <> large_root")
    )
    left = F.least(F.col("small_size") - F.col("small_pos"), F.col("large_size") - F.col("large_pos"))
    return (
        small.join(meets, ["token", "sizes", "small_root"])
        .join(large, ["token", "sizes", "large_root"])
        .where("small_size <= large_size")
        .where(100 * F.col("small_size") >= percent * F.col("large_size"))
        .where((100 + percent) * left >= percent * (F.col("small_size") + F.col("large_size")))
        .select(F.least("small_node", "large_node").alias("a"), F.greatest("small_node", "large_node").alias("b"))
        .distinct()
    )
