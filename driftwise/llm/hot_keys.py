"""Joins of rows with one row per key, where one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that hold more than this part of the rows are hot; there are at most as many.
HOT_KEYS = 1000


def hot_join(rows: DataFrame, named: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join on ``key``. ``named`` has a row per key and ``n``, the rows it has among the
    ``total``. Hot keys, at most ``HOT_KEYS``, are broadcast, so that their rows stay where they
    are; the rows of the others are shuffled, and no key among them holds a large part."""
    names = [c for c in named.columns if c not in (key, "n")]
    hot = named.where(F.col("n") * HOT_KEYS > total)
    sent = F.broadcast(hot.select(key, F.struct(F.lit(True).alias("hot"), *names).alias("_found")))
    tagged = rows.join(sent, key, "left")
    done = tagged.where("_found IS NOT NULL").select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in names])
    rest = tagged.where("_found IS NULL").drop("_found").join(named.drop("n"), key).select(*rows.columns, *names)
    return done.unionByName(rest)
