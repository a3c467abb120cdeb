"""Cut a table into ranges of similar size, for work that needs an order but no single task."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_RANGES = 20_000

#: Stands for a missing value: below every other.
LOWEST = -(2.0**1000)


def default_ranges(df: DataFrame) -> int:
    """A few ranges per shuffle partition, so that ranges spread evenly over tasks."""
    return min(MAX_RANGES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def range_edges(df: DataFrame, column: str, ranges: int) -> list[float]:
    """Interior edges with about equally many rows between them, from one mergeable sketch."""
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    found = df.agg(F.percentile_approx(column, shares, max(10_000, 5 * ranges))).first()[0] or []
    return sorted(set(map(float, found)))


def with_range(df: DataFrame, column: str, edges: list[float], name: str) -> DataFrame:
    """Number of the range each value falls into, ascending."""
    if not edges:
        return df.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=name).transform(df)


def _edges_with_hot(df: DataFrame, column: str, ranges: int) -> tuple[list[float], list[float]]:
    """Interior edges, and the values that hold a whole range or more by themselves. Such a
    value gets a range of its own, from it to the next number."""
    shares = [i / ranges for i in range(1, ranges)]
    found = (df.agg(F.percentile_approx(column, shares, max(10_000, 5 * ranges))).first()[0] or []) if shares else []
    edges = list(map(float, found))
    hot = sorted({e for e in edges if edges.count(e) > 1})
    return sorted({*edges, *(math.nextafter(e, math.inf) for e in hot)}), hot


def with_ordered_range(df: DataFrame, value: str, tie: str, name: str, ranges: int | None = None) -> DataFrame:
    """Number of a range in the order of (value, tie), missing ones first.

    A value that many rows share is cut further by ``tie``, so no value, missing or not, can
    fill a range. ``value`` must be a double and ``tie`` a number; rows that agree in both
    stay together.
    """
    ranges = ranges or default_ranges(df)
    filled = df.withColumns(
        {"_value": F.coalesce(value, F.lit(LOWEST)), "_tie": F.coalesce(F.col(tie).cast("double"), F.lit(LOWEST))}
    )
    edges, hot = _edges_with_hot(filled, "_value", ranges)
    ranged = with_range(filled, "_value", edges, "_first")
    if not hot:
        return ranged.withColumn(name, F.col("_first").cast("long")).drop("_value", "_tie", "_first")
    is_hot = F.array_contains(F.array(*[F.lit(h) for h in hot]), F.col("_value"))
    ties, _ = _edges_with_hot(filled.where(is_hot), "_tie", ranges)
    cut = with_range(ranged, "_tie", ties, "_second")
    second = F.when(is_hot, F.col("_second")).otherwise(0.0)
    # there are fewer tie ranges than twice MAX_RANGES
    return cut.withColumn(name, (F.col("_first") * (2 * MAX_RANGES) + second).cast("long")).drop(
        "_value", "_tie", "_first", "_second"
    )


def with_rank(df: DataFrame, value: str, tie: str, name: str, total: str, ranges: int | None = None) -> DataFrame:
    """1-based rank in the order of (value, tie) and the number of rows, without one task for all.

    Rows are numbered inside their range and shifted by the rows of the ranges before, a
    table of one row per range.
    """
    rows = with_ordered_range(df, value, tie, "_range", ranges)
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    every = Window.partitionBy(F.lit(0))
    starts = counts.select(
        "_range",
        (F.sum("_n").over(every.orderBy("_range")) - F.col("_n")).alias("_start"),
        F.sum("_n").over(every).alias(total),
    )
    inside = Window.partitionBy("_range").orderBy(value, tie)
    return (
        rows.withColumn("_place", F.row_number().over(inside))
        .join(starts, "_range")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_range", "_place", "_start")
    )
