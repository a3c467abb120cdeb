"""Bootstrap and jitter, each a function of (seed, key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwise.functions.hashing import order_hash, standard_normal, uniform
from driftwise.operators.profile import long_rows, quoted


def number_rows(df: DataFrame, key: str, seed: int | str, name: str = "row_number", digits: int = 4) -> DataFrame:
    """Dense 1..N in hash order. Each hash prefix is numbered on its own and shifted by
    the count of the prefixes before it, so no task sees more than 1/16^digits of the rows."""
    hashed = order_hash(seed, key)
    rows = df.withColumns({"_hash": hashed, "_prefix": F.substring(hashed, 1, digits)})
    counts = df.groupBy(F.substring(hashed, 1, digits).alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    # At most 16^digits rows: one small window and one small broadcast.
    ahead = Window.partitionBy(F.lit(0)).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_prefix", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_prefix").orderBy("_hash", key)
    return (
        rows.join(F.broadcast(starts), "_prefix")
        .withColumn(name, F.row_number().over(inside) + F.col("_start"))
        .drop("_hash", "_prefix", "_start")
    )


def bootstrap(df: DataFrame, n: int, key: str, seed: int | str, draw: str = "draw") -> DataFrame:
    """Exactly n rows drawn uniformly with replacement, numbered 0..n-1; n may exceed the table."""
    total = df.count()
    if total == 0:
        raise ValueError("cannot draw from an empty table")
    picked = F.least(F.floor(uniform(f"{seed}:draw", draw, digits=13) * F.lit(float(total))).cast("long"), F.lit(total - 1)) + 1
    draws = df.sparkSession.range(n).withColumnRenamed("id", draw).select(draw, picked.alias("_row"))
    return draws.join(number_rows(df, key, seed, "_row"), "_row").drop("_row")


def noise_scale_table(df: DataFrame, columns: list[str], share: float = 0.1, fallback: float = 0.05) -> DataFrame:
    """(column, scale): a share of the sample deviation, or of 5% of the mean where that is 0 or missing."""
    present = [c for c in columns if c in df.columns]
    stats = df.agg(
        *[F.struct(F.stddev_samp(quoted(c)).alias("sd"), F.avg(quoted(c)).alias("mean")).alias(f"s{i}") for i, c in enumerate(present)]
    )

    def scale(i: int) -> Column:
        sd, mean = F.col(f"s{i}")["sd"], F.col(f"s{i}")["mean"]
        return F.when(sd.isNull() | (sd == 0), F.lit(fallback) * F.abs(mean)).otherwise(sd) * F.lit(share)

    return long_rows(stats, [F.struct(F.lit(c).alias("column"), scale(i).alias("scale")) for i, c in enumerate(present)])


def noise_scales(df: DataFrame, columns: list[str]) -> dict[str, float]:
    return {r["column"]: r["scale"] or 0.0 for r in noise_scale_table(df, columns).collect()}


def floored(x: Column, name: str, substrings: Sequence[str]) -> Column:
    """Floor at 0 only if the column's name holds one of the substrings (case-sensitive)."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x) if any(s in name for s in substrings) else x


def jitter(df: DataFrame, scales: dict[str, float], key: str, seed: int | str, floor_names: Sequence[str] = ()) -> DataFrame:
    """Add independent Gaussian noise per column; missing stays missing."""
    return df.withColumns(
        {
            c: floored(quoted(c) + F.lit(scale) * standard_normal(f"{seed}:{c}", key), c, floor_names)
            for c, scale in scales.items()
            if c in df.columns
        }
    )
