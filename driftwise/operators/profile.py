"""Column profiles, missing counts, shares, segment means and histograms.

Wide tables are profiled with one aggregate row and laid out long afterwards, so
the number of columns does not multiply the rows that flow through the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from driftwise.operators.quantiles import SMALL, exact_quantiles


def quoted(name: str) -> Column:
    """Column by its literal name; encoded names may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def balanced_sum(terms: list[Column]) -> Column:
    """Sum of many terms as a tree, whose depth stays small."""
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def other_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType) and f.name not in exclude]


def long_rows(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn columns of a one-row table into rows."""
    return one_row.select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) over several string columns; missing values are left out."""
    values = df.select(*[quoted(c).cast("string").alias(c) for c in columns])
    return (
        values.unpivot([], [quoted(c) for c in columns], "column", "value")
        .filter("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, unique, top, freq): most frequent value, ties to the smallest."""
    first = F.min(F.struct((-F.col("n")).alias("n"), "value"))
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), first.alias("_first"))
        .select("column", "count", "unique", F.col("_first.value").alias("top"), (-F.col("_first.n")).alias("freq"))
    )


def profile(df: DataFrame, small: int = SMALL) -> DataFrame:
    """One row per column: counts for all, top value for strings, moments and quartiles for numbers."""
    numbers, strings = numeric_columns(df), other_columns(df)
    parts = []
    if numbers:
        quartiles = exact_quantiles(df, numbers, [0.25, 0.5, 0.75], small)
        stats = []
        for i, c in enumerate(numbers):
            x = quoted(c).cast("double")
            stats.append(
                F.struct(
                    F.count(quoted(c)).alias("count"),
                    F.avg(x).alias("mean"),
                    F.stddev_samp(x).alias("std"),
                    F.min(x).alias("min"),
                    F.max(x).alias("max"),
                ).alias(f"s{i}")
            )
        rows = [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"s{i}")["count"].alias("count"),
                F.lit(None).cast("long").alias("unique"),
                F.lit(None).cast("string").alias("top"),
                F.lit(None).cast("long").alias("freq"),
                F.col(f"s{i}")["mean"].alias("mean"),
                F.col(f"s{i}")["std"].alias("std"),
                F.col(f"s{i}")["min"].alias("min"),
                *[F.lit(q).cast("double").alias(name) for q, name in zip(quartiles[c], ("q25", "q50", "q75"))],
                F.col(f"s{i}")["max"].alias("max"),
            )
            for i, c in enumerate(numbers)
        ]
        parts.append(long_rows(df.agg(*stats), rows))
    if strings:
        blank = [F.lit(None).cast("double").alias(n) for n in ("mean", "std", "min", "q25", "q50", "q75", "max")]
        # An all-missing string column still gets its row, with count 0.
        empty = df.sparkSession.createDataFrame([(c,) for c in strings], "column string")
        found = empty.join(modes(df, strings), "column", "left")
        parts.append(
            found.select(
                "column", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("count", "unique")], "top", "freq", *blank
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing) for the columns that have any."""
    counts = df.agg(*[F.count(F.when(quoted(c).isNull(), 1)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("missing")) for i, c in enumerate(df.columns)]
    return long_rows(counts, rows).filter("missing > 0")


def class_share(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share), missing labels left out."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per label remains, so the total needs no partitioning.
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def mean_by_segment(df: DataFrame, segment: str | Column, value: Column, name: str = "mean_value") -> DataFrame:
    segment = F.col(segment) if isinstance(segment, str) else segment
    return df.groupBy(segment.alias("segment")).agg(F.count(value).alias("n"), F.avg(value).alias(name))


def value_range(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    ends = [F.struct(F.min(quoted(c)).cast("double").alias("lo"), F.max(quoted(c)).cast("double").alias("hi")) for c in columns]
    row = df.agg(*[e.alias(f"r{i}") for i, e in enumerate(ends)]).first()
    return {c: (r["lo"], r["hi"]) for c, r in zip(columns, row)}


def grid_cell(x: str | Column, low: float, high: float, cells: int) -> Column:
    """Equal-width cell 0..cells-1; the last one includes its upper end."""
    x = quoted(x) if isinstance(x, str) else x
    if high == low:
        return F.when(x.isNotNull(), F.lit(0))
    return F.least(F.floor((x - F.lit(low)) / F.lit(high - low) * F.lit(float(cells))).cast("int"), F.lit(cells - 1))


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """(bin, low, high, n) for the bins that hold rows."""
    low, high = value_range(df, [column])[column]
    width = (high - low) / bins
    return (
        df.filter(quoted(column).isNotNull())
        .groupBy(grid_cell(column, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"), (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"), "n"
        )
    )
