"""Impute, derive, scale, reduce, encode and bin.

Each step is fitted on one table and applied to another as plain projections:
fit on training rows only, then reuse the same few parameters on test rows, new
rows or a stream.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA as VectorPCA
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwise.operators.profile import balanced_sum, modes, quoted
from driftwise.operators.quantiles import SMALL, exact_quantiles, medians

MAX_LEVELS = 2000


@dataclass(frozen=True)
class Imputer:
    """Global median for numbers, most frequent value (ties: smallest) for the rest."""

    medians: dict[str, float]
    modes: dict[str, str]

    @classmethod
    def fit(cls, df: DataFrame, numbers: list[str], strings: list[str], small: int = SMALL) -> Imputer:
        middle = medians(df, numbers, small) if numbers else {}
        tops = {r["column"]: r["top"] for r in modes(df, strings).collect()} if strings else {}
        empty = [c for c in numbers if middle[c] is None] + [c for c in strings if c not in tops]
        if empty:
            raise ValueError(f"no value to impute from in {', '.join(empty)}")
        return cls(middle, tops)

    def transform(self, df: DataFrame) -> DataFrame:
        """Imputed numbers become doubles."""
        filled = {c: F.coalesce(quoted(c).cast("double"), F.lit(v)) for c, v in self.medians.items()}
        filled |= {c: F.coalesce(quoted(c), F.lit(v)) for c, v in self.modes.items()}
        return df.withColumns(filled) if filled else df


def _moments(df: DataFrame, columns: list[str]) -> list:
    """(column, n, mean, squares, low, high) of known values, squares about the mean; columns by
    position. Tasks add up batches with NumPy, and their rows meet in one sum per column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for i, column in enumerate(batch.columns):
                x = column.drop_null().to_numpy(zero_copy_only=False)
                if not len(x):
                    continue
                n, mean = len(x), float(x.mean())
                squares, low, high = float(((x - mean) ** 2).sum()), float(np.fmin.reduce(x)), float(x.max())
                if i in held:
                    n0, mean0, squares0, low0, high0 = held[i]
                    apart = mean - mean0
                    squares += squares0 + apart * apart * n0 * n / (n0 + n)
                    mean = mean0 + apart * n / (n0 + n)
                    n, low, high = n + n0, float(np.fmin(low, low0)), float(np.maximum(high, high0))
                held[i] = n, mean, squares, low, high
        if held:
            names = ("n", "mean", "squares", "low", "high")
            yield pa.RecordBatch.from_pydict({"column": pa.array(list(held), pa.int32())} | dict(zip(names, map(list, zip(*held.values())))))

    numbers = df.select(*[quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    parts = numbers.mapInArrow(run, "column int, n long, mean double, squares double, low double, high double")
    # One row per task and column; the mean of all comes first, so that squares are added about it.
    own = Window.partitionBy("column")
    every = parts.withColumn("whole", F.sum(F.col("n") * F.col("mean")).over(own) / F.sum("n").over(own))
    apart = F.col("mean") - F.col("whole")
    met = every.groupBy("column", F.col("whole").alias("mean")).agg(
        F.sum("n").alias("n"), F.sum(F.col("squares") + F.col("n") * apart * apart).alias("squares"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    return met.collect()


@dataclass(frozen=True)
class Standardizer:
    """Zero mean, unit population deviation; a constant column becomes 0."""

    means: dict[str, float]
    deviations: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> Standardizer:
        found = {r["column"]: r for r in _moments(df, columns)}

        def of(i: int) -> tuple[float | None, float | None]:
            r = found.get(i)
            if r is None:
                return None, None
            # Sums leave a constant column a tiny deviation; its range is exact. NaN is the greatest number.
            same = r["low"] == r["high"] or math.isnan(r["low"])
            return r["mean"], 0.0 if same else math.sqrt(r["squares"] / r["n"])

        fitted = {c: of(i) for i, c in enumerate(columns)}
        return cls({c: m for c, (m, _) in fitted.items()}, {c: s for c, (_, s) in fitted.items()})

    def scaled(self, column: str) -> Column:
        mean, deviation = self.means[column], self.deviations[column]
        if not deviation:
            return F.when(quoted(column).isNotNull(), F.lit(0.0))
        return (quoted(column) - F.lit(mean)) / F.lit(deviation)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.scaled(c) for c in self.means})


@dataclass(frozen=True)
class PrincipalComponents:
    """Leading components of standardized columns, as weights per column."""

    scaler: Standardizer
    columns: list[str]
    loadings: list[list[float]]
    explained: list[float]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], k: int = 2) -> PrincipalComponents:
        scaler = Standardizer.fit(df, columns)
        vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(len(columns))], outputCol="x").transform(
            df.select(*[scaler.scaled(c).alias(f"x{i}") for i, c in enumerate(columns)])
        )
        model = VectorPCA(k=k, inputCol="x", outputCol="y").fit(vectors.select("x"))
        weights = model.pc.toArray().T
        # Signs are arbitrary; the largest weight of each component is made positive.
        signed = [w * np.sign(w[np.argmax(np.abs(w))]) for w in weights]
        return cls(scaler, list(columns), [list(map(float, w)) for w in signed], [float(v) for v in model.explainedVariance])

    def transform(self, df: DataFrame, prefix: str = "pca_comp") -> DataFrame:
        return df.withColumns(
            {
                f"{prefix}{i + 1}": balanced_sum([F.lit(w) * self.scaler.scaled(c) for c, w in zip(self.columns, weights)])
                for i, weights in enumerate(self.loadings)
            }
        )


def levels(df: DataFrame, columns: list[str], limit: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct values per column; every level becomes a column, so many are refused."""
    # The estimate, 5% off at most places, only keeps huge sets from being gathered; the limit is exact.
    sizes = df.agg(*[F.approx_count_distinct(quoted(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    wide = [c for c, n in zip(columns, sizes) if n > 2 * limit]
    if not wide:
        sets = df.agg(*[F.collect_set(quoted(c)).alias(f"s{i}") for i, c in enumerate(columns)]).first()
        wide = [c for c, s in zip(columns, sets) if len(s) > limit]
    if wide:
        raise ValueError(f"more than {limit} levels in {', '.join(wide)}; sparse.LevelIndex takes any number")
    return {c: sorted(s) for c, s in zip(columns, sets)}


@dataclass(frozen=True)
class OneHot:
    """Boolean column per level but the first; a missing value is false everywhere."""

    levels: dict[str, list[str]]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], limit: int = MAX_LEVELS) -> OneHot:
        return cls(levels(df, columns, limit) if columns else {})

    def names(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.levels.items() for v in vs[1:]]

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [quoted(c) for c in df.columns if c not in self.levels]
        flags = [quoted(c).eqNullSafe(F.lit(v)).alias(f"{c}_{v}") for c, vs in self.levels.items() for v in vs[1:]]
        return df.select(*kept, *flags)


def label_code(label: str | Column, classes: list[str]) -> Column:
    """Position of a label among the sorted classes."""
    label = F.col(label) if isinstance(label, str) else label
    code = F.lit(None).cast("int")
    for i, c in enumerate(sorted(classes)):
        code = F.when(label == c, F.lit(i)).otherwise(code)
    return code


def code_label(code: str | Column, classes: list[str]) -> Column:
    code = F.col(code) if isinstance(code, str) else code
    return F.get(F.array(*[F.lit(c) for c in sorted(classes)]), code.cast("int"))


def quantile_edges(df: DataFrame, column: str, q: int, small: int = SMALL) -> list[float]:
    edges = exact_quantiles(df, [column], [i / q for i in range(q + 1)], small)[column]
    if None in edges or len(set(edges)) < len(edges):
        raise ValueError(f"quantile edges of {column} are not distinct: {edges}")
    return edges


def quantile_bin(column: str | Column, edges: list[float], labels: list) -> Column:
    """Label of the (low, high] bin; the lowest value belongs to the first bin."""
    x = F.col(column) if isinstance(column, str) else column
    label = F.when((x > edges[-2]) & (x <= edges[-1]), labels[-1])
    for high, low, name in reversed(list(zip(edges[1:-1], edges[:-2], labels[:-1]))):
        inside = (x >= low) if low == edges[0] else (x > low)
        label = F.when(inside & (x <= high), name).otherwise(label)
    return label
