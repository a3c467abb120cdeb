"""Encoding and linear fits of tables with very many columns, as sparse rows.

A sparse row is a struct (indices, values); its width p is known to the encoder. What the driver
and the tasks hold are blocks of p rows and a few columns, never p x p; a block is refused above
``BLOCK_BYTES``. Each step of a fit is one aggregate over all rows: a task adds up its part of
X'(XB) with NumPy on Arrow batches, and the parts meet in a sum per column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.operators.profile import quoted, value_counts
from driftwise.operators.resample import number_rows
from driftwise.session import stage

#: A dictionary up to this size is broadcast whole; beyond it only its frequent levels are.
SMALL_LEVELS, SMALL_BYTES = 200_000, 16 << 20
#: Levels that hold more than this share of the rows are joined where the rows lie.
FREQUENT = 1 / 1000
#: Largest block of p rows a fit may hold.
BLOCK_BYTES = 512 << 20


@dataclass(frozen=True)
class LevelIndex:
    """Places of all levels of all columns in one sparse row.

    The smallest level of a column has no place, nor has a missing or unseen value: such a row
    has nothing there. Places 0..size-1 follow a hash of (column, level), so they do not depend on
    how the table is cut. Any number of levels can be fitted; the dictionary is a staged table.
    """

    table: DataFrame  # column, value, n, place
    columns: list[str]
    size: int
    rows: int
    small: bool

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], small: int = SMALL_LEVELS) -> LevelIndex:
        counted = stage(value_counts(df, columns), "level-counts")
        # One row per column.
        first = F.broadcast(counted.groupBy("column").agg(F.min("value").alias("_first")))
        placed = counted.join(first, "column").filter("value != _first").drop("_first")
        named = placed.withColumn("_name", F.concat_ws("=", "column", "value"))
        table = stage(
            number_rows(named, "_name", "levels", "_number").select("column", "value", "n", (F.col("_number") - 1).cast("int").alias("place")),
            "levels",
        )
        found = table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("bytes")).first()
        most = counted.groupBy("column").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        return cls(table, list(columns), found["n"], most, found["n"] <= small and (found["bytes"] or 0) <= SMALL_BYTES)

    def _place(self, df: DataFrame, column: str, name: str) -> DataFrame:
        levels = self.table.filter(F.col("column") == column).select(F.col("value").alias("_value"), F.col("place").alias(name), "n")
        value = quoted(column).cast("string")
        if self.small:
            return df.join(F.broadcast(levels.drop("n")), value == F.col("_value"), "left").drop("_value")
        # At most 1 / FREQUENT levels; their rows, and those without a value, are spread by the
        # hash of the whole row in the join of all others.
        often = F.broadcast(levels.filter(F.col("n") > FREQUENT * self.rows).drop("n").withColumnsRenamed({name: "_often"}))
        spread = F.xxhash64(*[quoted(c) for c in df.columns])
        known = df.join(often, value == F.col("_value"), "left").drop("_value")
        settled = F.col("_often").isNotNull() | value.isNull()
        keyed = known.withColumns({"_key": F.when(~settled, value), "_salt": F.when(settled, spread).otherwise(F.lit(0))})
        rare = levels.filter(F.col("n") <= FREQUENT * self.rows).select("_value", name, F.lit(0).cast("long").alias("_zero"))
        met = F.coalesce("_key", F.lit("")).eqNullSafe(F.col("_value")) & (F.col("_salt") == F.col("_zero")) & F.col("_key").isNotNull()
        return (
            keyed.join(rare, met, "left")
            .withColumn(name, F.coalesce("_often", name))
            .drop("_often", "_key", "_salt", "_value", "_zero")
        )

    def transform(self, df: DataFrame, name: str = "encoded") -> DataFrame:
        """Append the sparse row of the encoded columns."""
        places = [f"_place{i}" for i in range(len(self.columns))]
        out = df
        for column, place in zip(self.columns, places):
            out = self._place(out, column, place)
        indices = F.sort_array(F.array_compact(F.array(*[F.col(p) for p in places])))
        return out.withColumn("_indices", indices).select(
            *[quoted(c) for c in df.columns],
            F.struct(F.col("_indices").alias("indices"), F.array_repeat(F.lit(1.0), F.size("_indices")).alias("values")).alias(name),
        )


def sparse_row(numbers: Sequence[str | Column], encoded: str | None = None, size: int = 0) -> Column:
    """Sparse row of number columns at places size, size + 1, ... behind an encoded one; missing is 0."""
    given = [quoted(c) if isinstance(c, str) else c for c in numbers]
    filled = [F.coalesce(c.cast("double"), F.lit(0.0)) for c in given]
    places = F.array(*[F.lit(size + i) for i in range(len(given))]).cast("array<int>")
    values = F.array(*filled).cast("array<double>")
    if encoded is None:
        return F.struct(places.alias("indices"), values.alias("values"))
    row = quoted(encoded)
    return F.struct(F.concat(row["indices"], places).alias("indices"), F.concat(row["values"], values).alias("values"))


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, place and value of every entry of a batch of sparse rows."""
    indices, values = column.field("indices"), column.field("values")
    row = np.repeat(np.arange(len(column)), np.diff(indices.offsets.to_numpy()))
    return row, indices.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False)


def _dots(row: np.ndarray, place: np.ndarray, value: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(row, value * block[place, j], minlength=n) for j in range(block.shape[1])], axis=1)


def gram_times(rows: DataFrame, block: np.ndarray, share: np.ndarray, encoded: str = "encoded", part: str = "part") -> np.ndarray:
    """X'W(XB) for a block B of p rows; column j counts the rows of a part with ``share[part, j]``.

    One aggregate: what leaves a task are at most p rows of sums.
    """
    p, m = block.shape
    if block.nbytes > BLOCK_BYTES:
        raise ValueError(f"a block of {p} x {m} exceeds {BLOCK_BYTES} bytes")
    names = [f"s{j}" for j in range(m)]
    schema = T.StructType([T.StructField("place", T.LongType()), *[T.StructField(s, T.DoubleType()) for s in names]])
    sent = rows.sparkSession.sparkContext.broadcast((block, share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, share = sent.value
        total = np.zeros(block.shape)
        for batch in batches:
            row, place, value = _entries(batch["encoded"])
            dots = _dots(row, place, value, block, batch.num_rows) * share[batch["part"].to_numpy()]
            met, at = np.unique(place, return_inverse=True)
            for j in range(block.shape[1]):
                total[met, j] += np.bincount(at, value * dots[row, j], minlength=len(met))
        some = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(some, pa.int64()), *[pa.array(total[some, j]) for j in range(total.shape[1])]]
        yield pa.RecordBatch.from_arrays(columns, names=["place", *names])

    given = rows.select(quoted(encoded).alias("encoded"), quoted(part).cast("int").alias("part"))
    sums = given.mapInArrow(run, schema).groupBy("place").agg(*[F.sum(s).alias(s) for s in names]).toArrow()
    sent.destroy()
    out = np.zeros((p, m))
    at = sums["place"].to_numpy()
    for j, s in enumerate(names):
        out[at, j] = sums[s].to_numpy()
    return out


@dataclass(frozen=True)
class Sums:
    """Rows, mean and population variance of every place, and products with the target, per part."""

    n: np.ndarray  # parts
    mean: np.ndarray  # parts x p
    variance: np.ndarray
    target: np.ndarray  # parts: sum of the target
    square: np.ndarray  # parts: sum of its square
    product: np.ndarray  # parts x p: sum of place times target


def place_sums(rows: DataFrame, p: int, parts: int, encoded: str = "encoded", part: str = "part", target: Column | None = None) -> Sums:
    y = (F.lit(0.0) if target is None else target).cast("double")
    given = rows.select(quoted(part).cast("int").alias("part"), quoted(encoded).alias("encoded"), y.alias("y"))
    heads = given.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.sum(F.col("y") * F.col("y")).alias("yy")).collect()
    n, sy, syy = np.zeros(parts), np.zeros(parts), np.zeros(parts)
    for r in heads:
        n[r["part"]], sy[r["part"]], syy[r["part"]] = r["n"], r["y"], r["yy"]
    entry = given.select("part", "y", F.inline(F.arrays_zip("encoded.indices", "encoded.values")))
    found = (
        entry.groupBy("part", "indices")
        .agg(F.count(F.lit(1)).alias("c"), F.avg("values").alias("m"), F.var_pop("values").alias("v"), F.sum(F.col("values") * F.col("y")).alias("xy"))
        .toArrow()
    )
    at = found["part"].to_numpy(), found["indices"].to_numpy()
    c, m, v, xy = (np.zeros((parts, p)) for _ in range(4))
    for out, name in ((c, "c"), (m, "m"), (v, "v"), (xy, "xy")):
        out[at] = found[name].to_numpy()
    # Entries that are not there are zeros.
    share = c / np.maximum(n, 1)[:, None]
    return Sums(n, m * share, share * (v + m * m * (1.0 - share)), sy, syy, xy)


def _merged(sums: Sums, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, means (m x p) and variances (m x p) of the parts a column of ``share`` counts."""
    n = share.T @ sums.n
    mean = share.T @ (sums.n[:, None] * sums.mean) / n[:, None]
    spread = [(share[:, j] * sums.n) @ (sums.variance + (sums.mean - mean[j]) ** 2) / n[j] for j in range(share.shape[1])]
    return n, mean, np.array(spread)


@dataclass(frozen=True)
class SparseRidge:
    weights: np.ndarray
    intercept: float
    alpha: float

    def predict(self, df: DataFrame, key: str, encoded: str = "encoded", name: str = "reg_pred") -> DataFrame:
        """(key, prediction) of every row, floored at zero."""
        sent = df.sparkSession.sparkContext.broadcast(self.weights[:, None])
        intercept = self.intercept
        schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(name, T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _dots(*_entries(batch["encoded"]), sent.value, batch.num_rows)[:, 0] + intercept
                yield pa.RecordBatch.from_arrays([batch["key"], pa.array(np.maximum(found, 0.0))], names=schema.fieldNames())

        return df.select(quoted(key).alias("key"), quoted(encoded).alias("encoded")).mapInArrow(run, schema)


@dataclass(frozen=True)
class SparseSearch:
    scores: dict[float, float]  # mean hold-out R2 per alpha
    model: SparseRidge  # best alpha, fitted on all parts
    steps: int


def ridge_by_steps(
    rows: DataFrame, p: int, target: str, part: str, k: int = 3, alphas: Sequence[float] = (0.1, 1.0, 10.0),
    encoded: str = "encoded", tolerance: float = 1e-11, most: int = 1000,
) -> SparseSearch:
    """The search of ``ridge.ridge_search`` on sparse rows, by conjugate gradients.

    min |y - Xw - b|^2 + alpha |w|^2 with a free intercept: every (part left out, alpha) and the
    fits on all parts advance together, one pass over the rows per step. Centring is done on the
    sums, so rows stay sparse; the diagonal preconditions. Rows without a target are left out. A
    fit that has not converged after ``most`` steps is an error, and so is a part without rows.
    """
    known = rows.filter(quoted(target).isNotNull())
    centre = known.agg(F.avg(quoted(target).cast("double"))).first()[0]
    if centre is None:
        raise ValueError(f"no row has a value of {target}")
    sums = place_sums(known, p, k, encoded, part, quoted(target).cast("double") - F.lit(centre))
    if (sums.n == 0).any() or k < 2:
        raise ValueError("every part needs rows, and there must be two at least")
    pairs = [(f, a) for a in alphas for f in range(k)] + [(None, a) for a in alphas]
    share = np.array([[float(f is None or part_ != f) for f, _ in pairs] for part_ in range(k)])
    alpha = np.array([a for _, a in pairs])
    n, mean, variance = _merged(sums, share)
    mean, diagonal = mean.T, (n[:, None] * variance).T + alpha
    diagonal = np.where(diagonal > 0, diagonal, 1.0)
    y = share.T @ sums.target / n

    def times(block: np.ndarray) -> np.ndarray:
        return gram_times(known, block, share, encoded, part) - n * mean * (mean * block).sum(axis=0) + alpha * block

    w = np.zeros((p, len(pairs)))
    left = (share.T @ sums.product).T - n * mean * y
    scaled = left / diagonal
    way, size = scaled, (left * scaled).sum(axis=0)
    enough = tolerance**2 * size
    steps = 0
    while (active := size > enough).any():
        if steps == most:
            raise ArithmeticError(f"no convergence in {most} steps")
        image = times(way)
        along = (way * image).sum(axis=0)
        length = np.divide(size, along, out=np.zeros_like(size), where=active & (along > 0))
        w, left = w + length * way, left - length * image
        scaled = left / diagonal
        new = (left * scaled).sum(axis=0)
        way = np.where(active, scaled + np.divide(new, size, out=np.zeros_like(size), where=size > 0) * way, 0.0)
        size = np.where(active, new, size)
        steps += 1
    free = y - (mean * w).sum(axis=0)

    held = [j for j, (f, _) in enumerate(pairs) if f is not None]
    out = np.array([pairs[j][0] for j in held])
    only = np.array([[float(part_ == f) for f in out] for part_ in range(k)])
    inner = (w[:, held] * gram_times(known, w[:, held], only, encoded, part)).sum(axis=0)
    b, rows_out, sy, syy = free[held], sums.n[out], sums.target[out], sums.square[out]
    cross = np.array([sums.product[f] @ w[:, j] for j, f in zip(held, out)])
    level = np.array([sums.n[f] * (sums.mean[f] @ w[:, j]) for j, f in zip(held, out)])
    sse = syy - 2 * cross - 2 * b * sy + inner + 2 * b * level + rows_out * b * b
    r2 = 1.0 - sse / (syy - sy**2 / rows_out)
    scores = {a: float(np.mean([r for r, j in zip(r2, held) if pairs[j][1] == a])) for a in alphas}
    best = max(alphas, key=lambda a: scores[a])
    j = pairs.index((None, best))
    return SparseSearch(scores, SparseRidge(w[:, j], float(centre + free[j]), best), steps)


@dataclass(frozen=True)
class SparseComponents:
    mean: np.ndarray
    deviation: np.ndarray  # 0 for constant places, which carry no weight
    loadings: np.ndarray  # k x p, largest weight positive
    explained: list[float]
    steps: int

    def transform(self, df: DataFrame, key: str, encoded: str = "encoded", prefix: str = "pca_comp") -> DataFrame:
        """(key, one score per component) of every row."""
        weights = np.divide(self.loadings, self.deviation, out=np.zeros_like(self.loadings), where=self.deviation > 0).T
        shift = self.mean @ weights
        sent = df.sparkSession.sparkContext.broadcast(weights)
        names = [f"{prefix}{i + 1}" for i in range(weights.shape[1])]
        schema = T.StructType([T.StructField(key, df.schema[key].dataType), *[T.StructField(s, T.DoubleType()) for s in names]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _dots(*_entries(batch["encoded"]), sent.value, batch.num_rows) - shift
                yield pa.RecordBatch.from_arrays([batch["key"], *[pa.array(c) for c in found.T]], names=schema.fieldNames())

        return df.select(quoted(key).alias("key"), quoted(encoded).alias("encoded")).mapInArrow(run, schema)


def components_by_steps(
    rows: DataFrame, p: int, k: int = 2, encoded: str = "encoded", extra: int = 8, blocks: int = 12, tolerance: float = 1e-9, most: int = 300, seed: int = 0
) -> SparseComponents:
    """The k leading components of standardized places, by block power steps.

    Each step applies the correlation matrix to a block of k + ``extra`` vectors in one pass. The
    blocks met so far are kept orthogonal and the components are the best directions in their
    span; after ``blocks`` of them only the best k + ``extra`` directions stay. Done when every component is an
    eigenvector up to ``tolerance`` of its value.
    """
    whole = rows.withColumn("_part", F.lit(0))
    sums = place_sums(whole, p, 1, encoded, "_part")
    n, mean, variance = sums.n[0], sums.mean[0], sums.variance[0]
    deviation = np.sqrt(np.where(variance > 1e-24 * (mean**2 + variance), variance, 0.0))
    free = deviation > 0
    if free.sum() < k:
        raise ValueError(f"{int(free.sum())} places vary, {k} components are asked for")
    inverse = np.divide(1.0, deviation, out=np.zeros(p), where=free)[:, None]
    one = np.ones((1, min(k + extra, int(free.sum()))))

    def times(block: np.ndarray) -> np.ndarray:
        scaled = inverse * block
        image = gram_times(whole, scaled, one[:, :1].repeat(block.shape[1], axis=1), encoded, "_part")
        return inverse * (image / n - np.outer(mean, mean @ scaled))

    width = one.shape[1]
    start = np.random.default_rng(seed).standard_normal((p, width)) * free[:, None]
    block = np.linalg.qr(start)[0]
    basis, images = np.zeros((p, 0)), np.zeros((p, 0))
    for step in range(1, most + 1):
        basis, images = np.hstack([basis, block]), np.hstack([images, times(block)])
        small = basis.T @ images
        value, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(value)[::-1][: min(width, len(value))]
        found, image = basis @ turn[:, order], images @ turn[:, order]
        away = image - found * value[order]
        if (np.linalg.norm(away[:, :k], axis=0) <= tolerance * np.maximum(value[order][:k], 1e-300)).all() or basis.shape[1] >= free.sum():
            break
        if basis.shape[1] >= blocks * width:
            basis, images = found, image
        for _ in range(2):
            away = away - basis @ (basis.T @ away)
        left, size, _ = np.linalg.svd(away, full_matrices=False)
        block = left[:, size > 1e-13 * max(value.max(), 1e-300)][:, : int(free.sum()) - basis.shape[1]]
        block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
        if not block.shape[1]:
            break
    else:
        raise ArithmeticError(f"no convergence in {most} steps")
    loadings = found[:, :k].T
    signs = np.sign(loadings[np.arange(k), np.abs(loadings).argmax(axis=1)])
    return SparseComponents(mean, deviation, loadings * signs[:, None], [float(v) for v in value[order][:k] / free.sum()], step)
