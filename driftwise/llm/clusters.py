"""Exact Lloyd rounds over integer vectors, with Ptolemaic bounds from cached pivot distances.

For any four points of a Euclidean space Ptolemy's inequality holds, so with two pivots p, q
every vector x and centroid c satisfy

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q).

The pivots are the starting centroids and never change. The distances of a vector to them are
computed once and written beside it; a round computes the centroids' distances to the pivots,
takes the largest bound over fixed pairs of pivots, measures the centroid of the smallest bound
exactly and then only those whose bound does not exceed it. Bounds are floating-point numbers,
made smaller by more than their rounding can be; everything compared or summed is an integer, so
the result is the one that all exact distances give.

Plan: one pass writes integer components and pivot distances; a round is one pass over that table
whose tasks send one row of sums per (cluster, component), and the driver holds the centroids
only. Nothing is shuffled but those sums.

Defined results: vectors of another length, or with a missing or non-finite component, are left
out; components are integers up to 2**27 in size, so that a distance fits 64 bits, and larger
ones are an error; repeated rows are vectors of their own; starts are ordered by the hash of the
id, equal hashes by their components, missing ids last; with fewer vectors than clusters there
are fewer clusters; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches
from driftwise.session import stage

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
LARGEST = 1 << 27
#: Pivots, and pairs of them, that bounds are taken from.
PIVOTS = 8
PAIRS = 8
#: More than any rounding of the few operations of a bound, relative to its terms.
SLACK = 2.0**-45
ROWS = 4096


def integers(vector: Column, dimensions: int, scale: int) -> tuple[Column, Column]:
    """Whether a vector is kept, and its components as integers."""
    good = (F.size(vector) == dimensions) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return F.coalesce(good, F.lit(False)), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def pivot_pairs(pivots: np.ndarray, pairs: int = PAIRS) -> list[tuple[int, int, float]]:
    """(p, q, distance) of pivots that differ: each with the next, then with the one after."""
    n, found = len(pivots), []
    for step in range(1, n // 2 + 1):
        for p in range(n):
            q = (p + step) % n
            if len(found) < pairs and (min(p, q), max(p, q)) not in [x[:2] for x in found]:
                apart = float(distances(pivots[p : p + 1], pivots[q])[0])
                if apart:
                    found.append((min(p, q), max(p, q), apart**0.5))
    return found


def distances(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, exact."""
    apart = vectors - centre
    return np.einsum("ij,ij->i", apart, apart)


def to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([distances(vectors, p) for p in pivots], axis=1).astype(np.float64))


def lower_bounds(near: np.ndarray, centres: np.ndarray, pairs: Sequence[tuple[int, int, float]]) -> np.ndarray:
    """Squared lower bounds, vectors by centroids, never above the true squared distance."""
    best = np.zeros((len(near), len(centres)))
    for p, q, apart in pairs:
        one, two = near[:, p, None] * centres[None, :, q], near[:, q, None] * centres[None, :, p]
        np.maximum(best, (np.abs(one - two) - SLACK * (one + two)) / apart, out=best)
    return best * best * (1 - SLACK)


def assign(
    vectors: np.ndarray, near: np.ndarray, centroids: np.ndarray, centres: np.ndarray, pairs: Sequence[tuple[int, int, float]]
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of every vector (ties: the smaller number), its squared distance, and how
    many exact distances that took."""
    bounds = lower_bounds(near, centres, pairs)
    label = bounds.argmin(axis=1)
    best = np.empty(len(vectors), dtype=np.int64)
    for c in range(len(centroids)):
        rows = np.flatnonzero(label == c)
        best[rows] = distances(vectors[rows], centroids[c])
    guess, measured = label.copy(), len(vectors)
    for c in range(len(centroids)):
        rows = np.flatnonzero((guess != c) & (bounds[:, c] <= best * (1 + SLACK)))
        found = distances(vectors[rows], centroids[c])
        closer = (found < best[rows]) | ((found == best[rows]) & (c < label[rows]))
        label[rows[closer]], best[rows[closer]] = c, found[closer]
        measured += len(rows)
    return label, best, measured


def _arrays(batch: pa.RecordBatch, name: str, kind: type, width: int) -> np.ndarray:
    return batch[name].flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _assigned(vectors: DataFrame, pivots: np.ndarray, centroids: np.ndarray, each):
    """Runs ``each`` on the labels of some rows at a time, on the tasks."""
    pairs = pivot_pairs(pivots)
    centres = to_pivots(centroids, pivots)
    width, n_pivots = centroids.shape[1], len(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                rows = batch.slice(low, ROWS)
                x = _arrays(rows, "x", np.int64, width)
                label, best, _ = assign(x, _arrays(rows, "near", np.float64, n_pivots), centroids, centres, pairs)
                yield rows, x, label, best

    return in_batches(vectors, lambda batches: each(run(batches)), each.schema)


def _sums(k: int, width: int):
    """(cluster, component, n, total) of a task's rows; component is the place in the vector."""

    def each(parts):
        n, total = np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=np.int64)
        for _, x, label, _ in parts:
            n += np.bincount(label, minlength=k)
            for c in np.unique(label):
                total[c] += x[label == c].sum(axis=0)
        cluster, component = np.divmod(np.arange(k * width), width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster), pa.array(component), pa.array(np.repeat(n, width)), pa.array(total.reshape(-1))],
            names=["cluster", "component", "n", "total"],
        )

    each.schema = "cluster bigint, component bigint, n bigint, total bigint"
    return each


def _labels(id_type: T.DataType):
    def each(parts):
        for rows, _, label, best in parts:
            yield pa.RecordBatch.from_arrays(
                [rows["vec_id"], pa.array(label.astype(np.int32)), pa.array(best)],
                names=["vec_id", "cluster", "distance"],
            )

    each.schema = T.StructType(
        [
            T.StructField("vec_id", id_type),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )
    return each


def _moved(vectors: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; those without vectors stay."""
    sums = _assigned(vectors, pivots, centroids, _sums(*centroids.shape))
    wide = "decimal(20,0)"
    totals = sums.groupBy("cluster", "component").agg(
        F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("total").cast(wide)).alias("total")
    )
    out = centroids.copy()
    for r in totals.where("n > 0").collect():  # clusters x components rows
        out[r["cluster"], r["component"]] = int(r["total"]) // int(r["n"])
    return out


def with_pivot_distances(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vec_id, x and near (distances to the pivots), written once."""
    width = pivots.shape[1]
    schema = T.StructType(
        [
            T.StructField("vec_id", kept.schema["vec_id"].dataType),
            T.StructField("x", T.ArrayType(T.IntegerType(), False)),
            T.StructField("near", T.ArrayType(T.DoubleType(), False)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                rows = batch.slice(low, ROWS)
                x = _arrays(rows, "x", np.int64, width)
                near = to_pivots(x, pivots)
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1) * a.shape[1], pa.int32()), pa.array(a.reshape(-1))
                    )
                    for a in (x.astype(np.int32), near)
                ]
                yield pa.RecordBatch.from_arrays([rows["vec_id"], *lists], names=schema.fieldNames())

    return stage(in_batches(kept.select("vec_id", "x"), run, schema), "vectors")


def clustered(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    given = embeddings.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    good, x = integers(F.col("v"), dimensions, scale)
    kept = given.where(good).select("vec_id", x.alias("x"))
    id_type = given.schema["vec_id"].dataType
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = [r["x"] for r in kept.orderBy(order.asc_nulls_last(), "x").limit(clusters).collect()]
    if not starts:
        text, number = T.StringType(), T.LongType()
        columns = [("cluster_inertia", number), ("inertia", number), ("centroid_sha256", text)]
        schema = T.StructType([*_labels(id_type).schema, *[T.StructField(*c) for c in columns]])
        return embeddings.sparkSession.createDataFrame([], schema)
    in_range = F.forall("x", lambda i: F.abs(i) <= LARGEST)
    checked = F.when(in_range, F.col("x")).otherwise(
        F.raise_error(F.lit(f"components beyond {LARGEST} have no 64-bit distance")).cast("array<bigint>")
    )
    centroids = np.array(starts, dtype=np.int64)
    if np.abs(centroids).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST} have no 64-bit distance")
    pivots = centroids[:PIVOTS]
    vectors = with_pivot_distances(kept.select("vec_id", checked.alias("x")), pivots)
    for _ in range(rounds):
        centroids = _moved(vectors, pivots, centroids)
    labels = stage(_assigned(vectors, pivots, centroids, _labels(id_type)), "clusters")
    summed = labels.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()
    every = sum(int(r["total"]) for r in summed)
    rows = [
        (r["cluster"], int(r["total"]), every, hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
        for r in summed
    ]
    columns = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    table = embeddings.sparkSession.createDataFrame(rows, columns)  # a row per cluster
    return labels.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
