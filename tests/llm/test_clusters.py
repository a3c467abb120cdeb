"""Clustering against plain exact rounds, and the bounds against exact distances."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftwise.llm import clusters


def brute(rows, k=8, rounds=10, width=64):
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == width and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(1024 * x) for x in vector]))
    order = sorted(
        kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    )
    centres = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        members = [[] for _ in centres]
        for _, x in kept:
            members[nearest(x)[1]].append(x)
        centres = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, centres)]
    labels = [(key, *nearest(x)) for key, x in kept]
    every = sum(d for _, d, _ in labels)
    return [
        (key, j, d, sum(e for _, e, i in labels if i == j), every, hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
        for key, d, j in labels
    ]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return in_order(tuple(r) for r in clusters.clustered(table, **options).collect())


def narrowed(rows):
    """As 32-bit floats, which the column holds."""
    return [
        (k, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for k, v in rows
    ]


def test_rounds_equal_plain_ones(spark):
    rng = random.Random(3)
    centre = [[rng.gauss(0, 0.2) for _ in range(64)] for _ in range(11)]
    rows = [(i, [c + rng.gauss(0, 0.08) for c in rng.choice(centre)]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(200)] + [rows[1]] * 3 + [(None, rows[2][1])]
    rows += [
        (900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [None] + [0.5] * 63), (905, [math.nan] * 64),
        (906, [math.inf] + [0.0] * 63), (907, [-math.inf] + [0.0] * 63), (908, [0.0] * 64), (909, [-0.0] * 64), (910, [-1e-9] * 64),
    ]
    rows = narrowed(rows)
    assert found(spark, rows) == in_order(brute(rows))


def test_ties_empty_clusters_and_few_vectors(spark):
    corners = [(i, [float(i >> b & 1) for b in range(4)] + [0.0] * 60) for i in range(16)]
    for rows in (corners, [(i, [1.0] * 64) for i in range(20)], corners[:3], corners * 5):
        assert found(spark, rows) == in_order(brute(rows))


def test_empty_tables_and_other_columns(spark):
    assert found(spark, []) == [] == found(spark, [(1, [1.0])])
    table = spark.createDataFrame([("a", [1.0, 2.0], 1, 2)], "id string, v array<double>, cluster int, x int")
    row = clusters.clustered(table, dimensions=2, key="id", vector="v").first()
    assert row[:5] == ("a", 0, 0, 0, 0)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="64-bit"):
        found(spark, [(i, [1e30] * 64 if i == 5 else [float(i)] * 64) for i in range(40)])


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 30, 2000, 1 << 26]), st.integers(2, 6))
def test_bounds_never_pass_the_distance(seed, spread, width):
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread + 1, (40, width))
    # collinear and repeated points make the inequality an equation
    points[:10] = points[0] * rng.integers(-1, 2, (10, 1))
    pivots, centroids = points[rng.integers(0, 40, 8)], points[rng.integers(0, 40, 7)]
    pairs = clusters.pivot_pairs(pivots)
    near, centres = clusters.to_pivots(points, pivots), clusters.to_pivots(centroids, pivots)
    exact = np.stack([clusters.distances(points, c) for c in centroids], axis=1)
    assert (clusters.lower_bounds(near, centres, pairs) <= exact).all()
    label, best, _ = clusters.assign(points, near, centroids, centres, pairs)
    assert (label == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()


def test_bounds_spare_distances():
    rng = np.random.default_rng(1)
    centre = rng.integers(-4000, 4000, (8, 64))
    points = np.repeat(centre, 200, axis=0) + rng.integers(-200, 200, (1600, 64))
    pairs, near = clusters.pivot_pairs(centre), clusters.to_pivots(points, centre)
    *_, measured = clusters.assign(points, near, centre, clusters.to_pivots(centre, centre), pairs)
    assert measured < 1600 * 8 / 3
