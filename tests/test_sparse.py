"""Sparse encodings and the fits on them, against closed forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwise.operators.prep import PrincipalComponents
from driftwise.operators.ridge import ridge_search
from driftwise.operators.sparse import LevelIndex, components_by_steps, ridge_by_steps, sparse_row
from driftwise.session import stage


def wide(spark, n, p, seed=1):
    """Columns of very different size and correlation, two of them constant, and a target."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, p)) @ (np.eye(p) + 0.3 * rng.standard_normal((p, p))) * 10.0 ** rng.uniform(-2, 3, p) + rng.uniform(-50, 50, p)
    x[:, 3], x[:, 4] = 0.0, 7.0
    y = x @ rng.standard_normal(p) / np.abs(x).max(axis=0).clip(1).sum() + rng.standard_normal(n) + 20
    rows = [(i, i % 3, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"x.{j}" for j in range(p)]
    df = spark.createDataFrame(rows, ["id", "fold", *names, "y"]).repartition(8, "id")
    return stage(df, "wide"), names


def test_ridge_by_steps_equals_the_closed_form(spark):
    df, names = wide(spark, 900, 66)
    closed = ridge_search(df, names, "y", "fold")
    rows = stage(df.select("id", "fold", "y", sparse_row(names).alias("encoded")), "sparse")
    steps = ridge_by_steps(rows, 66, "y", "fold")
    assert steps.model.alpha == closed.model.alpha
    for a, score in closed.scores.items():
        assert steps.scores[a] == pytest.approx(score, rel=1e-8)
    wanted = {r["id"]: r["reg_pred"] for r in closed.model.transform(df).select("id", "reg_pred").collect()}
    found = {r["id"]: r["reg_pred"] for r in steps.model.predict(rows, "id").collect()}
    assert found == pytest.approx(wanted, rel=1e-8)


def test_components_by_steps_equal_the_dense_ones(spark):
    df, names = wide(spark, 500, 30)
    dense = PrincipalComponents.fit(df, names, 3)
    rows = stage(df.select("id", sparse_row(names).alias("encoded")), "sparse")
    steps = components_by_steps(rows, 30, 3, extra=2)
    # The dense routine divides by all columns, constant ones included, when they are in its trace.
    assert np.allclose(np.array(steps.explained) / steps.explained[0], np.array(dense.explained) / dense.explained[0], atol=1e-8)
    assert np.allclose(np.abs(steps.loadings), np.abs(np.array(dense.loadings)), atol=1e-6)
    wanted = np.array([r[1:] for r in dense.transform(df).select("id", "pca_comp1", "pca_comp2", "pca_comp3").orderBy("id").collect()])
    found = np.array([r[1:] for r in steps.transform(rows, "id").orderBy("id").collect()])
    assert np.allclose(np.abs(found), np.abs(wanted), atol=1e-5)


def levels_of(spark, n, many):
    return spark.range(n, numPartitions=8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v."), (F.col("id") % many).cast("string"))).alias("a.b"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("w"), (F.col("id") % 5).cast("string"))).alias("c"),
        F.lit(1).alias("value"),
        F.lit(2).alias("place"),
        F.lit(3).alias("n"),
    )


@pytest.mark.parametrize("small", [200_000, 0])
def test_levels_get_dense_places(spark, small):
    df = levels_of(spark, 3_000, 700)
    index = LevelIndex.fit(df, ["a.b", "c"], small=small)
    places = {(r["column"], r["value"]): r["place"] for r in index.table.collect()}
    rows = df.collect()
    first = {c: min(r[c] for r in rows if r[c] is not None) for c in ("a.b", "c")}
    assert set(places) == {(c, r[c]) for r in rows for c in first if r[c] not in (None, first[c])}
    assert sorted(places.values()) == list(range(index.size))
    found = index.transform(df).collect()
    assert len(found) == len(rows)
    by_id = {r["id"]: r for r in rows}
    for r in found:
        assert tuple(r)[:-1] == tuple(by_id[r["id"]])
        assert r["encoded"]["indices"] == sorted(places[c, r[c]] for c in first if (c, r[c]) in places)
        assert r["encoded"]["values"] == [1.0] * len(r["encoded"]["indices"])
    unseen = index.transform(df.limit(5).withColumn("c", F.lit("none")).withColumn("a.b", F.lit(None).cast("string")))
    assert [r["encoded"]["indices"] for r in unseen.collect()] == [[]] * 5
    assert index.transform(df.limit(0)).collect() == []
    assert LevelIndex.fit(df.limit(0), ["a.b", "c"], small=small).size == 0


def test_hundred_thousand_levels_and_fits_on_them(spark):
    df = levels_of(spark, 150_000, 100_000).withColumns({"fold": F.col("id") % 3, "y": 5.0 + (F.col("id") % 5) + F.when(F.col("id") % 3 == 0, 2.0).otherwise(0.0)})
    index = LevelIndex.fit(df, ["a.b", "c"])
    assert index.size > 66_000
    rows = stage(index.transform(df), "sparse")
    found = ridge_by_steps(rows, index.size, "y", "fold", tolerance=1e-9)
    assert found.steps < 100 and found.model.weights.shape == (index.size,)
    one = components_by_steps(rows, index.size, 1, tolerance=1e-3)
    assert one.loadings.shape == (1, index.size) and 0 < one.explained[0] < 1


def test_what_cannot_be_fitted_is_refused(spark):
    df, names = wide(spark, 60, 6)
    rows = df.select("fold", "y", sparse_row(names).alias("encoded"))
    with pytest.raises(ValueError):
        ridge_by_steps(rows.filter("fold > 0"), 6, "y", "fold")
    with pytest.raises(ArithmeticError):
        ridge_by_steps(rows, 6, "y", "fold", most=1)
    with pytest.raises(ValueError):
        components_by_steps(rows, 6, 5)
