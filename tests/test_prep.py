"""Imputation, scaling, components, encoding, bins and profiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwise.operators.resample import jitter, noise_scales
from driftwise.operators.prep import (
    Imputer,
    OneHot,
    PrincipalComponents,
    Standardizer,
    code_label,
    label_code,
    quantile_bin,
    quantile_edges,
)
from driftwise.operators.profile import class_share, histogram, missing_counts, modes, numeric_columns, other_columns, profile


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(
        [(1, 1.0, "b", 7.0, None), (2, 2.0, "a", 7.0, None), (3, 4.0, "a", 7.0, "x"), (4, 10.0, "b", 7.0, None), (5, None, None, 7.0, None)],
        "k int, x double, s string, const double, rare string",
    )


def test_median_is_interpolated_and_mode_ties_go_to_the_smallest(mixed):
    imputer = Imputer.fit(mixed, ["x"], ["s", "rare"])
    assert imputer.medians == {"x": 3.0} and imputer.modes == {"s": "a", "rare": "x"}
    last = imputer.transform(mixed).orderBy(F.desc("k")).first()
    assert (last.x, last.s, last.rare) == (3.0, "a", "x")


def test_parameters_carry_over_to_new_rows(spark, mixed):
    new = spark.createDataFrame([(9, None, None)], "k int, x double, s string")
    assert tuple(Imputer.fit(mixed, ["x"], ["s"]).transform(new).first()) == (9, 3.0, "a")


def test_all_missing_columns_raise(spark):
    df = spark.createDataFrame([(None, None)], "x double, s string")
    with pytest.raises(ValueError, match="x, s"):
        Imputer.fit(df, ["x"], ["s"])


def test_scaling_uses_population_deviation(mixed):
    out = Standardizer.fit(mixed, ["x", "const"]).transform(mixed).orderBy("k").collect()
    data = np.array([1.0, 2, 4, 10])
    np.testing.assert_allclose([r.x for r in out[:4]], (data - data.mean()) / data.std())
    assert out[4].x is None and [r.const for r in out] == [0.0] * 5


def test_constant_columns_scale_to_zero_however_they_are_split(spark):
    df = spark.range(0, 1000, numPartitions=7).select(F.lit(0.1).alias("c"), F.lit(431.7).alias("d"))
    scaler = Standardizer.fit(df, ["c", "d"])
    assert scaler.deviations == {"c": 0.0, "d": 0.0}
    assert scaler.transform(df).distinct().collect() == [(0.0, 0.0)]


def test_components_match_eigenvectors(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) + [0, 100, -3, 5]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "k int, a double, b double, c double, d double")
    model = PrincipalComponents.fit(df, list("abcd"), 2)
    z = (data - data.mean(0)) / data.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    values, vectors = values[::-1], vectors[:, ::-1]
    np.testing.assert_allclose(model.explained, (values / values.sum())[:2], rtol=1e-9)
    for i in range(2):
        w = vectors[:, i] * np.sign(vectors[np.argmax(np.abs(vectors[:, i])), i])
        np.testing.assert_allclose(model.loadings[i], w, atol=1e-9)
    scores = [(r.pca_comp1, r.pca_comp2) for r in model.transform(df).orderBy("k").collect()]
    np.testing.assert_allclose(scores, z @ np.array(model.loadings).T, atol=1e-9)


def test_one_hot_drops_the_first_level(mixed):
    out = OneHot.fit(mixed, ["s", "rare"]).transform(mixed)
    assert out.columns == ["k", "x", "const", "s_b"]  # a single level gives no column
    assert [r.s_b for r in out.orderBy("k").collect()] == [True, False, False, True, False]


def test_one_hot_names_may_hold_dots_and_accents(spark):
    df = spark.createDataFrame([(1, "4. De 0.95 até 0.99"), (2, "5. De 1.0"), (3, "5. De 1.0")], "k int, faixa string")
    out = OneHot.fit(df, ["faixa"]).transform(df)
    assert out.columns == ["k", "faixa_5. De 1.0"]
    assert Standardizer.fit(out.select("k", F.col("`faixa_5. De 1.0`").cast("double").alias("a.b")), ["a.b"]).means["a.b"] == pytest.approx(2 / 3)


def test_one_hot_refuses_too_many_levels(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("s"))
    with pytest.raises(ValueError, match="levels"):
        OneHot.fit(df, ["s"], limit=100)


def test_label_codes_round_trip(spark):
    df = spark.createDataFrame([("up",), ("down",), ("keep",), (None,)], "label string")
    names = ["up", "down", "keep"]
    rows = df.select("label", label_code("label", names).alias("code")).withColumn("back", code_label("code", names)).collect()
    assert [(r.code, r.back) for r in rows] == [(2, "up"), (0, "down"), (1, "keep"), (None, None)]


def test_quantile_bins_are_closed_above_and_include_the_lowest(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 8)] + [(None,)], "x double")
    edges = quantile_edges(df, "x", 3)
    assert edges == [1.0, 3.0, 5.0, 7.0]
    bins = df.select("x", quantile_bin("x", edges, ["lo", "mid", "hi"]).alias("b")).collect()
    assert [r.b for r in bins] == ["lo"] * 3 + ["mid"] * 2 + ["hi"] * 2 + [None]
    outside = spark.createDataFrame([(0.0,), (9.0,)], "x double").select(quantile_bin("x", edges, ["lo", "mid", "hi"]).alias("b"))
    assert [r.b for r in outside.collect()] == [None, None]


def test_duplicate_quantile_edges_raise(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "x double")
    with pytest.raises(ValueError, match="not distinct"):
        quantile_edges(df, "x", 3)


def test_profile_of_mixed_columns(mixed):
    rows = {r["column"]: r for r in profile(mixed).collect()}
    assert set(rows) == {"k", "x", "s", "const", "rare"}
    assert (rows["x"]["count"], rows["x"]["mean"], rows["x"].q25, rows["x"].q50, rows["x"].q75) == (4, 4.25, 1.75, 3.0, 5.5)
    assert rows["x"]["std"] == pytest.approx(np.std([1, 2, 4, 10], ddof=1))
    assert (rows["s"]["count"], rows["s"]["unique"], rows["s"].top, rows["s"].freq) == (4, 2, "a", 2)
    assert rows["s"]["mean"] is None and rows["x"].top is None


def test_profile_of_an_empty_string_column(spark):
    df = spark.createDataFrame([(None, 1)], "s string, x int")
    row = {r["column"]: r for r in profile(df).collect()}["s"]
    assert (row["count"], row["unique"], row.top, row.freq) == (0, 0, None, None)


def test_missing_counts_list_only_columns_with_gaps(mixed):
    assert {r["column"]: r.missing for r in missing_counts(mixed).collect()} == {"x": 1, "s": 1, "rare": 4}


def test_class_share_skips_missing(mixed):
    assert {r.s: (r.n, r.share) for r in class_share(mixed, "s").collect()} == {"a": (2, 0.5), "b": (2, 0.5)}


def test_modes_pick_by_count_then_value(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",)], "s string")
    assert tuple(modes(df, ["s"]).first()) == ("s", 5, 3, "a", 2)


def test_histogram_matches_numpy(spark):
    data = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,)], "x double")
    got = {r.bin: r.n for r in histogram(df, "x", 40).collect()}
    want = np.histogram(data, 40)[0]
    assert got == {i: n for i, n in enumerate(want) if n}


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 3, "x double")
    assert [(r.bin, r.n) for r in histogram(df, "x").collect()] == [(0, 3)]


def test_roles_follow_the_types(mixed):
    assert numeric_columns(mixed, ("k",)) == ["x", "const"] and other_columns(mixed, ("rare", "none")) == ["s"]


def test_names_with_dots_are_profiled(spark):
    df = spark.createDataFrame([(1.0, "x", None), (2.0, None, 3)], "`a.b` double, `c.d` string, `e.f` int")
    assert {(r.column, r.missing) for r in missing_counts(df).collect()} == {("c.d", 1), ("e.f", 1)}
    assert {r.column: r["count"] for r in profile(df).collect()} == {"a.b": 2, "c.d": 1, "e.f": 1}


def test_names_with_dots_are_encoded_counted_and_scaled(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (4.0, None)], "`a.b` double, `c.d` string")
    assert [tuple(r) for r in OneHot.fit(df, ["c.d"]).transform(df).orderBy("`a.b`").collect()] == [(1.0, False), (2.0, True), (4.0, False)]
    assert sum(r.n for r in histogram(df, "a.b", 4).collect()) == 3
    scales = noise_scales(df, ["a.b"])
    assert scales["a.b"] == pytest.approx(0.1 * np.std([1, 2, 4], ddof=1))
    assert jitter(df, {"a.b": 0.0}, "`a.b`", 1).agg(F.sum(F.col("`a.b`"))).first()[0] == 7.0


def test_the_limit_of_levels_is_exact(spark):
    df = spark.range(101).selectExpr("CAST(id AS STRING) AS s")
    assert len(OneHot.fit(df, ["s"], limit=101).levels["s"]) == 101
    with pytest.raises(ValueError):
        OneHot.fit(df, ["s"], limit=100)


def test_moments_of_numbers_far_from_zero_and_of_odd_columns(spark):
    """Sums of running means lost digits of a deviation that is small beside the numbers."""
    x = [1e9 + i % 7 for i in range(5000)]
    rows = [(v, 3.3, None if i % 3 else float(i), None, float("nan"), float("nan") if i == 70 else 2.0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(7)
    found = Standardizer.fit(df, list("abcdef"))
    third = np.arange(0, 5000, 3)
    assert found.deviations["a"] == pytest.approx(np.std([i % 7 for i in range(5000)]), rel=1e-9)
    assert (found.means["b"], found.deviations["b"]) == (pytest.approx(3.3), 0.0)
    assert (found.means["c"], found.deviations["c"]) == (pytest.approx(third.mean()), pytest.approx(third.std()))
    assert (found.means["d"], found.deviations["d"], found.deviations["e"]) == (None, None, 0.0)
    assert np.isnan(found.means["f"]) and np.isnan(found.deviations["f"])
