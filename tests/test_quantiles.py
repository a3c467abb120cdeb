"""Exact order statistics, on the built-in path and on the narrowing path."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from driftwise.operators.quantiles import exact_quantiles, medians, order_statistics

SHARES = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]


def frame(spark, columns):
    rows = list(zip(*[[None if v is None else float(v) for v in c] for c in columns]))
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(len(columns))))


@pytest.mark.parametrize("small", [1_000_000, 5])
def test_even_count_interpolates(spark, small):
    df = frame(spark, [[1, 2, 4, 10]])
    assert medians(df, ["c0"], small) == {"c0": 3.0}
    assert exact_quantiles(df, ["c0"], [0.25, 0.5, 0.75], small)["c0"] == [1.75, 3.0, 5.5]


@pytest.mark.parametrize("small", [1_000_000, 50])
def test_matches_numpy_with_gaps_and_hot_values(spark, small):
    rng = np.random.default_rng(3)
    wide = rng.lognormal(0, 3, 20_000)
    hot = np.where(rng.random(20_000) < 0.4, 7.0, rng.normal(7, 1e-6, 20_000))
    few = rng.integers(0, 3, 20_000).astype(float)
    gaps = [None if rng.random() < 0.3 else v for v in wide]
    df = frame(spark, [wide, hot, few, gaps])
    found = exact_quantiles(df, df.columns, SHARES, small)
    for c, data in zip(df.columns, [wide, hot, few, [v for v in gaps if v is not None]]):
        np.testing.assert_allclose(found[c], np.quantile(data, SHARES), rtol=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.integers(-3, 3), st.floats(-1e9, 1e9, allow_nan=False)), min_size=1, max_size=60), st.data())
def test_any_rank_of_any_list(spark, values, data):
    rank = data.draw(st.integers(0, len(values) - 1))
    df = frame(spark, [values])
    assert order_statistics(df, {"c0": [rank]}, small=3)["c0", rank] == sorted(map(float, values))[rank]


def test_all_missing_and_bad_rank(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.5]}
    assert exact_quantiles(df, ["a", "b"], [0.5], small=1) == {"a": [None], "b": [1.5]}
    with pytest.raises(ValueError, match="rank"):
        order_statistics(df, {"b": [2]})


@pytest.mark.parametrize("values", [
    [1.0, float("nan"), 2.0, None, 5.0, float("nan"), 9.0] * 20,
    [float("-inf"), 1.0, 2.0, float("inf"), float("inf")] * 30,
    [float("inf")] * 50 + [float("nan")] * 20,
])
def test_nan_and_infinity_give_the_same_on_both_paths(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c0 double")
    assert repr(exact_quantiles(df, ["c0"], SHARES, 5)) == repr(exact_quantiles(df, ["c0"], SHARES, 10**6))


@pytest.mark.parametrize("small", [5, 10**6])
def test_large_whole_numbers_keep_their_digits(spark, small):
    values = [2**56 + 3 * i for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "c0 bigint")
    found = order_statistics(df, {"c0": [0, 137, 250, 499]}, small)
    assert [found["c0", r] for r in (0, 137, 250, 499)] == [values[r] for r in (0, 137, 250, 499)]


def test_many_ranks_are_found_without_an_expression_per_rank(spark, monkeypatch):
    """A row was compared with every pivot of every rank, 372 times a column for the bins of a tree."""
    rng = np.random.default_rng(5)
    columns = [rng.normal(size=4000), rng.integers(-3, 3, 4000) * 0.5, np.where(rng.random(4000) < 0.1, np.inf, -rng.random(4000))]
    df = frame(spark, columns).localCheckpoint()
    most = []
    for name in ("first", "collect"):
        run = getattr(type(df), name)

        def spied(self, run=run):
            most.append(self._jdf.queryExecution().optimizedPlan().toString().count("count("))
            return run(self)

        monkeypatch.setattr(type(df), name, spied)
    ranks = list(range(0, 4000, 61))
    found = order_statistics(df, {c: ranks for c in df.columns}, small=50)
    for c, data in zip(df.columns, columns):
        assert [found[c, r] for r in ranks] == [sorted(data)[r] for r in ranks]
    assert most and max(most) < 10


def test_zeros_of_both_signs_and_extreme_numbers(spark):
    values = [-0.0, 0.0, -5e-324, 5e-324, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf")] * 9
    df = spark.createDataFrame([(v,) for v in values], "c0 double")
    ranks = list(range(len(values)))
    assert [order_statistics(df, {"c0": ranks}, 4)["c0", r] for r in ranks] == sorted(values)


def test_values_are_counted_where_they_lie_without_a_row_for_each(spark, monkeypatch):
    """Every value of every column became a row of its own in each pass."""
    rng = np.random.default_rng(11)
    columns = [rng.lognormal(0, 2, 6000), rng.integers(0, 2, 6000), np.where(rng.random(6000) < 0.2, np.nan, rng.normal(1e6, 1e-3, 6000))]
    df = frame(spark, columns).localCheckpoint()
    plans = []
    for name in ("first", "collect", "toArrow"):
        run = getattr(type(df), name)

        def spied(self, run=run):
            plans.append(self._jdf.queryExecution().optimizedPlan().toString())
            return run(self)

        monkeypatch.setattr(type(df), name, spied)
    found = exact_quantiles(df, df.columns, SHARES, small=100)
    for c, data in zip(df.columns, columns):
        np.testing.assert_allclose(found[c], np.quantile(data[~np.isnan(data)], SHARES), rtol=1e-12)
    assert plans and not [p for p in plans if "Generate" in p or "percentile" in p]
