"""Joins with hot keys against plain ones."""

import pytest

from driftwise.llm import hot_keys


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_equals_a_plain_join(spark, monkeypatch, most):
    monkeypatch.setattr(hot_keys, "HOT_KEYS", most)
    rows = spark.createDataFrame([(i, k) for i, k in enumerate([7] * 50 + [8] * 20 + [None] * 5 + list(range(30)))], "i int, k int")
    named = spark.createDataFrame([(7, "a", 51), (8, "b", 21), (9, "c", 1), (99, "d", 0)], "k int, name string, n long")
    got = hot_keys.hot_join(rows, named, "k", rows.count())
    assert got.columns == ["i", "k", "name"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(named.drop("n"), "k").select("i", "k", "name").collect()))
    assert hot_keys.hot_join(rows.limit(0), named, "k", 0).collect() == []
