"""Exact sizes, determinism, disjoint and covering parts, skewed strata."""

import math

import pytest
from pyspark.sql import functions as F

from driftwise.operators.splits import (
    HashCuts,
    aligned,
    contiguous_folds,
    cut_by_hash,
    exact_sample,
    hash_folds,
    random_split,
    stratified_folds,
    stratified_split,
)


@pytest.fixture(scope="module")
def people(spark):
    """1,003 keys; one class holds far more than a third of the rows and one label is missing."""
    label = F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").when(F.col("id") % 100 == 9, None).otherwise("few")
    return spark.range(1003).select("id", label.alias("label"))


def sizes(df, *by):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*by).count().collect()}


@pytest.mark.parametrize("n", [0, 1, 10, 1002, 1003, 5000])
@pytest.mark.parametrize("digits", [1, 4])
def test_sample_has_exactly_n_rows(people, n, digits):
    cut = cut_by_hash(people, "id", "s", lambda total: [F.least(F.lit(n).cast("long"), total)], digits=digits)
    assert cut.filter("part = 0").count() == min(n, 1003)
    assert exact_sample(people, n, "id", "s").count() == min(n, 1003)


def test_sample_is_the_smallest_hashes(people):
    got = {r.id for r in exact_sample(people, 20, "id", "s").collect()}
    want = people.orderBy(F.md5(F.concat(F.lit("s:"), F.col("id").cast("string"))), "id").limit(20)
    assert got == {r.id for r in want.collect()}


def test_sample_repeats_and_changes_with_the_seed(people):
    def draw(seed):
        return {r.id for r in exact_sample(people.repartition(5), 100, "id", seed).collect()}

    assert draw("a") == draw("a") != draw("b")


@pytest.mark.parametrize("share", [0.2, 0.3, 0.333])
def test_random_split_sizes(people, share):
    test = math.ceil(share * 1003)
    assert sizes(random_split(people, share, "id", 1), "split") == {("test",): test, ("train",): 1003 - test}


def test_stratified_split_keeps_shares_and_every_row(people):
    out = stratified_split(people, 0.8, "label", "id", 1)
    totals, parts = sizes(people, "label"), sizes(out, "label", "split")
    for (label,), n in totals.items():
        assert parts[label, "train"] == math.floor(0.8 * n)
        assert parts[label, "train"] + parts.get((label, "test"), 0) == n


def test_strata_not_listed_are_still_split(people):
    out = stratified_split(people, 0.5, "label", "id", 1, strata=["big"])
    assert out.count() == 1003


def test_stratified_folds_differ_by_at_most_one(people):
    out = stratified_folds(people, 3, "label", "id", 1)
    for (label,), n in sizes(people, "label").items():
        counts = [sizes(out.filter(F.col("label").eqNullSafe(F.lit(label))), "fold").get((f,), 0) for f in range(3)]
        assert sum(counts) == n and max(counts) - min(counts) <= 1


def test_contiguous_folds_match_ntile(people):
    rows = contiguous_folds(people, 3, "id").orderBy("id").collect()
    assert [r.fold for r in rows] == [0] * 335 + [1] * 334 + [2] * 334
    tiny = contiguous_folds(people.filter("id < 2"), 3, "id").orderBy("id").collect()
    assert [r.fold for r in tiny] == [0, 1]


def test_too_many_strata_are_refused(spark):
    df = spark.range(2000).select("id", F.col("id").cast("string").alias("label"))
    with pytest.raises(ValueError, match="class label"):
        stratified_split(df, 0.5, "label", "id", 1)


def test_alignment_is_by_key(people):
    right = people.select("id", (F.col("id") * 2).alias("double")).filter("id >= 1000")
    assert {(r.id, r.double) for r in aligned(people, right, "id").collect()} == {(1000, 2000), (1001, 2002), (1002, 2004)}


def test_split_moves_no_wide_rows(people):
    """Once the cuts are known, the parts are a projection of the table."""
    wide = people.withColumn("payload", F.lit("x"))
    plan = stratified_split(wide, 0.8, "label", "id", 1, ["big", "few", "mid"])._jdf.queryExecution().executedPlan().toString()
    assert "payload" in plan and "Exchange" not in plan


def test_fitted_cuts_apply_to_other_rows(people):
    cuts = HashCuts.fit(people, "id", "s", lambda total: [total / 2])
    low = cuts.transform(people.filter("id < 300")).filter("part = 0").count()
    assert 110 < low < 190 and cuts.transform(people).filter("part = 0").count() == 501


def test_rows_without_a_key_are_refused(spark):
    df = spark.range(100).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("id"))
    for cut in (lambda: exact_sample(df, 50, "id", 1), lambda: random_split(df, 0.3, "id", 1), lambda: contiguous_folds(df, 3, "id")):
        with pytest.raises(Exception, match="no (key|id)"):
            cut().count()


def test_a_thousand_strata(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 1000 > 0, F.col("id") % 1000).cast("string").alias("label"))
    split = stratified_split(df, 0.5, "label", "id", 1)
    assert {r.n for r in split.filter("split = 'train'").groupBy("label").agg(F.count("*").alias("n")).collect()} == {2}


def test_folds_of_large_ids_are_even(spark):
    df = spark.range(3000).select((F.col("id") + F.lit(2**56 + 1)).alias("id"))
    assert sorted(r["count"] for r in contiguous_folds(df, 3, "id").groupBy("fold").count().collect()) == [1000] * 3


def test_hash_folds_are_even_and_shuffled(people):
    rows = hash_folds(people, 3, "id", 1).orderBy("id").collect()
    sizes = [sum(r.fold == i for r in rows) for i in range(3)]
    assert max(sizes) - min(sizes) <= 1 and len({r.fold for r in rows[:20]}) == 3
