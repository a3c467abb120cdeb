"""Missing values, zeros, ties and ranges in the column expressions."""

from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from driftwise.functions import scalar
from driftwise.functions.normal import normal_quantile
from driftwise.operators.fusion import agreeing, disagreeing, fuse, fusion_kpis, with_fusion


def values(df, column):
    return [r.v for r in df.select(column.alias("v")).collect()]


def test_direction_lands_on_keep_when_a_side_is_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (1.0, 1.0), (None, 1.0), (1.0, None)], "b double, a double")
    assert values(df, scalar.direction("b", "a")) == ["up", "down", "keep", "keep", "keep"]


def test_direction_names_can_be_given(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "b double, a double")
    names = scalar.Directions("Aumentou", "Diminuiu", "Manteve")
    assert values(df, scalar.direction("b", "a", names)) == ["Aumentou"]
    assert names.names() == ["Aumentou", "Diminuiu", "Manteve"]


def test_nan_is_missing_after_ingest(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (None, 1.0), (2.0, 1.0)], "b double, a double")
    clean = scalar.nan_to_null(df)
    assert values(clean, F.col("b")) == [None, None, 2.0]
    assert values(clean, scalar.direction("b", "a")) == ["keep", "keep", "down"]


def test_ratio_is_one_for_a_zero_base(spark):
    df = spark.createDataFrame([(0.0, 5.0), (-1.0, 5.0), (None, 5.0), (2.0, None)], "b double, a double")
    assert values(df, scalar.guarded_ratio("a", "b")) == [1.0, -5.0, None, None]


def test_floor_keeps_missing_and_clamp_does_not(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (50.0,), (None,)], "x double")
    assert values(df, scalar.floor_at_zero("x")) == [0.0, 0.5, 50.0, None]
    assert values(df, scalar.clamp("x", 0, 40)) == [0.0, 0.5, 40.0, 40.0]


def test_normal_quantile(spark):
    shares = [7e-7, 1e-4, 0.0749, 0.075, 0.0751, 0.3, 0.5, 0.9, 0.925, 0.99999, 1 - 7e-7]
    df = spark.createDataFrame([(p,) for p in shares], "p double")
    want = [NormalDist().inv_cdf(p) for p in shares]
    assert values(df, normal_quantile(F.col("p"))) == pytest.approx(want, rel=1e-12, abs=1e-15)


def test_texts(spark):
    df = spark.createDataFrame([(0.7926, 0.0605)], "a double, b double")
    assert values(df, scalar.percent_text("a")) == ["79.26%"]
    assert values(df, scalar.signed_points_text("b")) == ["+0.0605 pp"]
    assert values(df, scalar.decimal_text("b", 3)) == ["0.061"] or values(df, scalar.decimal_text("b", 3)) == ["0.060"]


FUSE_CASES = [
    # before, value, class, fused
    (10.0, 12.0, "up", 12.0),
    (10.0, 8.0, "up", 12.0),
    (10.0, 10.0, "up", 10.0),
    (10.0, 8.0, "down", 8.0),
    (10.0, 12.0, "down", 8.0),
    (10.0, 10.0, "down", 10.0),
    (10.0, 12.0, "keep", 10.0),
    (10.0, 8.0, "keep", 10.0),
    (3.0, 9.0, "down", 0.0),  # reflection lands below zero
    (None, 8.0, "up", 8.0),
    (None, -8.0, "up", 0.0),
    (10.0, None, "keep", None),
    (10.0, 8.0, None, 8.0),
    (10.0, 8.0, "other", 8.0),
]


def test_fusion_cases(spark):
    df = spark.createDataFrame([c[:3] for c in FUSE_CASES], "b double, v double, c string")
    assert values(df, fuse("b", "v", "c")) == [c[3] for c in FUSE_CASES]


def test_fusion_properties(renewal_rows):
    out = with_fusion(renewal_rows, "pct_before", "pct_after", "reg_pred", "class_pred")
    kept = out.filter("class_pred = 'keep'")
    assert kept.filter("fused_pred <> pct_before").count() == 0
    mirrored = out.filter("class_pred <> 'keep' AND class_pred <> reg_direction AND reg_direction <> 'keep' AND fused_pred > 0")
    assert mirrored.count() > 0
    assert mirrored.filter("abs((fused_pred + reg_pred) / 2 - pct_before) > 1e-9").count() == 0
    agree = out.filter("class_pred = reg_direction").count()
    assert agree + out.filter("class_pred <> reg_direction").count() == out.count()


def test_a_missing_class_disagrees(spark):
    df = spark.createDataFrame([("up", "up"), ("up", "down"), (None, "up")], "class_pred string, reg_direction string")
    df = df.selectExpr("*", "1D AS y", "1D AS p", "1D AS fused_pred", "'up' AS real_direction", "'up' AS fused_direction")
    assert disagreeing(df).count() == 2 and agreeing(df).count() == 1
    row = fusion_kpis(df, "y", "p", "class_pred").first()
    assert row.discordant == 2 == row.n_rows - 1
