"""Bootstrap and jitter."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwise.functions.hashing import standard_normal, uniform
from driftwise.operators.resample import bootstrap, jitter, noise_scales, number_rows


def test_rows_are_numbered_densely_in_hash_order(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    for digits in (1, 2, 4):
        rows = number_rows(df, "k", 9, "n", digits).orderBy("n").collect()
        assert [r.n for r in rows] == list(range(1, 501))
        order = df.orderBy(F.md5(F.concat(F.lit("9:"), F.col("k").cast("string")))).collect()
        assert [r.k for r in rows] == [r.k for r in order]


@pytest.mark.parametrize("n", [1, 19, 5000])
def test_bootstrap_size_is_exact_and_draws_are_uniform(spark, n):
    df = spark.range(19).withColumnRenamed("id", "k")
    rows = bootstrap(df, n, "k", 42).collect()
    assert sorted(r.draw for r in rows) == list(range(n))
    if n == 5000:
        counts = np.bincount([r.k for r in rows], minlength=19)
        assert counts.min() > 200 and counts.max() < 330


def test_bootstrap_of_equal_rows_and_of_nothing(spark):
    same = spark.createDataFrame([("a",)] * 4, "k string")
    assert bootstrap(same, 10, "k", 1).count() == 10
    with pytest.raises(ValueError, match="empty"):
        bootstrap(same.limit(0), 10, "k", 1)


def test_noise_scale_rules(spark):
    df = spark.createDataFrame([(1.0, 4.0, None), (3.0, 4.0, 8.0), (5.0, 4.0, None)], "a double, const double, single double")
    scales = noise_scales(df, ["a", "const", "single", "absent"])
    assert scales == pytest.approx({"a": 0.2, "const": 0.02, "single": 0.04})


def test_jitter_keeps_missing_and_floors_by_name(spark):
    df = spark.range(2000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.lit(0.0)).alias("Score_x"), F.lit(0.0).alias("ajuste")
    )
    out = jitter(df, {"Score_x": 1.0, "ajuste": 1.0, "absent": 1.0}, "k", 5, ("Premio", "Score"))
    row = out.agg(F.count("Score_x"), F.min("Score_x"), F.min("ajuste"), F.stddev("ajuste"), F.avg("ajuste")).first()
    assert row[0] == 1000 and row[1] == 0.0 and row[2] < -2
    assert row[3] == pytest.approx(1.0, abs=0.06) and row[4] == pytest.approx(0.0, abs=0.08)


def test_draws_depend_on_seed_and_key_only(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r.k: r.u for r in df.select("k", uniform(1, "k").alias("u")).collect()}
    b = {r.k: r.u for r in df.repartition(7).select("k", uniform(1, "k").alias("u")).collect()}
    assert a == b and 0 <= min(a.values()) and max(a.values()) < 1
    z = np.array([r.z for r in df.select(standard_normal(1, "k").alias("z")).collect()])
    assert abs(z.mean()) < 0.1 and abs(z.std() - 1) < 0.08
