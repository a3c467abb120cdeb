"""Renewal tables derived from orders, line items and customers.

A renewal is an order joined to the same customer's previous order. ``scored``
adds deterministic stand-ins for model output, so that evaluation operators can
be checked without fitting anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwise.functions.scalar import Directions, direction, floor_at_zero, nan_to_null
from driftwise.operators.ranges import with_ordered_range
from driftwise.session import stage_once

CLASSES = Directions()

# A customer above this many orders leaves the one-sort-per-customer path.
HOT_CUSTOMER_ORDERS = 5_000_000

CARRIED = {"prior_id": "o_orderkey", "pct_before": "pct", "premium_before": "o_totalprice", "insured_before": "insured"}


# Declared schemas spare every query a job that reads file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return nan_to_null(spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet"))


def _policies(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders with a whole-number percentage and an insured amount from their lines.

    Orders without lines stay, with both values missing.
    """
    lines = (
        lineitem.groupBy("l_orderkey")
        .agg(
            F.floor(F.sum(F.round(F.col("l_discount") * 100).cast("long")).cast("double") / F.count(F.lit(1)))
            .cast("double")
            .alias("pct"),
            F.sum(F.col("l_quantity").cast("long")).cast("double").alias("insured"),
        )
    )
    return (
        orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .drop("l_orderkey")
    )


def _of_customers(chained: DataFrame, customers: DataFrame) -> DataFrame:
    """Policies that have a predecessor, with their customer; reuses the partitioning of the lag."""
    return chained.filter("prior_id IS NOT NULL").join(customers, F.col("c_custkey") == F.col("o_custkey"))


def _with_previous(policies: DataFrame) -> DataFrame:
    timeline = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return policies.select("*", *[F.lag(c).over(timeline).alias(name) for name, c in CARRIED.items()])


def _with_previous_by_range(policies: DataFrame, ranges: int | None = None) -> DataFrame:
    """The same lag for customers too large for one task.

    Their timeline is cut into ranges of similar size by (time, key), missing times first, so
    that one instant with many orders is cut too. Inside a range the lag is local; the first
    row of a range takes the last row of that customer's latest earlier range from a table
    with one row per (customer, range).
    """
    date = F.col("o_orderdate")
    # Microseconds read off the calendar fields, free of time zones; a double holds them exactly.
    second = F.unix_date(date.cast("date")) * 86400 + F.hour(date) * 3600 + F.minute(date) * 60
    micro = second.cast("double") * 1e6 + F.round(F.extract(F.lit("SECOND"), date).cast("double") * 1e6)
    rows = with_ordered_range(policies.withColumn("_time", micro), "_time", "o_orderkey", "_range", ranges)
    stamp = F.struct("o_orderdate", "o_orderkey")
    carried = F.struct(*[F.col(c).alias(name) for name, c in CARRIED.items()])
    lasts = rows.groupBy("o_custkey", "_range").agg(F.max_by(carried, stamp).alias("_last"))
    earlier = Window.partitionBy("o_custkey").orderBy("_range")
    carry = lasts.select("o_custkey", "_range", F.lag("_last").over(earlier).alias("_carry"))
    inside = Window.partitionBy("o_custkey", "_range").orderBy("o_orderdate", "o_orderkey")
    chained = rows.withColumn("_local", F.lag(carried).over(inside)).join(carry, ["o_custkey", "_range"])
    previous = F.coalesce("_local", "_carry")
    return chained.select(*policies.columns, *[previous[name].alias(name) for name in CARRIED])


_hot_customers: dict[tuple, list[int]] = {}


def hot_customers(orders: DataFrame, hot_orders: int = HOT_CUSTOMER_ORDERS) -> list[int]:
    """Customers above the threshold; there can be no more than orders / threshold of them."""
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return [r[0] for r in counts.filter(F.col("n") > hot_orders).select("o_custkey").collect() if r[0] is not None]


def renewals(spark: SparkSession, sf_dir: str, hot_orders: int = HOT_CUSTOMER_ORDERS) -> DataFrame:
    """Renewals with both sides' values; the first order of a customer has no predecessor and is left out."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    policies = _policies(orders, table(spark, sf_dir, "lineitem"))
    # Like table statistics, the list is gathered once per session and table; a stale one costs
    # time, not correctness.
    statistics = (spark.sparkContext.applicationId, sf_dir, hot_orders)
    if statistics not in _hot_customers:
        _hot_customers[statistics] = hot_customers(orders, hot_orders)
    if hot := _hot_customers[statistics]:
        keys = F.broadcast(spark.createDataFrame([(k,) for k in hot], "key bigint"))
        regular = policies.join(keys, F.col("o_custkey") == F.col("key"), "left_anti")
        large = policies.join(keys, F.col("o_custkey") == F.col("key"), "left_semi")
        # One customer row per hot key.
        few = F.broadcast(customers.join(keys, F.col("c_custkey") == F.col("key"), "left_semi"))
        chained = _of_customers(_with_previous(regular), customers).unionByName(
            _of_customers(_with_previous_by_range(large), few)
        )
    else:
        chained = _of_customers(_with_previous(policies), customers)
    branches = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return chained.join(branches, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("o_orderkey").alias("policy_id"),
        F.col("prior_id").alias("prior_policy_id"),
        F.col("o_custkey").alias("party_id"),
        "pct_before",
        F.col("pct").alias("pct_after"),
        "premium_before",
        F.col("o_totalprice").alias("premium_after"),
        "insured_before",
        F.col("insured").alias("insured_after"),
        F.col("c_acctbal").alias("score"),
        F.col("o_orderpriority").alias("band"),
        F.col("o_orderstatus").alias("status"),
        F.col("c_mktsegment").alias("maker"),
        F.col("r_name").alias("branch"),
    )


def add_scores(df: DataFrame, names: Directions = CLASSES) -> DataFrame:
    """Deterministic probabilities, class and value in place of model output."""
    z = F.col("premium_after") / (F.col("premium_after") + F.col("premium_before"))
    q = F.col("insured_after") / (F.col("insured_after") + F.col("insured_before"))
    return (
        df.select("*", z.alias("z"), q.alias("q"))
        .select(
            "*",
            (F.lit(0.8) * F.col("z")).alias("p_up"),
            (F.lit(0.8) * (F.lit(1.0) - F.col("z"))).alias("p_down"),
            F.lit(0.2).alias("p_keep"),
            F.when(F.col("z") >= 0.75, names.up)
            .when(F.col("z") <= 0.25, names.down)
            .otherwise(names.keep)
            .alias("class_pred"),
            floor_at_zero(F.col("pct_before") + (F.col("q") - 0.5) * 4.0).alias("reg_pred"),
            direction("pct_before", "pct_after", names).alias("class_true"),
        )
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_scores(renewals(spark, sf_dir))


def staged_scores(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Only the named columns, written once, for operators that read their input several times."""
    return stage_once(spark, ("scores", sf_dir, *columns), lambda: scored(spark, sf_dir).select(*columns))


def complete(df: DataFrame) -> DataFrame:
    """Rows on which every score and outcome is known."""
    return df.filter("reg_pred IS NOT NULL AND pct_after IS NOT NULL")


def probabilities(names: Directions = CLASSES) -> dict[str, Column]:
    return {c: F.col(f"p_{c}") for c in names.names()}
