"""Reconcile a predicted direction with a predicted value, and measure the gain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwise.functions.scalar import Directions, absolute_error, direction, floor_at_zero


def fuse(before: str, value: str, predicted_class: str, names: Directions = Directions()) -> Column:
    """Fused value, floored at zero.

    - class says keep: the old value;
    - class and value point in opposite directions: the value mirrored at the old one;
    - otherwise, or when any input is missing: the predicted value.
    """
    b, v, c = F.col(before), F.col(value), F.col(predicted_class)
    complete = b.isNotNull() & v.isNotNull() & c.isNotNull()
    opposed = ((c == names.up) & (v < b)) | ((c == names.down) & (v > b))
    return floor_at_zero(F.when(~complete, v).when(c == names.keep, b).when(opposed, b - (v - b)).otherwise(v))


def with_fusion(
    df: DataFrame,
    before: str,
    after: str,
    value: str,
    predicted_class: str,
    names: Directions = Directions(),
    fused: str = "fused_pred",
) -> DataFrame:
    """Final output table: the fused value plus the direction of each value column."""
    return df.withColumn(fused, fuse(before, value, predicted_class, names)).withColumns(
        {
            "reg_direction": direction(before, value, names),
            "real_direction": direction(before, after, names),
            "fused_direction": direction(before, fused, names),
        }
    )


def agreeing(df: DataFrame, predicted_class: str = "class_pred") -> DataFrame:
    return df.filter(F.col(predicted_class) == F.col("reg_direction"))


def disagreeing(df: DataFrame, predicted_class: str = "class_pred") -> DataFrame:
    """All rows that do not agree, so also those without a class."""
    return df.filter(~_agree(predicted_class))


def _agree(predicted_class: str) -> Column:
    return F.coalesce(F.col(predicted_class) == F.col("reg_direction"), F.lit(False))


def rate(condition: Column) -> Column:
    """Share of rows that meet a condition; unknown counts as not met."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def kpi_columns(after: str, value: str, predicted_class: str, pred: str = "fused_pred") -> list[Column]:
    """Agreement, corrected cases, errors and direction accuracy as aggregates."""
    agrees = _agree(predicted_class)
    mae_value = F.avg(absolute_error(after, value))
    mae_fused = F.avg(absolute_error(after, pred))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        rate(agrees).alias("agreement_rate"),
        F.count(F.when(~agrees, 1)).alias("discordant"),
        mae_value.alias("mae_reg"),
        mae_fused.alias("mae_fused"),
        (mae_value - mae_fused).alias("mae_gain"),
        rate(F.col("reg_direction") == F.col("real_direction")).alias("direction_accuracy_reg"),
        rate(F.col("fused_direction") == F.col("real_direction")).alias("direction_accuracy_fused"),
    ]


def fusion_kpis(
    fused: DataFrame, after: str, value: str, predicted_class: str, by: tuple[str, ...] = (), pred: str = "fused_pred"
) -> DataFrame:
    return fused.groupBy(*by).agg(*kpi_columns(after, value, predicted_class, pred))
