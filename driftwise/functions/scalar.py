"""Column expressions shared by every operator. None of them needs Python rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


@dataclass(frozen=True)
class Directions:
    """Names of the three outcomes of a renewal."""

    up: str = "up"
    down: str = "down"
    keep: str = "keep"

    def names(self) -> list[str]:
        return sorted([self.up, self.down, self.keep])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def direction(before: str | Column, after: str | Column, names: Directions = Directions()) -> Column:
    """Up, down or keep; a missing side compares as unknown and lands on keep."""
    before, after = _col(before), _col(after)
    return F.when(after > before, names.up).when(after < before, names.down).otherwise(names.keep)


def guarded_ratio(after: str | Column, before: str | Column) -> Column:
    """after / before, 1 where before is zero, missing where either is missing."""
    before, after = _col(before), _col(after)
    return F.when(before == 0, F.lit(1.0)).otherwise(after / before)


def difference(after: str | Column, before: str | Column) -> Column:
    return _col(after) - _col(before)


def floor_at_zero(x: str | Column) -> Column:
    """Negative becomes 0, missing stays missing (``greatest`` would turn it into 0)."""
    x = _col(x)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def clamp(x: str | Column, low: float, high: float) -> Column:
    """Keep x within [low, high]; a missing x yields ``high``."""
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), _col(x)))


def residual(actual: str | Column, predicted: str | Column) -> Column:
    return _col(actual) - _col(predicted)


def absolute_error(actual: str | Column, predicted: str | Column) -> Column:
    return F.abs(residual(actual, predicted))


def percent_text(x: str | Column, digits: int = 2) -> Column:
    """0.7926 -> 79.26%"""
    return F.format_string(f"%.{digits}f%%", _col(x) * 100)


def signed_points_text(x: str | Column, digits: int = 4) -> Column:
    """0.0605 -> +0.0605 pp"""
    return F.format_string(f"%+.{digits}f pp", _col(x))


def decimal_text(x: str | Column, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", _col(x))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark orders NaN above every number and equal to itself, so a NaN would flip
    the rules above; missing values must arrive as NULL."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    by_name = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    return df.select(*[F.when(~F.isnan(x), x).alias(c) if c in floats else x for c, x in by_name.items()])
