"""Arrow batches cut by bytes, so that a worker's memory does not follow the length of texts.

Spark cuts batches at 10,000 rows or 64 MB. A batch is held by the JVM outside its heap, doubled
while it grows, and by the worker; two tasks of 64 MB batches take more than the rest of an
operator. A single row longer than the limit is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

BATCH_BYTES = 4 << 20
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def _bytes(setting: str) -> int:
    digits = setting.strip().lower().rstrip("bkmg")
    return int(digits) * _UNITS[setting.strip().lower()[len(digits) :]]


def in_batches(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with batches of ``BATCH_BYTES``; a smaller limit of the session stays.

    The limit is a setting of the session, read when the plan runs, so it is set there for good.
    """
    conf = df.sparkSession.conf
    if not 0 < _bytes(conf.get(_SETTING)) <= BATCH_BYTES:
        conf.set(_SETTING, f"{BATCH_BYTES}b")
    return df.mapInArrow(run, schema)
