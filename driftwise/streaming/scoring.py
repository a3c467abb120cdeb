"""Apply fitted, stateless steps to a stream of renewals.

Labels, imputation, encoding, ridge scores and fusion are projections, so the batch
functions run on a streaming DataFrame unchanged; this only wires source to sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(
    source: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Score what is available and append it to a Parquet table, exactly once per input file."""
    return (
        score(source)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
