"""Session set-up and the one shared folder that staged tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "driftwise", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DRIFTWISE_DRIVER_MEMORY", "8g"))
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="driftwise-")
    return _local_folders[context.applicationId]


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{app}/{name}-{uuid.uuid4().hex[:12]}"


_staged: dict[tuple, DataFrame] = {}


def stage_once(spark: SparkSession, key: tuple, make: Callable[[], DataFrame], spread: bool = False) -> DataFrame:
    """The table ``make`` gives, written the first time it is asked for under ``key`` and read
    back after that: queries of one application share their derived tables."""
    full = (spark.sparkContext.applicationId, spread, *key)
    if full not in _staged:
        _staged[full] = stage(make(), str(key[0]), spread)
    return _staged[full]


#: A task buffers a row group of its output on the heap; Parquet's own 128 MB are a share of it that counts.
ROW_GROUP_BYTES = 16 << 20


def stage(df: DataFrame, name: str, spread: bool = False) -> DataFrame:
    """Write ``df`` once and read it back, so operators that need several passes
    over a derived table scan Parquet instead of repeating its joins. Unlike
    cached blocks, the written table outlives a lost executor.

    ``spread`` is for iterative fits, which compute far more than they read: a table
    of fewer files than there are cores is dealt out over all of them.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return back.repartition(cores) if spread and len(back.inputFiles()) < cores else back
