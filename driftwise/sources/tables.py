"""Delimited and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, StringType, StructField, StructType

from driftwise.functions.scalar import nan_to_null
from driftwise.operators.profile import quoted


# What a cell can be, each with its pattern; a cell that is none of them is text.
_MISSING = r"^(NaN)?$"
_WHOLE = r"^-?(0|[1-9][0-9]{0,14})$"
_LONG = r"^-?[1-9][0-9]{15,17}$"
_REAL = r"^-?((0|[1-9][0-9]{0,14})(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"

#: Kinds of cells met in a column, as flags that files or partitions merge by "or".
KINDS = ("whole", "long", "real", "text")


def cell_kinds(spark: SparkSession, paths: str | list[str], sep: str = ";") -> dict[str, set[str]]:
    """The kinds of cells of every column over all rows, in one aggregate over the raw text."""
    raw = spark.read.csv(paths, sep=sep, header=True, encoding="UTF-8", inferSchema=False, enforceSchema=False)

    def flags(c: str) -> Column:
        x = quoted(c)
        given = ~F.coalesce(x, F.lit("")).rlike(_MISSING)
        whole, long, real = x.rlike(_WHOLE), x.rlike(_LONG), x.rlike(_REAL)
        met = (whole, long, real & ~whole & ~long, ~(whole | long | real))
        return F.struct(*[F.coalesce(F.bool_or(given & m), F.lit(False)).alias(k) for k, m in zip(KINDS, met)])

    row = raw.agg(*[flags(c).alias(f"k{i}") for i, c in enumerate(raw.columns)]).first()
    return {c: {k for k in KINDS if r[k]} for c, r in zip(raw.columns, row)}


def kind_type(kinds: set[str]) -> DataType:
    """Smallest type that keeps every cell. Whole numbers of 16 to 18 digits do not fit a double, so
    with real numbers beside them they stay text, as do longer ones and those with leading
    zeros. A column without any value is double."""
    if "text" in kinds or {"long", "real"} <= kinds:
        return StringType()
    return LongType() if kinds and "real" not in kinds else DoubleType()


def infer_schema(spark: SparkSession, paths: str | list[str], sep: str = ";") -> StructType:
    """Types of all columns from all rows of all files, so that they do not drift between files."""
    return StructType([StructField(c, kind_type(kinds)) for c, kinds in cell_kinds(spark, paths, sep).items()])


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, sep: str = ";") -> DataFrame:
    """Header line, UTF-8 with or without a byte-order mark, empty cells missing.

    Without a schema the types are inferred, which reads the data twice.
    """
    schema = infer_schema(spark, path, sep) if schema is None else schema
    df = spark.read.schema(schema).csv(path, sep=sep, header=True, encoding="UTF-8", enforceSchema=False)
    return nan_to_null(df)


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=True, encoding="UTF-8")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``; it must not be the table ``df`` reads from."""
    df.write.mode("overwrite").parquet(path)


def without_identifiers(df: DataFrame, drop: Sequence[str] = (), hashed: Sequence[str] = (), salt: str = "") -> DataFrame:
    """Drop personal identifiers or replace them by a salted hash."""
    masked = {c: F.sha2(F.concat(F.lit(f"{salt}:"), F.col(c).cast("string")), 256) for c in hashed if c in df.columns}
    kept = df.drop(*[c for c in drop if c in df.columns])
    return kept.withColumns(masked) if masked else kept
