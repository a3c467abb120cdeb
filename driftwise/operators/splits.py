"""Exact-size samples, splits and folds without sorting or shuffling the table.

Rows are ordered by a hash of (seed, key). A part is a range of that order, so
all that is needed is the row at each cut. Per hash prefix the rows are counted
(partial aggregation leaves at most 16^digits numbers per task), the prefix that
holds a cut is found from running counts, and only that sliver, about
1/16^digits of the table, is sorted. Every row then compares itself with the
cuts in a plain projection. Keys must be unique; a seed gives the same parts on
every run and after a lost executor.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwise.functions.hashing import order_hash
from driftwise.operators.quantiles import order_statistics

MAX_STRATA = 1000
#: More strata than this are looked up in a table instead of an expression.
FEW_STRATA = 32


def strata_of(df: DataFrame, by: str) -> list:
    """Distinct labels; strata are class labels, so a large number is a mistake."""
    found = [r[0] for r in df.select(by).distinct().limit(MAX_STRATA + 1).collect()]
    if len(found) > MAX_STRATA:
        raise ValueError(f"{by} has more than {MAX_STRATA} values; it is not a class label")
    return sorted(found, key=lambda v: (v is not None, v))


def _refuse(lacking: Column) -> Column:
    """Rows without a key share one place in the hash order, where no cut can part them."""
    return F.raise_error(F.concat(lacking.cast("string"), F.lit(" rows have no key"))).cast("long")


def _cut_rows(keyed: DataFrame, ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """(stratum, edges): the (hash, key) of the row at each 1-based cut rank, missing at rank 0."""
    counts = keyed.groupBy("_stratum", "_prefix").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("_key").isNull(), 1)).alias("_lacking")
    )
    # At most 16^digits rows per stratum, whatever the size of the table.
    ahead = Window.partitionBy("_stratum").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    cuts = list(ranks(F.col("_total")))
    targets = (
        counts.withColumns(
            {
                "_start": F.coalesce(F.sum("_n").over(ahead), F.lit(0)),
                "_total": F.sum("_n").over(Window.partitionBy("_stratum")),
                "_lacking": F.sum("_lacking").over(Window.partitionBy("_stratum")),
            }
        )
        .withColumn("_total", F.when(F.col("_lacking") == 0, F.col("_total")).otherwise(_refuse(F.col("_lacking"))))
        .select(
            "_stratum", "_prefix", "_start", "_n", F.posexplode(F.array(*[c.cast("long") for c in cuts])).alias("_cut", "_rank")
        )
        .filter("_start < _rank AND _rank <= _start + _n")
        .select("_stratum", "_prefix", "_cut", (F.col("_rank") - F.col("_start")).alias("_within"))
    )
    # One target per (stratum, cut): bounded by MAX_STRATA, so safe to broadcast.
    inside = Window.partitionBy("_stratum", "_cut").orderBy("_hash", "_key")
    edges = (
        keyed.join(F.broadcast(targets), ["_stratum", "_prefix"])
        .withColumn("_row", F.row_number().over(inside))
        .filter("_row = _within")
        .select("_stratum", "_cut", F.struct("_hash", "_key").alias("_edge"))
    )
    return edges.groupBy("_stratum").agg(
        F.struct(*[F.max(F.when(F.col("_cut") == i, F.col("_edge"))).alias(f"e{i}") for i in range(len(cuts))]).alias("_edges")
    )


def _position(by: str | None, labels: Sequence) -> Column:
    """Position of the label, -1 for one that is not listed. A missing label is a label like any other."""
    found = F.lit(-1)
    for i, label in enumerate(labels):
        found = F.when(F.col(by).eqNullSafe(F.lit(label)), i).otherwise(found)
    return found


def _looked_up(df: DataFrame, by: str, labels: Sequence, values: list, kind: str, name: str) -> DataFrame:
    """The value of each label from a table of at most MAX_STRATA rows, null for other labels."""
    schema = f"_label {df.schema[by].dataType.simpleString()}, {name} {kind}"
    table = df.sparkSession.createDataFrame(list(zip(labels, values)), schema)
    return df.join(F.broadcast(table), F.col(by).eqNullSafe(F.col("_label")), "left").drop("_label")


@dataclass(frozen=True)
class HashCuts:
    """Fitted cuts: per stratum the (hash, key) at each cut, None where a cut lies before the first row.

    Stratum -1 holds labels that were not listed. Applying the cuts is a projection, so a
    table need not be written again to keep its parts for later passes.
    """

    key: str
    seed: int | str
    by: str | None
    strata: list
    edges: dict[int, list[tuple | None]]
    n_cuts: int

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        key: str,
        seed: int | str,
        ranks: Callable[[Column], Sequence[Column]],
        by: str | None = None,
        strata: Sequence | None = None,
        digits: int = 4,
    ) -> HashCuts:
        """``ranks`` turns the number of rows (of a stratum) into ascending 1-based cut ranks."""
        labels = [] if by is None else list(strata) if strata is not None else strata_of(df, by)
        hashed = order_hash(seed, key)
        position = _position(by, labels if len(labels) <= FEW_STRATA else [])
        if len(labels) > FEW_STRATA:
            df = _looked_up(df, by, labels, list(range(len(labels))), "int", "_position")
            position = F.coalesce("_position", F.lit(-1))
        keyed = df.select(
            position.alias("_stratum"),
            F.col(key).alias("_key"),
            hashed.alias("_hash"),
            F.substring(hashed, 1, digits).alias("_prefix"),
        )
        # One row per stratum.
        edges = {
            r["_stratum"]: [None if e is None else (e["_hash"], e["_key"]) for e in r["_edges"]]
            for r in _cut_rows(keyed, ranks).collect()
        }
        return cls(key, seed, by, labels, edges, len(list(ranks(F.lit(0)))))

    def transform(self, df: DataFrame, part: str = "part") -> DataFrame:
        """Add the part: 0 up to the first cut, 1 up to the second, and so on.

        A projection for few strata; many are looked up in a small table, so that their number
        does not deepen the expression.
        """
        kind = df.schema[self.key].dataType
        place = F.struct(order_hash(self.seed, self.key).alias("h"), F.col(self.key).alias("k"))

        def cuts(stratum: int) -> list[tuple]:
            # the empty text lies before every hash: a cut before the first row
            return [e or ("", None) for e in self.edges.get(stratum, [None] * self.n_cuts)]

        def edge(e: tuple) -> Column:
            return F.struct(F.lit(e[0]).alias("h"), F.lit(e[1]).cast(kind).alias("k"))

        def beyond(edges: list[Column]) -> Column:
            return sum(((place > e).cast("int") for e in edges), F.lit(0))

        rest = beyond([edge(e) for e in cuts(-1)])
        if len(self.strata) > FEW_STRATA:
            shape = f"array<struct<h:string,k:{kind.simpleString()}>>"
            found = _looked_up(df, self.by, self.strata, [cuts(i) for i in range(len(self.strata))], shape, "_edges")
            value = beyond([F.get("_edges", F.lit(j)) for j in range(self.n_cuts)])
            return found.withColumn(part, F.when(F.col("_edges").isNull(), rest).otherwise(value)).drop("_edges")
        value = rest
        for i, label in enumerate(self.strata):
            value = F.when(F.col(self.by).eqNullSafe(F.lit(label)), beyond([edge(e) for e in cuts(i)])).otherwise(value)
        return df.withColumn(part, value)


def cut_by_hash(
    df: DataFrame,
    key: str,
    seed: int | str,
    ranks: Callable[[Column], Sequence[Column]],
    by: str | None = None,
    strata: Sequence | None = None,
    part: str = "part",
    digits: int = 4,
) -> DataFrame:
    return HashCuts.fit(df, key, seed, ranks, by, strata, digits).transform(df, part)


def exact_sample(df: DataFrame, n: int, key: str, seed: int | str) -> DataFrame:
    """Exactly n rows without replacement, or all rows if there are fewer."""
    cut = cut_by_hash(df, key, seed, lambda total: [F.least(F.lit(n).cast("long"), total)], part="_part")
    return cut.filter("_part = 0").drop("_part")


def random_split(df: DataFrame, test_share: float, key: str, seed: int | str, name: str = "split") -> DataFrame:
    """Label each row train or test; the test part has ceil(share * n) rows."""
    cut = cut_by_hash(
        df, key, seed, lambda total: [total - F.ceil(F.lit(float(test_share)) * total).cast("long")], part="_part"
    )
    return cut.withColumn(name, F.when(F.col("_part") == 0, "train").otherwise("test")).drop("_part")


def stratified_split(
    df: DataFrame, train_share: float, by: str, key: str, seed: int | str, strata: Sequence | None = None, name: str = "split"
) -> DataFrame:
    """Label each row train or test with floor(share * n) training rows in every class."""
    cut = cut_by_hash(
        df, key, seed, lambda total: [F.floor(F.lit(float(train_share)) * total).cast("long")], by, strata, part="_part"
    )
    return cut.withColumn(name, F.when(F.col("_part") == 0, "train").otherwise("test")).drop("_part")


def _fold_ranks(k: int) -> Callable[[Column], list[Column]]:
    """Cumulative fold sizes: the first n mod k folds take one row more."""
    return lambda total: [
        F.floor(total / k).cast("long") * i + F.least(F.lit(i).cast("long"), total % k) for i in range(1, k)
    ]


def stratified_folds(
    df: DataFrame, k: int, by: str, key: str, seed: int | str, strata: Sequence | None = None, name: str = "fold"
) -> DataFrame:
    """k folds of equal size (within one row) in every class, drawn by hash."""
    return cut_by_hash(df, key, seed, _fold_ranks(k), by, strata, part=name)


def hash_folds(df: DataFrame, k: int, key: str, seed: int | str, name: str = "fold") -> DataFrame:
    """k folds of equal size (within one row) over the shuffled rows."""
    return cut_by_hash(df, key, seed, _fold_ranks(k), part=name)


def contiguous_folds(df: DataFrame, k: int, key: str, name: str = "fold") -> DataFrame:
    """k folds of neighbouring keys; ``key`` is numeric, unique and never missing."""
    total, missing = df.agg(F.count(key), F.count(F.when(F.col(key).isNull(), 1))).first()
    if missing:
        raise ValueError(f"{missing} rows have no {key}")
    ranks = [i * (total // k) + min(i, total % k) - 1 for i in range(1, k)]
    edges = order_statistics(df, {key: sorted({r for r in ranks if r >= 0})}, totals={key: total})
    beyond = [(F.col(key) > F.lit(edges[key, r])).cast("int") if r >= 0 else F.lit(1) for r in ranks]
    return df.withColumn(name, sum(beyond, F.lit(0)))


def aligned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of two tables matched on their key, the explicit form of index alignment."""
    return left.join(right, key)
