"""Exact order statistics and linearly interpolated quantiles of many columns.

``percentile`` keeps one counter per distinct value in a single task, and
``percentile_approx`` returns elements near the rank. Here rows are only sorted
once few enough of them can hold the answer. Until then every
pass counts, exactly, the rows by the leading bits of their values, 16 and then 8 to 16
more in the buckets that hold a wanted rank, with the least and the greatest value
of each: the rank falls in a bucket of one value (so a value shared by a third of
all rows is settled) or in one to look at again. A pass is a scan whose tasks sort
chunks of a column with NumPy; what is shuffled are counts of buckets. Functions that
run in tasks are made inside others, so that executors need not have this package.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, IntegralType

# Rows per column that one task may hold for the built-in exact aggregate.
SMALL = 200_000


def known(df: DataFrame, column: str) -> Column:
    """The column as a number, NaN as missing. Whole numbers keep all their digits."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, IntegralType):
        return value.cast("long")
    if isinstance(kind, FractionalType):
        value = value.cast("double")
        return F.when(~F.isnan(value), value)
    return value.cast("double")


def known_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    row = df.agg(*[F.count(known(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


#: A double in order is a number of 64 bits; a pass looks at so many of them, and then at so many more at least.
FIRST_BITS, MORE_BITS = 16, 8
#: Few wanted buckets are cut further, into so many numbers in all.
MOST_COUNTS = 1 << 17
#: Rows that a task sorts at once.
CHUNK_ROWS = 1 << 18
#: More than this share of a column's rows is not worth sorting across tasks.
SETTLED_SHARE = 1 / 8


@dataclass
class _Search:
    """One wanted rank (0-based, among known values) and the bucket that holds it."""

    column: str
    rank: int
    below: int  # rows under the bucket
    inside: int  # rows of the bucket
    bucket: int = 0  # leading bits of its values
    value: float | int | None = None


def _by_column(searches: list[_Search]) -> dict[str, list[int]]:
    """The buckets that hold wanted ranks, ascending."""
    found: dict[str, set[int]] = {}
    for s in searches:
        found.setdefault(s.column, set()).add(s.bucket)
    return {c: sorted(buckets) for c, buckets in found.items()}


def _order() -> tuple[Callable[[np.ndarray], np.ndarray], Callable[[np.ndarray], np.ndarray]]:
    """Doubles to numbers without sign that sort like them, and back."""
    sign, rest = np.uint64(1 << 63), np.int64((1 << 63) - 1)

    def ordered(x: np.ndarray) -> np.ndarray:
        raw = (x + 0.0).view(np.int64)  # a negative zero is a zero
        return (raw ^ ((raw >> 63) & rest)).view(np.uint64) ^ sign

    def doubles(places: np.ndarray) -> np.ndarray:
        raw = (places ^ sign).view(np.int64)
        return (raw ^ ((raw >> 63) & rest)).view(np.float64)

    return ordered, doubles


def _inside(buckets: dict[str, list[int]], bits: int) -> Callable[[pa.Table, int], np.ndarray]:
    """Known values of a column, by position, in its buckets of ``bits`` leading bits, as ordered numbers."""
    held, (ordered, _) = [np.array(b, np.uint64) for b in buckets.values()], _order()

    def inside(table: pa.Table, i: int) -> np.ndarray:
        x = table.column(i).to_numpy()
        places = ordered(x[~np.isnan(x)])  # a missing value comes as NaN
        if bits:
            bucket = places >> np.uint64(64 - bits)
            at = np.minimum(np.searchsorted(held[i], bucket), len(held[i]) - 1)
            places = places[held[i].take(at) == bucket]
        return places

    return inside


def _chunked(rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.Table]]:
    """Batches as tables of some ``rows`` rows."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held)

    return chunked


def _numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[known(df, c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])


def _narrow(df: DataFrame, searches: list[_Search], bits: int, more: int) -> None:
    """One pass for all columns: the rows of each wanted bucket are counted by ``more`` leading bits."""
    buckets = _by_column(searches)
    inside, chunks, (_, doubles) = _inside(buckets, bits), _chunked(CHUNK_ROWS), _order()
    shift = np.uint64(64 - bits - more)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[tuple[np.ndarray, ...]]] = []
        for table in chunks(batches):
            found = found or [[] for _ in range(table.num_columns)]
            for i, parts in enumerate(found):
                places = np.sort(inside(table, i))
                if not len(places):
                    continue
                own = places >> shift
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                end = np.append(first[1:], len(places))
                parts.append((own[first], end - first, places[first], places[end - 1]))
        for i, parts in enumerate(found):
            if not parts:
                continue
            own, n, low, high = (np.concatenate(p) for p in zip(*parts))
            order = np.argsort(own, kind="stable")
            own, n, low, high = own[order], n[order], low[order], high[order]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            yield pa.RecordBatch.from_pydict({
                "column": pa.array(np.full(len(first), i, np.int32)),
                # signed numbers of a table hold all 64 bits as well
                "bucket": pa.array(own[first].view(np.int64)),
                "n": pa.array(np.add.reduceat(n, first).astype(np.int64)),
                "low": pa.array(doubles(np.minimum.reduceat(low, first))),
                "high": pa.array(doubles(np.maximum.reduceat(high, first))),
            })

    counted = _numeric(df, buckets).mapInArrow(count, "column int, bucket long, n long, low double, high double")
    summed = counted.groupBy("column", "bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    # At most 2^more rows for every wanted bucket: the first pass has one per column, the others are bounded by the ranks.
    table = summed.toArrow()
    column, bucket = table["column"].to_numpy(), table["bucket"].to_numpy().view(np.uint64)
    n, low, high = (table[c].to_numpy() for c in ("n", "low", "high"))
    for i, c in enumerate(buckets):
        at = np.flatnonzero(column == i)
        at = at[np.argsort(bucket[at])]
        groups: dict[int, list[_Search]] = {}
        for s in searches:
            if s.column == c:
                groups.setdefault(s.bucket, []).append(s)
        ends = np.searchsorted(bucket[at] >> np.uint64(more), np.array([*groups], np.uint64), "left")
        through = np.cumsum(n[at])
        for end, group in zip(ends, groups.values()):
            before = int(through[end - 1]) if end else 0
            for s in group:
                k = at[j := int(np.searchsorted(through, before + s.rank - s.below, "right"))]
                s.below += int(through[j]) - int(n[k]) - before
                s.inside, s.bucket = int(n[k]), int(bucket[k])
                if low[k] == high[k]:
                    s.value = float(low[k])


def _settle(df: DataFrame, searches: list[_Search], bits: int) -> None:
    """Values at ranks inside buckets of few rows: the rows of each bucket are sorted by
    themselves, spread over the tasks by bucket."""
    buckets = _by_column(searches)
    inside, chunks, (_, doubles) = _inside(buckets, bits), _chunked(CHUNK_ROWS), _order()
    held = [np.array(b, np.uint64) for b in buckets.values()]
    starts = [0, *accumulate(map(len, held))]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            for i in range(table.num_columns):
                places = inside(table, i)
                g = np.searchsorted(held[i], places >> np.uint64(64 - bits)) if bits else np.zeros(len(places), np.int64)
                yield pa.RecordBatch.from_pydict({"g": pa.array(g.astype(np.int64) + starts[i]), "x": pa.array(doubles(places))})

    group = {(c, b): starts[i] + j for i, (c, bs) in enumerate(buckets.items()) for j, b in enumerate(bs)}
    most = max(s.inside for s in searches) + 1
    wanted = {group[s.column, s.bucket] * most + s.rank - s.below + 1: (s.column, s.rank) for s in searches}
    rows = _numeric(df, buckets).mapInArrow(pick, "g long, x double")
    ranked = rows.withColumn("at", F.col("g") * most + F.row_number().over(Window.partitionBy("g").orderBy("x")))
    # one row per wanted rank
    places = F.broadcast(df.sparkSession.createDataFrame([(at,) for at in wanted], "at long"))
    found = {wanted[r["at"]]: r["x"] for r in ranked.join(places, "at").select("at", "x").collect()}
    for s in searches:
        s.value = found[s.column, s.rank]


def _too_many(searches: list[_Search], totals: dict[str, int], small: int) -> set[str]:
    """Columns of which a bucket, or all buckets together, hold too many rows to be sorted."""
    sizes: dict[str, dict[int, int]] = {}
    for s in searches:
        sizes.setdefault(s.column, {})[s.bucket] = s.inside
    return {c for c, ns in sizes.items() if max(ns.values()) > small or sum(ns.values()) > max(small, totals[c] * SETTLED_SHARE)}


def order_statistics(
    df: DataFrame, wanted: dict[str, list[int]], small: int = SMALL, totals: dict[str, int] | None = None
) -> dict[tuple[str, int], float | int]:
    """Value at each 0-based rank of each column, missing values and NaN left out."""
    columns = [c for c in wanted if wanted[c]]
    whole = [c for c in columns if isinstance(df.schema[c].dataType, IntegralType)]
    found = {}
    for c in whole:
        found |= {(c, r): v for r, v in _whole_statistics(df, c, wanted[c], small).items()}
    columns = [c for c in columns if c not in whole]
    if not columns:
        return found
    totals = totals or known_counts(df, columns)
    searches = [_Search(c, r, 0, totals[c]) for c in columns for r in wanted[c]]
    for s in searches:
        if not 0 <= s.rank < s.inside:
            raise ValueError(f"rank {s.rank} is outside column {s.column} with {s.inside} values")
    # A column is left to sort as soon as that is little; the others go on. Of all 64 bits a bucket has one value.
    open_, bits = searches, 0
    while open_:
        large = _too_many(open_, totals, small)
        if few := [s for s in open_ if s.column not in large]:
            _settle(df, few, bits)
        open_ = [s for s in open_ if s.column in large]
        if open_:
            wanted = len({(s.column, s.bucket) for s in open_})
            more = min(FIRST_BITS, 64 - bits, max(MORE_BITS, (MOST_COUNTS // wanted).bit_length() - 1)) if bits else FIRST_BITS
            _narrow(df, open_, bits, more)
            open_, bits = [s for s in open_ if s.value is None], bits + more
    return found | {(s.column, s.rank): s.value for s in searches}


def _whole_statistics(df: DataFrame, column: str, ranks: list[int], small: int) -> dict[int, int]:
    """Whole numbers by doubles that hold them exactly: counted from the smallest, or, where they
    span more than 2^53, first by their upper 33 bits and then by the lower 31."""
    x = known(df, column)
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        raise ValueError(f"column {column} has no values")
    if high - low < 1 << 53:
        shifted = df.select((x - F.lit(low)).cast("double").alias("x"))
        found = order_statistics(shifted, {"x": ranks}, small)
        return {r: int(found["x", r]) + low for r in ranks}
    upper, lower = F.shiftright(x, 31), x.bitwiseAND(F.lit((1 << 31) - 1))
    uppers = order_statistics(df.select(upper.cast("double").alias("x")), {"x": ranks}, small)
    out = {}
    for value in sorted(set(uppers.values())):
        own = [r for r in ranks if uppers["x", r] == value]
        below = df.filter(upper < F.lit(int(value))).count()
        rest = df.filter(upper == F.lit(int(value))).select(lower.cast("double").alias("x"))
        found = order_statistics(rest, {"x": [r - below for r in own]}, small)
        out |= {r: (int(value) << 31) + int(found["x", r - below]) for r in own}
    return out


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], small: int = SMALL
) -> dict[str, list[float | None]]:
    """Quantiles by linear interpolation between neighbours; None for an all-missing column."""
    totals = known_counts(df, columns)
    if max(totals.values()) <= small:
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        row = df.agg(*[F.percentile(known(df, c), wanted).alias(f"q{i}") for i, c in enumerate(columns)]).first()
        return {c: list(row[f"q{i}"] or [None] * len(probabilities)) for i, c in enumerate(columns)}
    positions = {c: [p * (totals[c] - 1) for p in probabilities] for c in columns if totals[c]}
    ranks = {c: sorted({r for x in xs for r in (math.floor(x), math.ceil(x))}) for c, xs in positions.items()}
    values = order_statistics(df, ranks, small, totals)

    def at(c: str, x: float) -> float:
        below, above = math.floor(x), math.ceil(x)
        low, high = float(values[c, below]), float(values[c, above])
        # equal neighbours may be infinite
        return low if low == high else (above - x) * low + (x - below) * high

    return {c: [at(c, x) for x in positions[c]] if c in positions else [None] * len(probabilities) for c in columns}


def medians(df: DataFrame, columns: list[str], small: int = SMALL) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5], small).items()}
