"""Url filters by a sorted sweep over reversed-host keys.

The labels of a host in reverse order, each closed by a point, make its key: ``www.example.net``
becomes ``net.example.www.``. All subdomains of a host then lie in one interval of keys, the
keys that begin with its own, and such intervals are nested or disjoint. Rules and urls are
sorted by key together and swept once: a rule's host opens a frame on a stack, which is left
when a key lies outside its interval, so the stack holds exactly the rules whose hosts fit. The
longest path prefix among them is looked up per frame.

Plan: cuts from a sample of the urls (a sample moves the bounds of ranges, never a result) make
ranges of (key, path, a hash of the row), so one host, or one url, with a third of all rows is
cut too. A rule goes to the range its key lies in and to every range that begins inside its
interval: those are the frames that are open there. One shuffle of keys, paths and ids deals out
the ranges; pages are not shuffled.

A task holds the rules of one chain of nested hosts at a time. The driver and the tasks hold at
most ``RANGES`` cuts.

Defined results: of the rules that fit, the one with the longest text (host and path) wins, among
equals the one with the longer host; of rules with one host and path, block wins; rules without
host, path or verdict are ignored, and a rule for the empty host fits every host. A null url, or
one without ``://``, has an empty host and path. Repeated rows are judged each; a null id stays;
empty tables give no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches

DEFAULT = "allow"
RANGES = 4096
#: Rows of a range, where the partitions of the session do not make them smaller.
RANGE_ROWS = 1_000_000
SAMPLE_PER_RANGE = 64
#: Characters of keys and paths that a cut keeps; any cut is a right one.
CUT_CHARS = 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIRST = -(1 << 63)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, number sign or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to a question mark, number sign or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed labels, each closed by a point; empty for the empty host."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, "."), F.lit(".")))


def key_host(key: str) -> str:
    return ".".join(reversed(key[:-1].split("."))) if key else ""


def _keyed(pages: DataFrame, key: str, url: str) -> DataFrame:
    given = pages.select(F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"))
    return given.select(
        "id",
        host_key(url_host(F.col("url"))).alias("key"),
        url_path(F.col("url")).alias("path"),
        # equal rows differ in their place, so that they too can be cut
        F.xxhash64(F.col("id"), F.monotonically_increasing_id()).alias("tie"),
    )


def _cuts(keyed: DataFrame) -> list[tuple[str, str, int]]:
    """Bounds between the ranges, from a sample whose size follows from the number of ranges."""
    rows = keyed.count()
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(RANGES, max(partitions, rows // RANGE_ROWS + 1))
    if rows == 0:
        return []
    share = min(1.0, ranges * SAMPLE_PER_RANGE / rows)
    short = [F.substring(c, 1, CUT_CHARS).alias(c) for c in ("key", "path")]
    found = sorted(tuple(r) for r in keyed.sample(share, seed=7).select(*short, "tie").collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


_ROW = [
    T.StructField("range", T.IntegerType()),
    T.StructField("key", T.StringType()),
    T.StructField("is_url", T.BooleanType()),
    T.StructField("path", T.StringType()),
    T.StructField("verdict", T.StringType()),
]


def _with_ranges(keyed: DataFrame, cuts) -> DataFrame:
    schema = T.StructType([T.StructField("id", keyed.schema["id"].dataType), *_ROW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = cuts.value
        for batch in batches:
            n = batch.num_rows
            places = zip(batch["key"].to_pylist(), batch["path"].to_pylist(), batch["tie"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array([bisect_right(bounds, p) for p in places], pa.int32()),
                    batch["key"],
                    pa.array([True] * n, pa.bool_()),
                    batch["path"],
                    pa.nulls(n, pa.string()),
                ],
                names=schema.fieldNames(),
            )

    return in_batches(keyed, run, schema)


def _rule_rows(rules: DataFrame, cuts) -> DataFrame:
    """Every rule in the range of its key and in those that begin inside its interval."""
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    one = (
        rules.select("host", "path", "verdict").dropna()
        .select(host_key(host).alias("key"), "path", "verdict")
        .groupBy("key", "path").agg(F.max("verdict").alias("verdict"))
    )
    schema = T.StructType(_ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = cuts.value
        for batch in batches:
            rows = []
            for key, path, verdict in zip(*(batch[c].to_pylist() for c in ("key", "path", "verdict"))):
                place = bisect_right(bounds, (key, "", _FIRST))
                rows.append((place, key, False, path, verdict))
                while place < len(bounds) and bounds[place][0].startswith(key):
                    place += 1
                    rows.append((place, key, False, path, verdict))
            columns = zip(*rows) if rows else [[]] * 5
            types = (pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names=schema.fieldNames()
            )

    return in_batches(one, run, schema)


class Frame:
    """The rules of one host on the stack."""

    def __init__(self, key: str) -> None:
        self.key, self.host = key, key_host(key)
        self.verdicts: dict[str, str] = {}
        self.lengths: list[int] = []

    def add(self, path: str, verdict: str) -> None:
        self.verdicts[path] = verdict
        if len(path) not in self.lengths:
            self.lengths = sorted([*self.lengths, len(path)], reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if path[:n] in self.verdicts), None)


def judge(stack: list[Frame], path: str) -> tuple[str | None, str | None]:
    """Rule and verdict of the longest rule on the stack that fits the path."""
    best, length = (None, None), -1
    for frame in reversed(stack):
        fits = frame.longest(path)
        if fits is not None and len(frame.host) + len(fits) > length:
            best, length = (frame.host + fits, frame.verdicts[fits]), len(frame.host) + len(fits)
    return best


def _sweep(default: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[Frame] = []
        where = last = found = None
        host = ""
        for batch in batches:
            rows, hosts, rules, verdicts = [], [], [], []
            columns = (batch[c].to_pylist() for c in ("range", "key", "is_url", "path", "verdict"))
            for i, (part, key, is_url, path, verdict) in enumerate(zip(*columns)):
                if where != (part, key):
                    if where and where[0] != part:
                        stack.clear()
                    while stack and not key.startswith(stack[-1].key):
                        stack.pop()
                    where, last, host = (part, key), None, key_host(key)
                if not is_url:
                    if not stack or stack[-1].key != key:
                        stack.append(Frame(key))
                    stack[-1].add(path, verdict)
                    continue
                if path != last:
                    last, found = path, judge(stack, path)
                rows.append(i)
                hosts.append(host)
                rules.append(found[0])
                verdicts.append(found[1] or default)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(at),
                    pa.array(hosts, pa.string()),
                    batch["path"].take(at),
                    pa.array(rules, pa.string()),
                    pa.array(verdicts, pa.string()),
                ],
                names=names,
            )

    return run


def judged(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT
) -> DataFrame:
    """key, host, path, rule, verdict of every row; ``rules`` has host, path and verdict."""
    keyed = _keyed(pages, key, url)
    bounds = _cuts(keyed)
    cuts = pages.sparkSession.sparkContext.broadcast(bounds)
    urls = _with_ranges(keyed, cuts)
    both = urls.unionByName(_rule_rows(rules, cuts), allowMissingColumns=True)
    order = ["range", "key", "is_url", "path"]
    schema = T.StructType(
        [
            T.StructField(key, pages.schema[key].dataType),
            *[T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")],
        ]
    )
    dealt = both.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions(*order)
    return in_batches(dealt, _sweep(default, schema.fieldNames()), schema)
