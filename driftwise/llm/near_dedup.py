"""Near-duplicates by an LSH forest over MinHash signatures.

1. Each text becomes the set of its distinct five-word shingles, a fingerprint of that set,
   and a MinHash signature. Texts with equal sets form a class; one row stands for it.
2. The forest: several orders of the signature. In each, rows are sorted by their signature
   read from another position on. Rows that share the first few values form a region;
   inside it the neighbours in sorted order share the longest prefixes, so a dense region is
   searched as deep as its rows agree while a sparse one is searched at the least depth.
3. A row's nearest followers in every order are candidates if the set sizes allow the
   similarity and the signatures do not rule it out. In a dense region that is a fixed number
   per row and order, never all its pairs.
4. Candidates are confirmed on the full sets: first the best partner of every row, then every
   other candidate whose ends are not connected yet. Confirmed links give the components.
5. A region with more rows than the neighbours cover is settled if it is one component. The
   rows of the others are searched exactly, by prefix filters between their components.

The number of orders, their first values and the least agreement of two signatures follow from
the similarity limit: at 0.85, 25 orders of 5 values, of which a pair at the limit shares none
with probability 4e-7; at 0.80, 32 orders of 4 values and 5e-8. Limits below 0.11 are refused,
because 128 values do not hold that bound there. The sort is by range, which cuts a region anywhere, so a region that holds
a third of all rows is spread over many tasks.

Defined results: a text without words (null, empty, blank) has an empty set and is linked with
nothing, and its component is its own id; repeated rows and equal sets share a component; the
component id is the smallest non-null id of the component; a null id is never that id unless
all are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches
from driftwise.llm.components import components, merged
from driftwise.llm.dense_links import cross_pairs
from driftwise.llm.hot_keys import hot_join
from driftwise.llm.tables import with_row_key
from driftwise.llm.words import SPACED, constants, in_groups, mix, text_shingles, word_hashes
from driftwise.session import stage

SHINGLE = 5
PERCENT = 85
VALUES = 128
FOLLOWERS = 3
#: Probability at most that a pair at the limit shares no region, and that its signatures rule it out.
NO_REGION = 1e-6
RULED_OUT = 5e-5
#: Values after the common prefix that the sort looks at.
SORTED_VALUES = 16
GROUP_BYTES = 1 << 20

_MULTIPLIERS = constants(VALUES, 101)
_FOLD = constants(VALUES, 103)


def smallest_set(percent: int) -> int:
    """Sets below this size are similar enough only when they are equal."""
    return -(-percent // (100 - percent))


@cache
def forest_shape(percent: int) -> tuple[int, int]:
    """Number of orders, and of first values that make a region: as many as ``NO_REGION`` allows,
    without a value in two orders."""
    p = percent / 100
    allowed = [d for d in range(1, VALUES + 1) if (1 - p**d) ** (VALUES // d) <= NO_REGION]
    if not allowed:
        raise ValueError(f"{VALUES} values find no pairs of {percent} percent reliably")
    return VALUES // max(allowed), max(allowed)


@cache
def least_agreeing(percent: int) -> int:
    """Values in which signatures must agree; a pair at the limit agrees in fewer with
    probability ``RULED_OUT`` at most."""
    p, below = percent / 100, 0.0
    for k in range(VALUES):
        below += comb(VALUES, k) * p**k * (1 - p) ** (VALUES - k)
        if below > RULED_OUT:
            return k
    return VALUES


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, a row per non-empty set."""
    joined = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), VALUES), dtype=np.uint64)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat(joined * _MULTIPLIERS[k], starts)
    return mix(out)


def _region_keys(signatures: np.ndarray, orders: int, depth: int) -> np.ndarray:
    """Hash of the first values of every order, a column per order."""
    out = np.empty((len(signatures), orders), dtype=np.int64)
    for t in range(orders):
        at = t * depth
        folded = mix((signatures[:, at : at + depth] * _FOLD[:depth]).sum(axis=1, dtype=np.uint64) + np.uint64(t))
        out[:, t] = folded.view(np.int64)
    return out


def _fingerprint(shingle_set: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    low = int(mix(shingle_set + np.uint64(len(shingle_set))).sum(dtype=np.uint64))
    high = int(mix(shingle_set ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return (high << 64 | low).to_bytes(16, "big")


def _sets(texts: list[str | None]) -> list[np.ndarray]:
    words, counts = word_hashes([(t or "").encode("utf-8", "replace") for t in texts], SPACED)
    return list(text_shingles(words, counts, SHINGLE))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """A megabyte of text at a time, whatever the batches hold."""
    for batch in batches:
        sizes = pc.binary_length(batch["text"]).fill_null(0).to_pylist()
        for low, high in in_groups([n + 64 for n in sizes], GROUP_BYTES):
            part = batch.slice(low, high - low)
            yield part, part["text"].to_pylist()


def shingle_rows(documents: DataFrame, percent: int, key: str, text: str) -> DataFrame:
    """row, doc_id, n_shingles, node (fingerprint), values and region keys of every text, written once."""
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", documents.schema[key].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("node", T.BinaryType()),
            T.StructField("values", T.BinaryType()),
            T.StructField("regions", T.ArrayType(T.LongType(), False)),
        ]
    )

    orders, depth = forest_shape(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part, texts in _groups(batches):
            sets = _sets(texts)
            filled = [i for i, s in enumerate(sets) if len(s)]
            values: list[bytes | None] = [None] * len(sets)
            keys = np.zeros((0, orders), dtype=np.int64)
            if filled:
                signatures = _signatures([sets[i] for i in filled])
                low_bytes = (signatures & np.uint64(255)).astype(np.uint8)
                keys = _region_keys(signatures, orders, depth)
                for i, bytes_ in zip(filled, low_bytes):
                    values[i] = bytes_.tobytes()
            has = np.array([len(s) > 0 for s in sets], dtype=np.int64)
            offsets = np.concatenate(([0], np.cumsum(has))) * orders
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(sets))),
                    part["doc_id"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_fingerprint(s) for s in sets], pa.binary()),
                    pa.array(values, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.reshape(-1))),
                ],
                names=schema.fieldNames(),
            )
            row += len(sets)

    given = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return stage(in_batches(given, run, schema), "shingle-rows")


def forest_rows(rows: DataFrame, percent: int) -> DataFrame:
    """A row per class and order whose region holds another class, with the sort key of that order."""
    carriers = (
        rows.where(F.col("n_shingles") >= smallest_set(percent))
        .groupBy("node")
        .agg(F.min("row").alias("row"))
    )
    classes = rows.join(carriers, ["row", "node"]).select("node", "n_shingles", "values", "regions")
    spread = classes.select("node", F.posexplode("regions").alias("tree", "region"))
    shared = spread.groupBy("region").agg(F.count("*").alias("n")).where("n > 1").select("region")
    _, depth = forest_shape(percent)
    at = F.col("tree") * depth + depth + 1
    return stage(
        spread.join(shared, "region")
        .join(classes.select("node", "n_shingles", "values"), "node")
        .select(
            "region",
            F.substring(F.concat("values", "values"), at, F.lit(SORTED_VALUES)).alias("deeper"),
            "node",
            "n_shingles",
            "values",
        ),
        "forest-rows",
    )


_PAIR = T.StructType(
    [
        T.StructField("a", T.BinaryType()),
        T.StructField("b", T.BinaryType()),
        T.StructField("agreeing", T.IntegerType()),
        # rows at the ends of a sorted part, whose neighbours are in another part
        T.StructField("edge", T.StructType([T.StructField(c, k) for c, k in (
            ("region", T.LongType()), ("deeper", T.BinaryType()), ("node", T.BinaryType()),
            ("n_shingles", T.LongType()), ("values", T.BinaryType()))])),
    ]
)


def _followers(percent: int, followers: int, edges: bool):
    """Scans sorted rows and pairs each with its next few in the same region."""

    least = least_agreeing(percent)

    def pairs(rows: pa.Table) -> tuple[list[bytes], list[bytes], list[int]]:
        region = rows["region"].to_numpy()
        size = rows["n_shingles"].to_numpy()
        node = rows["node"].to_pylist()
        values = np.frombuffer(b"".join(rows["values"].to_pylist()), dtype=np.uint8).reshape(-1, VALUES)
        a, b, agreeing = [], [], []
        for d in range(1, followers + 1):
            near = np.flatnonzero(region[d:] == region[:-d])
            one, two = size[near], size[near + d]
            near = near[100 * np.minimum(one, two) >= percent * np.maximum(one, two)]
            same = (values[near] == values[near + d]).sum(axis=1)
            for i, n in zip(near[same >= least].tolist(), same[same >= least].tolist()):
                x, y = sorted((node[i], node[i + d]))
                if x != y:
                    a.append(x), b.append(y), agreeing.append(n)
        return a, b, agreeing

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, head = None, None
        for batch in batches:
            for low in range(0, batch.num_rows, 20_000):
                rows = pa.Table.from_batches([batch.slice(low, 20_000)])
                joined = rows if tail is None else pa.concat_tables([tail, rows])
                a, b, agreeing = pairs(joined)
                head = joined.slice(0, followers) if head is None or head.num_rows < followers else head
                tail = joined.slice(max(0, joined.num_rows - followers))
                # pairs inside the carried rows come twice; they are grouped later
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(agreeing, pa.int32()),
                     pa.nulls(len(a), pa.struct(rows.schema))],
                    names=_PAIR.fieldNames(),
                )
        if edges and head is not None:
            ends = pa.concat_tables([head, tail]).combine_chunks()
            struct = ends.to_struct_array().combine_chunks()
            none = pa.nulls(len(struct), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.nulls(len(struct), pa.int32()), struct], names=_PAIR.fieldNames()
            )

    return run


def candidates(forest: DataFrame, percent: int, followers: int = FOLLOWERS) -> DataFrame:
    """Distinct candidate pairs (a < b) with the number of agreeing values, written once."""
    order = ["region", "deeper", "node"]
    sorted_rows = forest.repartitionByRange(*order).sortWithinPartitions(*order)
    scanned = stage(in_batches(sorted_rows, _followers(percent, followers, True), _PAIR), "followers")
    # Only the few rows at the ends of each part: as many as there are parts, not rows.
    ends = scanned.where("edge is not null").select("edge.*").coalesce(1).sortWithinPartitions(*order)
    across = in_batches(ends, _followers(percent, followers, False), _PAIR)
    return stage(
        scanned.where("a is not null").union(across).groupBy("a", "b").agg(F.max("agreeing").alias("agreeing")),
        "candidates",
    )


def node_sets(documents: DataFrame, rows: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """The full set of every wanted class, from the text of its first document, written once."""
    first = (
        rows.join(nodes, "node")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first"))
        .select("first")
        .distinct()
    )
    schema = T.StructType(
        [T.StructField("node", T.BinaryType()), T.StructField("set", T.ArrayType(T.LongType(), False))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _groups(batches):
            sets = _sets(texts)
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
            values = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_fingerprint(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                ],
                names=schema.fieldNames(),
            )

    given = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    wanted = given.join(first, F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")
    return stage(in_batches(wanted, run, schema), "node-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("two"))
    common = F.size(F.array_intersect("one", "two"))
    return (
        pairs.select("a", "b").join(one, "a").join(two, "b")
        .where(100 * common >= percent * (F.size("one") + F.size("two") - common))
        .select("a", "b")
    )


def _best_partners(pairs: DataFrame) -> DataFrame:
    """For every node the candidate with the most agreeing values."""
    ends = pairs.select(F.col("a").alias("node"), "a", "b", "agreeing").union(
        pairs.select(F.col("b").alias("node"), "a", "b", "agreeing")
    )
    best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("agreeing", "a", "b")).alias("p"))
    return best.select("p.*").distinct()


def unsettled(forest: DataFrame, roots: DataFrame, followers: int = FOLLOWERS) -> DataFrame:
    """node and root of the classes in regions where not every pair was a neighbour and more than
    one component is left, written once."""
    named = forest.select("region", "node").join(roots, "node", "left").select(
        "region", "node", F.coalesce("root", "node").alias("root")
    )
    crowded = (
        named.groupBy("region")
        .agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where((F.col("n") > followers + 1) & (F.col("low") != F.col("high")))
    )
    return stage(named.join(crowded.select("region"), "region").groupBy("node").agg(F.first("root").alias("root")), "unsettled")


def class_roots(
    documents: DataFrame, rows: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(node, root) of the classes with links. Pairs that are already connected are not tried."""
    forest = forest_rows(rows, percent)
    pairs = candidates(forest, percent)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = node_sets(documents, rows, nodes, key, text)
    first = stage(_best_partners(pairs), "best-pairs")
    roots = stage(components(stage(confirmed(first, sets, percent).distinct(), "links")), "roots")
    left = (
        pairs.join(first, ["a", "b"], "left_anti")
        .join(roots.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a", "left")
        .join(roots.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b", "left")
        .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
        .select("a", "b")
    )
    roots = merged(roots, stage(confirmed(stage(left, "rest-pairs"), sets, percent).distinct(), "links"))
    open_ = unsettled(forest, roots)
    sets = node_sets(documents, rows, open_.select("node"), key, text).join(open_, "node")
    late = stage(cross_pairs(sets, percent).join(pairs, ["a", "b"], "left_anti"), "late-pairs")
    return merged(roots, stage(confirmed(late, sets, percent).distinct(), "links"))


def near_duplicates(
    documents: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    rows = shingle_rows(documents, percent, key, text)
    return labelled(rows, class_roots(documents, rows, percent, key, text)).drop("row")


def labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Component of every row from the roots of the classes."""
    filled = rows.where("n_shingles > 0")
    firsts = filled.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    linked = roots.join(firsts, "node")
    heads = linked.groupBy("root").agg(F.min("first").alias("head"))
    moved = linked.join(heads, "root").select("node", "head")
    named = firsts.join(moved, "node", "left").select(
        "node", "n", F.coalesce("head", "first").alias("component_id")
    )
    slim = ["row", "doc_id", "n_shingles"]
    out = (
        hot_join(filled.select(*slim, "node"), named, "node", rows.count()).select(*slim, "component_id")
        .union(rows.where("n_shingles = 0").select(*slim, F.col("doc_id").alias("component_id")))
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(
    documents: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each group, all columns unchanged: the one with the smallest key."""
    rows, row_key, columns = with_row_key(documents, key)
    kept = near_duplicates(rows, percent, row_key, text).where("kept")
    kept = kept.select(F.col("doc_id").alias("_kept"))
    return rows.join(kept, rows[row_key] == kept["_kept"], "left_semi").select(*columns)
