"""Benchmark decontamination as a prefix-filtered set join with exact checks.

Every benchmark item is cut into windows of ``window`` consecutive words (a shorter item is
one window). A document holds a window only if it holds every shingle of it, so one shingle
is enough to find it: the rarest in the corpus, counted in a first pass over all documents.
A second pass emits a document's places of such shingles with the words around them. The join
on the shingle gives candidates; the place of the shingle in the window bounds where the
window would begin and end, and the words in between decide.

Both passes drop shingles that cannot match by a bit table whose size is bounded; what slips
through fails the join. The windows are broadcast while they are few and joined by a shuffle
beyond that, so the benchmark may grow with the corpus.

Words are compared by 64-bit hashes (a ten-word window by 640 bits).

Defined results: null, empty and wordless texts have no words and no hits; such items have no
windows; equal item ids count once and a null item id is not listed; repeated documents are
reported each; an empty benchmark leaves every document clean; empty documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches
from driftwise.llm.tables import with_row_key
from driftwise.llm.words import ALPHANUMERIC, in_groups, shingles, word_hashes
from driftwise.session import stage

WINDOW = 10
SHINGLE = 5
GROUP_BYTES = 1 << 20
#: Bits of the table that rules shingles out: 16 for each, 32 MiB at most.
MOST_BITS = 28
#: Windows (about 250 bytes each) up to which they are broadcast.
BROADCAST_WINDOWS = 100_000


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """About a megabyte of text at a time: the rows, their word hashes, words per row."""
    for batch in batches:
        sizes = pc.binary_length(batch["text"]).fill_null(0).to_pylist()
        for low, high in in_groups([n + 64 for n in sizes], GROUP_BYTES):
            part = batch.slice(low, high - low)
            texts = [(t or "").encode("utf-8", "replace") for t in part["text"].to_pylist()]
            yield (part, *word_hashes(texts, ALPHANUMERIC))


def item_windows(benchmark: DataFrame, window: int, key: str, text: str) -> DataFrame:
    """item_id, words (hashes of the window's words) and size of every window, written once."""
    schema = T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("size", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, counts in _texts(batches):
            ids, found, sizes, low = [], [], [], 0
            for item, n in zip(part["item_id"].to_pylist(), counts.tolist()):
                size = min(window, n)
                for at in range(low, low + n - size + 1) if n else ():
                    ids.append(item), found.append(words[at : at + size].tobytes()), sizes.append(size)
                low += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(found, pa.binary()), pa.array(sizes, pa.int32())],
                names=schema.fieldNames(),
            )

    given = benchmark.select(F.col(key).cast("string").alias("item_id"), F.col(text).alias("text"))
    return stage(in_batches(given, run, schema).distinct(), "item-windows")


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """words, size, offset, shingle and its size, for every shingle of every distinct window."""
    schema = T.StructType(
        [
            T.StructField("words", T.BinaryType()),
            T.StructField("size", T.IntegerType()),
            T.StructField("offset", T.IntegerType()),
            T.StructField("shingle", T.LongType()),
            T.StructField("shingle_size", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for words, size in zip(batch["words"].to_pylist(), batch["size"].to_pylist()):
                k = min(shingle, size)
                found = shingles(np.frombuffer(words, dtype=np.uint64), k).view(np.int64)
                rows += [(words, size, i, s, k) for i, s in enumerate(found.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f) for c, f in zip(
                    zip(*rows) if rows else [[]] * 5,
                    (pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32()),
                )],
                names=schema.fieldNames(),
            )

    return in_batches(windows.select("words", "size").distinct(), run, schema)


class BitTable:
    """Which shingles may be wanted. Its size is bounded whatever their number."""

    def __init__(self, wanted: DataFrame) -> None:
        spark = wanted.sparkSession
        n, sizes = wanted.agg(F.count("*"), F.collect_set("shingle_size")).first()
        self.sizes = sorted(sizes)
        bits = min(MOST_BITS, max(10, (16 * max(n, 1)).bit_length()))
        slot = F.expr(f"shiftrightunsigned(shingle, 6) & {(1 << (bits - 6)) - 1}")
        rows = (
            wanted.groupBy(slot.alias("slot"))
            .agg(F.expr("bit_or(shiftleft(1L, CAST(shingle & 63 AS INT)))").alias("bits"))
            .toPandas()
        )
        table = np.zeros(1 << (bits - 6), dtype=np.int64)
        table[rows["slot"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
        self._table = spark.sparkContext.broadcast(table.view(np.uint64))

    def places(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shingle size, first word, shingle) of the shingles inside one text that may be wanted."""
        table = self._table.value
        text = np.repeat(np.arange(len(counts)), counts)
        for k in self.sizes:
            found = shingles(words, k)
            slots = (found >> np.uint64(6)) & np.uint64(len(table) - 1)
            at = np.flatnonzero((table[slots] >> (found & np.uint64(63))) & np.uint64(1))
            at = at[text[at] == text[at + k - 1]]
            yield k, at, found[at]


def shingle_counts(documents: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """Occurrences in all documents of the shingles that the windows hold, added up per
    megabyte before the shuffle."""
    table = BitTable(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, counts in _texts(batches):
            for k, _, found in table.places(words, counts):
                values, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(np.full(len(values), k, dtype=np.int32)), pa.array(n, pa.int64())],
                    names=["shingle", "shingle_size", "n"],
                )

    counted = in_batches(documents.select(F.col(text).alias("text")), run, "shingle long, shingle_size int, n long")
    return counted.groupBy("shingle", "shingle_size").agg(F.sum("n").alias("n"))


def rarest_shingles(of_windows: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per window that may occur: the shingle that the fewest places have."""
    known = of_windows.join(counts, ["shingle", "shingle_size"], "left")
    best = known.groupBy("words", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset", "shingle_size")).alias("best")
    )
    # a shingle that no document has rules its windows out
    return best.where("best.n > 0").select(
        "words", "size", "best.shingle", F.col("best.offset").alias("offset"), "best.shingle_size"
    )


_PLACE = T.StructType(
    [
        T.StructField("at", T.LongType()),
        T.StructField("shingle", T.LongType()),
        T.StructField("shingle_size", T.IntegerType()),
        T.StructField("lead", T.IntegerType()),
        T.StructField("around", T.BinaryType()),
    ]
)


def document_places(documents: DataFrame, wanted: DataFrame, window: int, key: str, text: str) -> DataFrame:
    """row, doc_id, n_words and the places of wanted shingles of every document, written once."""
    table = BitTable(wanted)
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", documents.schema[key].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("places", T.ArrayType(_PLACE)),
        ]
    )
    kind = pa.list_(
        pa.struct([("at", pa.int64()), ("shingle", pa.int64()), ("shingle_size", pa.int32()), ("lead", pa.int32()), ("around", pa.binary())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part, words, counts in _texts(batches):
            edges = np.concatenate(([0], np.cumsum(counts)))
            places: list[list[dict]] = [[] for _ in range(len(counts))]
            for k, at, found in table.places(words, counts):
                docs = np.searchsorted(edges, at, side="right") - 1
                for p, d, s in zip(at.tolist(), docs.tolist(), found.view(np.int64).tolist()):
                    low, high = max(int(edges[d]), p - window + k), min(int(edges[d + 1]), p + window)
                    places[d].append(
                        {"at": p - int(edges[d]), "shingle": s, "shingle_size": k, "lead": p - low, "around": words[low:high].tobytes()}
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(counts))),
                    part["doc_id"],
                    pa.array(counts, pa.int64()),
                    pa.array(places, kind),
                ],
                names=schema.fieldNames(),
            )
            row += len(counts)

    given = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return stage(in_batches(given, run, schema), "document-places")


def _covered(spans: Column) -> Column:
    """Words inside the union of sorted (begin, end) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("until"))
    return F.aggregate(
        spans,
        start,
        lambda seen, s: F.struct(
            (seen["n"] + F.greatest(s["end"] - F.greatest(s["begin"], seen["until"]), F.lit(0))).alias("n"),
            F.greatest(s["end"], seen["until"]).alias("until"),
        ),
        lambda seen: seen["n"],
    )


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids as strings) and spans (hit stretches
    of words, which may overlap) of every document."""
    by_item = item_windows(benchmark, window, item_key, item_text)
    of_windows = stage(window_shingles(by_item, shingle), "window-shingles")
    wanted = of_windows.select("shingle", "shingle_size").distinct()
    counts = shingle_counts(documents, wanted, text)
    prefixes = stage(rarest_shingles(of_windows, counts), "prefix-shingles")
    rows = document_places(
        documents, prefixes.select("shingle", "shingle_size").distinct(), window, key, text
    )
    few = by_item.count() <= broadcast_windows
    small = F.broadcast if few else lambda df: df
    first = (F.col("lead") - F.col("offset")) * 8 + 1
    hits = (
        rows.where(F.size("places") > 0)
        .select("row", F.explode("places").alias("place"))
        .select("row", "place.*")
        .join(small(prefixes), ["shingle", "shingle_size"])
        # the window must lie inside the words around the place, and be them
        .where((F.col("offset") <= F.col("lead")) & (F.octet_length("around") >= first - 1 + F.col("size") * 8))
        .where(F.substring(F.col("around"), first, F.col("size") * 8) == F.col("words"))
        .select(
            "row",
            "words",
            (F.col("at") - F.col("offset")).alias("begin"),
            (F.col("at") - F.col("offset") + F.col("size")).alias("end"),
        )
    )
    hits = stage(hits, "window-hits")
    spans = hits.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    items = (
        hits.select("row", "words").distinct()
        .join(small(by_item.select("words", "item_id")), "words")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    return (
        rows.select("row", "doc_id", "n_words")
        .join(spans.join(items, "row"), "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("items").cast("long"), F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")).alias("spans"),
        )
    )


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Documents without any window of the benchmark, all columns unchanged."""
    rows, row_key, columns = with_row_key(documents, key)
    found = contamination(rows, benchmark, key=row_key, text=text, **options)
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("_hit"))
    return rows.join(hit, rows[row_key] == hit["_hit"], "left_anti").select(*columns)
