"""Ranked lexical search: the terms of all items are counted in the text itself, by one automaton.

The items are the small side. Their distinct terms, each between two separators, form an
Aho-Corasick automaton; a document is translated (separators to a space, A-Z to a-z) and read
once, and the automaton's outputs are the terms' occurrences, so there is no index of documents.
An output leads to the items that hold its term.

Plan, for every block of items: one pass over the texts writes, per document, its number of
terms and the occurrences of item terms (short lists of numbers). Document frequencies and
totals are sums over that table. A second pass over it adds up scores, documents by items at a
time, and every task keeps the best rows of each item, which two rounds of row numbers merge.

Items are dealt to blocks of about ``BLOCK_BYTES`` of text, so what is sent to the tasks is
bounded by that, or by the longest single item. Every block scans all documents.

Defined results: a null or empty text has no term, neither as document nor as item; documents
without terms do not count in N; repeated documents and repeated items are ranked each for
itself; equal scores are ordered by the key, a missing key last; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from driftwise.llm.batches import in_batches
from driftwise.llm.words import STRETCH, in_groups
from driftwise.session import stage

TOP = 20
#: Text of the items whose automaton is in memory at a time; a node takes about 50 bytes.
BLOCK_BYTES = 1 << 19
#: Cells of a table of scores, and products added up, at a time.
CELLS = 1 << 19
#: First merge of the tasks' best rows: so many groups an item.
GROUPS = 64

_FOLDED = bytes(
    (b | 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def folded(text: bytes) -> bytes:
    """A-Z as a-z, every separator a space; bytes beyond ASCII belong to terms."""
    return text.translate(_FOLDED)


def stretches(data: bytes, size: int = STRETCH) -> Iterator[bytes]:
    """Parts of folded text, cut at spaces, with a space on both sides."""
    low = 0
    while low < len(data):
        high = data.find(b" ", low + size) if low + size < len(data) else -1
        high = len(data) if high < 0 else high
        yield b" " + data[low:high] + b" "
        low = high


def term_count(padded: bytes) -> int:
    word = np.frombuffer(padded, dtype=np.uint8) != 32
    return int(np.count_nonzero(word[1:] & ~word[:-1]))


def automaton_of(terms: list[bytes]) -> ahocorasick.Automaton:
    """Finds ' term ' and gives the term's number; a byte is a character here."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, term in enumerate(terms):
        found.add_word(f" {term.decode('latin-1')} ", i)
    found.make_automaton()
    return found


def occurrences(automaton: ahocorasick.Automaton, text: bytes) -> tuple[int, Counter]:
    """Number of terms of a text, and how often each term of the automaton stands in it."""
    n, found = 0, Counter()
    for part in stretches(folded(text)):
        n += term_count(part)
        # a space closes one term and opens the next: all outputs are wanted, overlapping ones too
        found.update(map(itemgetter(1), automaton.iter(part.decode("latin-1"))))
    return n, found


def _lists(rows: list[Counter]) -> tuple[pa.Array, pa.Array]:
    offsets = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
    terms = pa.array([t for r in rows for t in r], pa.int32())
    counts = pa.array([n for r in rows for n in r.values()], pa.int64())
    return pa.ListArray.from_arrays(offsets, terms), pa.ListArray.from_arrays(offsets, counts)


def term_hits(documents: DataFrame, terms: list[bytes], key: str, text: str) -> DataFrame:
    """doc_id, n, terms (their numbers) and tf of every document with a term, written once."""
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema[key].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType(), False)),
            T.StructField("tf", T.ArrayType(T.LongType(), False)),
        ]
    )
    sent = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(sent.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                sizes, found = [], []
                for value in part["text"]:
                    n, counts = occurrences(automaton, value.as_py() or b"")
                    sizes.append(n)
                    found.append(counts)
                rows = pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(sizes, pa.int64()), *_lists(found)], names=schema.fieldNames()
                )
                yield rows.filter(pa.array([n > 0 for n in sizes], pa.bool_()))

    given = documents.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    return stage(in_batches(given, run, schema), "term-hits")


class Best:
    """The best rows of every item seen so far; equal scores by ascending key."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.least = np.ones(items, dtype=np.int64)
        self.parts: list[pa.Table] = []
        self.rows, self.most = 0, 1 << 16

    def add(self, scores: np.ndarray, keys: pa.Array) -> None:
        row, item = np.nonzero(scores >= self.least)
        if len(row):
            self.parts.append(
                pa.table({"item": item.astype(np.int32), "score": scores[row, item], "doc_id": keys.take(pa.array(row))})
            )
            self.rows += len(row)
            if self.rows > self.most:
                self.most = max(1 << 16, 4 * self.cut().num_rows)

    def cut(self) -> pa.Table:
        table = pa.concat_tables(self.parts).sort_by(
            [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")]
        ).combine_chunks()
        item = table["item"].to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = np.flatnonzero(place == self.top - 1)
        self.least[item[last]] = table["score"].to_numpy()[last]
        table = table.filter(pa.array(place < self.top))
        self.parts, self.rows = [table], table.num_rows
        return table


def _scored(hits: DataFrame, items: list, postings: tuple, weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    """item, item_id, doc_id, score: the best rows of every task."""
    schema = T.StructType(
        [
            T.StructField("item", T.IntegerType()),
            T.StructField("item_id", items[1]),
            T.StructField("doc_id", hits.schema["doc_id"].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    sent = hits.sparkSession.sparkContext.broadcast((items[0], postings, weights))
    id_type = to_arrow_type(items[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, (starts, of_item, times), weight = sent.value
        best = Best(len(names), top)
        for batch in batches:
            offsets = batch["terms"].offsets.to_numpy()
            term = batch["terms"].values.to_numpy()
            tf = batch["tf"].values.to_numpy()
            # Python's numbers: 25 * n * N may pass 64 bits
            m = np.array([75 + 25 * n * n_docs // n_terms for n in batch["n"].to_pylist()], dtype=np.int64)
            wide = np.concatenate(([0], np.cumsum(starts[term + 1] - starts[term])))
            work = np.maximum(wide[offsets[1:]] - wide[offsets[:-1]], len(names))
            for low, high in in_groups(work.tolist(), CELLS):
                a, b = offsets[low], offsets[high]
                row = np.repeat(np.arange(high - low), np.diff(offsets[low : high + 1]))
                t, n = term[a:b], tf[a:b]
                gain = weight[t] * (1_000_000_000 * n // (1000 * n + 12 * m[low + row]))
                size = starts[t + 1] - starts[t]
                # the postings of all these terms in a row
                at = np.repeat(starts[t] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                scores = np.zeros((high - low) * len(names), dtype=np.int64)
                np.add.at(scores, np.repeat(row * len(names), size) + of_item[at], np.repeat(gain, size) * times[at])
                best.add(scores.reshape(-1, len(names)), batch["doc_id"].slice(low, high - low))
        if best.parts:
            table = best.cut()
            item_id = pa.array(names, type=id_type).take(table["item"].combine_chunks())
            found = pa.table([table["item"], item_id, table["doc_id"], table["score"]], names=schema.fieldNames())
            yield from found.to_batches(max_chunksize=10_000)

    return in_batches(hits, run, schema)


def _postings(rows: list) -> tuple[list[bytes], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Terms of all items, and per term the items that hold it and how often."""
    holders: dict[bytes, list[tuple[int, int]]] = {}
    for i, row in enumerate(rows):
        for term, n in Counter(folded(bytes(row["text"] or b"")).split()).items():
            holders.setdefault(term, []).append((i, n))
    starts = np.cumsum([0, *map(len, holders.values())])
    pairs = np.array([p for held in holders.values() for p in held], dtype=np.int64).reshape(-1, 2)
    return list(holders), (starts, pairs[:, 0].copy(), pairs[:, 1].copy())


def _block(documents: DataFrame, rows: list, item_type: T.DataType, key: str, text: str, top: int) -> DataFrame | None:
    terms, postings = _postings(rows)
    if not terms:
        return None
    hits = term_hits(documents, terms, key, text)
    n_docs, n_terms = hits.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    held = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = np.zeros(len(terms), dtype=np.int64)
    for r in held.collect():  # a row per term of the block at most
        weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    found = _scored(hits, ([r["item_id"] for r in rows], item_type), postings, weights, n_docs, n_terms, top)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS))).orderBy(*order)
    every = Window.partitionBy("item").orderBy(*order)
    return (
        found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )


def ranked(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item with a score above 0."""
    given = items.select(
        F.col(f"`{item_key}`").alias("item_id"), F.col(f"`{item_text}`").cast("binary").alias("text")
    )
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text"), F.lit(blocks))
    item_type = given.schema["item_id"].dataType
    parts = [
        _block(documents, given.where(block == b).collect(), item_type, key, text, top) for b in range(blocks)
    ]
    parts = [p for p in parts if p is not None]
    if not parts:
        schema = T.StructType(
            [
                T.StructField("item_id", item_type),
                T.StructField("rank", T.IntegerType()),
                T.StructField("doc_id", documents.schema[key].dataType),
                T.StructField("score", T.LongType()),
            ]
        )
        return documents.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
