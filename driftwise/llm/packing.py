"""Mixture-controlled packing of token streams into sequences of fixed length.

Every source is a queue of documents. Windows of ``window`` tokens are filled by deficit
round-robin: each queue is credited with its target share of the window, gives as many whole
tokens as its credit covers, and carries the rest as a deficit to the next window. Since a
document may be cut anywhere, a queue never waits with an unspendable credit, and what it has
given after ``w`` windows has a closed form, ``floor(amount * w / windows)``: the carried
deficit is the fraction that this floor takes off. So any document finds its windows and its
places in them from the totals of the queues and its own place in its queue, without a
sequential pass; the deficits run on over windows, files and partitions.

With other targets than the natural shares a queue can run dry. Then a new phase begins,
in which the remaining queues share the windows by their weights.

Plan: one pass tokenizes and writes the ids with their place inside (file, queue); the sums
per (file, queue), small, place every file; a second pass over the written ids cuts pieces.
No token is shuffled and nothing but the queues' totals reaches the driver.

Defined results: null or empty text has only the end id; a null source is a queue of its own;
repeated rows are packed as often as they occur; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches
from driftwise.session import stage

SEQUENCE = 2048
WINDOW = 64 * SEQUENCE
END_ID = 1
#: Queues whose totals the driver holds. Beyond it, sources share queues by hash.
MAX_QUEUES = 50_000
#: Words whose ids a task remembers, about 250 bytes each.
CACHE_WORDS = 400_000
#: Bytes of window layouts that a task remembers.
LAYOUT_BYTES = 32 << 20
#: Places of (part, queue) that are broadcast, about 60 bytes each.
BROADCAST_ROWS = 200_000


class WordIds(dict):
    """Ids of single words as little-endian 16-bit numbers, by the library's own merges.

    This kind of vocabulary lower-cases, ends words at white space and drops it, so a text's
    ids are its words' ids in a row. Latin-1 text is cut into words here; in other text every
    part between spaces that has other characters, or could hold a special string, goes to
    the library whole. Full tables are cleared.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        if self._tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self._model = self._tokenizer.model
        # letters and numbers among lower-cased Latin-1 characters
        letter, number = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
        self._words = re.compile(
            f"[{letter}]+|[{number}]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r \x85\xa0{letter}{number}]+"
        ).findall
        # byte-level spelling: printable bytes stand for themselves, the others follow U+0100
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        self._spelling = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def _keep(self, word: str, ids: list[int]) -> bytes:
        found = np.asarray(ids, dtype="<u2").tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found

    def __missing__(self, word: str) -> bytes:
        spelled = word
        if not (word.isascii() and word.isprintable()):
            spelled = "".join([self._spelling[b] for b in word.encode()])
        return self._keep(word, [token.id for token in self._model.tokenize(spelled)])

    def _whole(self, part: str) -> bytes:
        mark = " " + part  # no word has a space, so these never meet the words
        found = self.get(mark)
        if found is None:
            found = self._keep(mark, self._tokenizer.encode(part, add_special_tokens=False).ids)
        return found

    def of(self, text: str) -> bytes:
        if "<|" not in text and is_latin(text):
            return b"".join(map(self.__getitem__, self._words(text.lower())))
        return b"".join(
            [
                self._whole(part)
                if "<|" in part or not is_latin(part)
                else b"".join(map(self.__getitem__, self._words(part.lower())))
                for part in text.split(" ")
            ]
        )


def is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer per worker process, kept between its tasks."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def tokenized(
    documents: DataFrame, path: str, key: str, text: str, queue: str, end_id: int = END_ID
) -> DataFrame:
    """key, queue, ids, n, and the place in the stream of (part, queue), written once."""
    end = np.asarray([end_id], dtype="<u2").tobytes()
    kind = documents.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("queue", T.StringType()),
            T.StructField("part", T.LongType()),
            T.StructField("at", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = word_ids(path)
        part = TaskContext.get().partitionId()
        given: dict[str, int] = {}
        for batch in batches:
            # a few rows at a time: ids of long texts need room
            for low in range(0, batch.num_rows, 512):
                rows = batch.slice(low, 512)
                ids, at, n = [], [], []
                for queue_name, value in zip(rows["queue"].to_pylist(), rows["text"].to_pylist()):
                    found = find.of(value or "") + end
                    ids.append(found)
                    at.append(given.get(queue_name, 0))
                    n.append(len(found) // 2)
                    given[queue_name] = at[-1] + n[-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc_id"],
                        rows["queue"],
                        pa.array([part] * len(n), pa.int64()),
                        pa.array(at, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=schema.fieldNames(),
                )
        # a worker outlives its task, and the next stages need the memory
        find.clear()

    given = documents.select(
        F.col(key).alias("doc_id"), F.col(queue).alias("queue"), F.col(text).alias("text")
    )
    return stage(in_batches(given, run, schema), "packing-ids")


@dataclass(frozen=True)
class Phase:
    """A stretch in which no queue runs dry: ``taken[q]`` tokens from ``start[q]`` on, in
    ``windows`` windows; ``base`` tokens lie before it in the packed stream."""

    start: np.ndarray
    taken: np.ndarray
    windows: int
    base: int

    def given(self, window: int) -> np.ndarray:
        """Tokens each queue has given after ``window`` windows; int64 holds every product."""
        whole, rest = np.divmod(self.taken, self.windows)
        return whole * window + rest * window // self.windows


class Phases(Sequence):
    """All phases in memory of a few numbers per queue; a phase is computed when it is asked for.

    With ``rate`` tokens per unit of time a queue has given ``min(total, floor(rate * t))`` by
    the time t and runs dry at total / rate; a phase ends at each of these times. ``rest`` marks
    the queues without a target: they give nothing before the last phase and all they have in it.
    """

    def __init__(self, totals: np.ndarray, rates: np.ndarray, rest: np.ndarray, window: int) -> None:
        self.totals, self.rates, self.rest, self.window = totals, rates, rest, window
        with np.errstate(divide="ignore", invalid="ignore"):
            self.dry = np.where(rest, np.inf, totals / rates)
        self.ends = np.unique(self.dry[totals > 0])
        sums = [0, *(int(self.reached(p).sum()) for p in range(len(self.ends)))]
        # a phase in which no queue gives a whole token is none
        self.ends = self.ends[np.diff(sums) > 0]
        self.bases = np.array([0, *(n for low, n in zip(sums, sums[1:]) if n > low)], dtype=np.int64)

    def reached(self, p: int, q: int | slice = slice(None)) -> np.ndarray:
        """Tokens that queues have given by the end of phase ``p``."""
        if p < 0:
            return np.zeros_like(self.totals[q])
        end = self.ends[p]
        spent = np.floor(self.rates[q] * (end if np.isfinite(end) else 0.0))
        return np.where(self.dry[q] <= end, self.totals[q], np.minimum(spent, self.totals[q]).astype(np.int64))

    def holding(self, q: int, at: int) -> int:
        """The phase in which queue ``q`` gives its token ``at``."""
        if len(self.ends) == 1:
            return 0
        return bisect_right(range(len(self.ends)), at, key=lambda p: int(self.reached(p, q)))

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, p: int) -> Phase:
        if not 0 <= p < len(self):
            raise IndexError(p)
        start, base = self.reached(p - 1), int(self.bases[p])
        return Phase(start, self.reached(p) - start, -(-(int(self.bases[p + 1]) - base) // self.window), base)


def schedule(
    totals: Mapping[str, int], weights: Mapping[str, float] | None, window: int
) -> tuple[list[str], Phases]:
    """Queue names in round-robin order, and the phases."""
    names = sorted(totals)
    have = np.array([int(totals[q]) for q in names], dtype=np.int64)
    if weights is None:
        return names, Phases(have, np.zeros(len(names)), np.ones(len(names), dtype=bool), window)
    rates = np.array([max(float(weights.get(q, 0.0)), 0.0) for q in names])
    return names, Phases(have, rates, rates == 0, window)


def _pieces(
    names: list[str], phases: Phases, sequence: int
) -> Callable[[str, int, int], Iterator[tuple[int, int, int]]]:
    """(queue, first token, tokens) -> (start in the document, length, place in the packed stream)."""
    index = {q: i for i, q in enumerate(names)}
    layouts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    most = max(1, LAYOUT_BYTES // (24 * max(1, len(names))))
    opened: dict[int, Phase] = {}

    def phase_of(p: int) -> Phase:
        if p not in opened:
            if len(opened) >= most:
                opened.clear()
            opened[p] = phases[p]
        return opened[p]

    def layout(p: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per queue: first token, one past the last, and the place of the first."""
        if (p, window) not in layouts:
            if len(layouts) >= most:
                layouts.clear()
            phase = phase_of(p)
            low, high = phase.given(window), phase.given(window + 1)
            sizes = high - low
            places = phase.base + int(low.sum()) + np.concatenate(([0], np.cumsum(sizes)[:-1]))
            layouts[p, window] = (phase.start + low, phase.start + high, places)
        return layouts[p, window]

    def cut(queue: str, first: int, n: int) -> Iterator[tuple[int, int, int]]:
        q, at, end = index[queue], first, first + n
        while at < end:
            p = phases.holding(q, at)
            phase = phase_of(p)
            inside = at - int(phase.start[q])
            window = ((inside + 1) * phase.windows - 1) // int(phase.taken[q])
            low, high, places = layout(p, window)
            place = int(places[q]) + at - int(low[q])
            length = min(end, int(high[q])) - at
            while length:  # a sequence ends at every multiple of its length
                step = min(length, sequence - place % sequence)
                yield at - first, step, place
                at, place, length = at + step, place + step, length - step

    return cut


def _bucketed(rows: DataFrame, weights: Mapping[str, float], max_queues: int) -> DataFrame:
    """Sources with a weight keep their queue; the others share what is left of ``max_queues``."""
    left = max_queues - len(weights)
    if left < 1:
        raise ValueError(f"{len(weights)} weights leave no queue of {max_queues} for the other sources")
    bucket = F.pmod(F.xxhash64("_queue"), F.lit(left)).cast("string")
    if not weights:
        return rows.withColumn("_queue", bucket)
    named = F.broadcast(rows.sparkSession.createDataFrame([(f"={k}",) for k in weights], "_named string"))
    joined = rows.join(named, rows["_queue"] == named["_named"], "left")
    return joined.withColumn("_queue", F.coalesce(named["_named"], bucket)).drop(named["_named"])


def pack(
    documents: DataFrame,
    tokenizer: str,
    weights: Mapping[str, float] | None = None,
    sequence: int = SEQUENCE,
    window: int = WINDOW,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    with_ids: bool = False,
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    ``weights`` are target token shares by source; None takes the shares of the input, so
    that all queues end together. ``tokenizer`` is the path of the vocabulary file. Beyond
    ``max_queues`` sources, those without a weight share queues by hash.
    """
    name = F.col(source).cast("string")
    queue = F.coalesce(F.concat(F.lit("="), name), F.lit(""))
    rows = documents.withColumn("_queue", queue)
    if rows.select("_queue").distinct().limit(max_queues + 1).count() > max_queues:
        rows = _bucketed(rows, weights or {}, max_queues)
    ids = tokenized(rows, tokenizer, key, text, "_queue")
    sums = ids.groupBy("part", "queue").agg(F.sum("n").alias("n"))
    queues = sums.groupBy("queue").agg(F.sum("n").alias("n"), F.count("*").alias("parts")).collect()
    totals = {r["queue"]: r["n"] for r in queues}
    wanted = None if weights is None else {f"={k}": v for k, v in weights.items()}
    names, phases = schedule(totals, wanted, window)
    before = Window.partitionBy("queue").orderBy("part")
    places = sums.select(
        "part", "queue", (F.sum("n").over(before) - F.col("n")).alias("before")
    )
    # A row per (written part, queue); beyond the bound the ids are shuffled to their places.
    small = sum(r["parts"] for r in queues) <= BROADCAST_ROWS
    placed = ids.join(F.broadcast(places) if small else places, ["part", "queue"]).select(
        "doc_id", "queue", (F.col("before") + F.col("at")).alias("first"), "ids"
    )
    fields = [
        T.StructField("doc_id", documents.schema[key].dataType),
        *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")],
    ]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _pieces(names, phases, sequence)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                row, out, crc, kept = [], [], [], []
                firsts = part["first"].to_pylist()
                for i, (queue_name, ids) in enumerate(zip(part["queue"].to_pylist(), part["ids"])):
                    # 32-bit little-endian, as the checksum is defined over
                    wide = np.frombuffer(ids.as_buffer(), dtype="<u2").astype("<u4")
                    n = len(wide)
                    for start, length, place in cut(queue_name, firsts[i], n):
                        piece = wide[start : start + length]
                        row.append(i)
                        crc.append(zlib.crc32(piece))
                        out.append((start, length, n, place // sequence, place % sequence))
                        if with_ids:
                            kept.append(piece.tobytes())
                start, length, n, number, offset = np.array(out, dtype=np.int64).reshape(-1, 5).T
                columns = [
                    part["doc_id"].take(pa.array(row, pa.int64())),
                    *(pa.array(c, pa.int64()) for c in (start, length, crc, n, number, offset)),
                ]
                if with_ids:
                    columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return in_batches(placed, run, schema)
