"""Token counts by compiled finite-state transducers.

A byte-level BPE vocabulary is compiled into two deterministic transducers.

The first reads character classes and marks where a pretoken begins. It has twelve states, so
a stretch of text from an unknown state is a map of twelve states. Texts are cut into chunks;
the maps of all chunks are computed side by side, composed by a parallel prefix scan (maps
compose associatively, a text's first chunk is a constant map), and a second pass from the
known states gives the marks.

The second reads the bytes of a pretoken; every transition carries the number of tokens that
the byte adds to (or takes from) the encoding of what was read so far. Its state is all that
later bytes can depend on: the longest suffix that begins some token, and for every place in
it the last token before and the tokens since. An encoding is right exactly when each of its
neighbouring pairs is, so the last token of a longer prefix is the one suffix token that pairs
with the token before it. States and transitions are compiled when first met and kept in
tables of bounded size; a full table is emptied, which costs time and changes nothing.

Special strings are cut out of the text first and count one each, as the library does.

Defined results: null and empty text has 0 bytes and 0 tokens; a null id is passed on;
repeated rows are counted alike; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from driftwise.llm.batches import in_batches
from driftwise.llm.words import in_groups

LIMIT = 512
CHUNK = 256
GROUP_BYTES = 1 << 20
#: Bounds of the compiled tables of one worker.
MOST_STATES = 250_000
MOST_PAIRS = 500_000
MOST_WORDS = 500_000

# -- pretokens -------------------------------------------------------------------------------

# Letters that can end a contraction ('s 't 'm 'd 're 've 'll), by class.
_CONTRACTION = {"s": 6, "t": 6, "m": 6, "d": 6, "r": 7, "v": 8, "l": 9, "e": 10}
LETTER, NUMBER, SPACE, BLANK, APOSTROPHE, OTHER, END = 0, 1, 2, 3, 4, 5, 11
CLASSES = 12
#: done, in letters, in numbers, in others, after ' at a start, after 'r 'v 'l there,
#: one space, one other blank, more blanks ending in a space or in another
STATES = ("done", "letters", "numbers", "others", "quote", "r", "v", "l", "space", "blank", "spaces", "blanks")
HERE, BEFORE = 1, 2  # marks: a pretoken begins at this character, at the one before


def _pretoken_table() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by state * CLASSES + class."""
    number = {s: i for i, s in enumerate(STATES)}
    letters = {LETTER, *_CONTRACTION.values()}
    fresh = {c: "letters" for c in letters} | {
        NUMBER: "numbers", OTHER: "others", APOSTROPHE: "quote", SPACE: "space", BLANK: "blank"
    }
    joined = {c: "letters" for c in letters} | {NUMBER: "numbers", OTHER: "others", APOSTROPHE: "others"}
    stays = {"letters": letters, "numbers": {NUMBER}, "others": {OTHER, APOSTROPHE}}
    ends = {"r": 10, "v": 10, "l": 9}
    after_quote = {6: "done", 7: "r", 8: "v", 9: "l", OTHER: "others", APOSTROPHE: "others"}

    def step(state: str, c: int) -> tuple[str, int]:
        if c == END:  # an unfinished contraction is a quote and a letter
            return "done", BEFORE if state in ends else 0
        if c in stays.get(state, ()):
            return state, 0
        if state == "quote" and c in after_quote:
            return after_quote[c], 0
        if state in ends:
            if c == ends[state]:
                return "done", 0
            return ("letters", BEFORE) if c in letters else (fresh[c], BEFORE | HERE)
        if state in ("space", "blank", "spaces", "blanks"):
            if c in (SPACE, BLANK):
                return ("spaces" if c == SPACE else "blanks"), 0
            # the last blank of several stands apart; a space joins what follows
            apart = BEFORE if state in ("spaces", "blanks") else 0
            return (joined[c], apart) if state in ("space", "spaces") else (fresh[c], apart | HERE)
        return fresh[c], HERE

    following = np.zeros(len(STATES) * CLASSES, dtype=np.uint8)
    marks = np.zeros(len(STATES) * CLASSES, dtype=np.uint8)
    for s, name in enumerate(STATES):
        for c in range(CLASSES):
            to, mark = step(name, c)
            following[s * CLASSES + c], marks[s * CLASSES + c] = number[to], mark
    return following, marks


@cache
def class_spans() -> list[tuple[int, int, int]]:
    """(first, past the last, class) of all code points that are letters, numbers or white space to
    the library, by its own patterns: its tables follow another release of the standard than Python's."""
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, codes))
    spans = []
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        found = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every)
        spans += [(codes[low], codes[high - 1] + 1, kind) for _, (low, high) in found]
    return spans


_classes: np.ndarray | None = None


def character_classes(spans: list[tuple[int, int, int]] | None = None) -> np.ndarray:
    """Class of every code point, filled once per process."""
    global _classes
    if _classes is None:
        table = np.full(0x110000, OTHER, dtype=np.uint8)
        for low, high, kind in class_spans() if spans is None else spans:
            table[low:high] = kind
        # encoded text has no surrogates; a span may run over their gap
        table[0xD800:0xE000] = OTHER
        table[32] = SPACE
        table[ord("'")] = APOSTROPHE
        for letter, c in _CONTRACTION.items():
            table[ord(letter)] = c
        _classes = table
    return _classes


_FOLLOWING, _MARKS = _pretoken_table()


def chunk_maps(chunks: np.ndarray) -> np.ndarray:
    """End state of every chunk from every state; all chunks and states step together."""
    state = np.broadcast_to(np.arange(len(STATES), dtype=np.uint8), (len(chunks), len(STATES))).copy()
    for column in np.ascontiguousarray(chunks.T):
        state = _FOLLOWING[state * np.uint8(CLASSES) + column[:, None]]
    return state


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Composition of each map with all before it, in a logarithmic number of rounds."""
    maps, reach = maps.copy(), 1
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2
    return maps


def pretoken_starts(texts: Sequence[str]) -> tuple[str, np.ndarray]:
    """The texts in a row, and the places where pretokens begin."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    # every text begins a chunk and is followed by an end mark at least
    per_text = sizes // CHUNK + 1
    first = np.cumsum(per_text) - per_text
    place = np.arange(len(codes)) + np.repeat(first * CHUNK - (np.cumsum(sizes) - sizes), sizes)
    flat = np.full(int(per_text.sum()) * CHUNK, END, dtype=np.uint8)
    flat[place] = character_classes()[codes]
    chunks = flat.reshape(-1, CHUNK)
    state = np.zeros(len(chunks), dtype=np.uint8)  # "done" at the start of a text
    if len(chunks) > len(texts):
        maps = chunk_maps(chunks)
        maps[first] = maps[first][:, :1]
        state[1:] = prefix_scan(maps)[:-1, 0]
        state[first] = 0
    marks = np.empty((CHUNK, len(chunks)), dtype=np.uint8)
    for i, column in enumerate(np.ascontiguousarray(chunks.T)):
        at = state * np.uint8(CLASSES) + column
        marks[i] = _MARKS[at]
        state = _FOLLOWING[at]
    marks = marks.T.reshape(-1)
    begins = (marks & HERE).astype(bool)
    begins[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return joined, np.flatnonzero(begins[place])


# -- tokens of a pretoken --------------------------------------------------------------------


class PretokenCounts(dict):
    """Token count of a pretoken, by the byte transducer; recent pretokens are remembered."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        spelled = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}

        def raw(token: str) -> bytes:
            return bytes([spelled[c] for c in token])

        model = given["model"]
        self.special = [t["content"] for t in given["added_tokens"]]
        self._id = {raw(t): i for t, i in model["vocab"].items() if t not in set(self.special)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._rank = {(raw(a), raw(b)): n for n, (a, b) in enumerate(pairs)}
        self._prefixes = {t[:n] for t in self._id for n in range(1, len(t) + 1)} | {b""}
        self._reset()

    def _reset(self) -> None:
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        #: state -> (suffix, last token at each place in it, tokens since each place)
        root = (b"", (b"",), (0,))
        self._states: list[tuple] = [root]
        self._numbers: dict[tuple, int] = {root: 0}
        self._steps: list[dict[int, tuple[int, int]]] = [{}]

    def _merged(self, raw: bytes) -> list[bytes]:
        """Plain merging by rank, for the few short strings that the compiler asks about."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            ranks = [self._rank.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and ranks[i] == best and self._rank.get((parts[i], parts[i + 1])) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _may_follow(self, last: bytes, token: bytes) -> bool:
        pair = (last, token)
        known = self._pairs.get(pair)
        if known is None:
            known = self._merged(last + token) == ([last, token] if last else [token])
            if len(self._pairs) >= MOST_PAIRS:
                self._pairs.clear()
            self._pairs[pair] = known
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state on a byte: next state and tokens added."""
        suffix, lasts, since = self._states[state]
        longer = suffix + bytes((byte,))
        for i in range(len(longer)):
            token = longer[i:]
            if token in self._id and self._may_follow(lasts[i], token):
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        added = 1 - since[i]
        keep = next(k for k in range(len(longer) + 1) if longer[k:] in self._prefixes)
        to = (
            longer[keep:],
            (*lasts[keep:], token),
            (*(n + added for n in since[keep:]), 0),
        )
        number = self._numbers.get(to)
        if number is None:
            number = len(self._states)
            self._numbers[to] = number
            self._states.append(to)
            self._steps.append({})
        self._steps[state][byte] = (number, added)
        return number, added

    def __missing__(self, pretoken: str) -> int:
        if len(self._states) > MOST_STATES:
            self._reset()
        state = total = 0
        steps = self._steps
        for byte in pretoken.encode("utf-8", "replace"):
            found = steps[state].get(byte)
            state, added = found if found is not None else self._compile(state, byte)
            total += added
        if len(pretoken) <= 48:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[pretoken] = total
        return total


_COUNTS: dict[str, PretokenCounts] = {}


def compiled(path: str) -> PretokenCounts:
    """One pair of transducers per worker process, kept between its tasks."""
    if path not in _COUNTS:
        _COUNTS[path] = PretokenCounts(path)
    return _COUNTS[path]


def count_tokens(texts: Sequence[str], counts: PretokenCounts) -> np.ndarray:
    """Tokens of every text."""
    pieces, owner, extra = [], [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        parts = [text]
        for special in counts.special:
            parts = [q for p in parts for q in p.split(special)] if special in text else parts
        extra[i] = len(parts) - 1
        kept = [p for p in parts if p]
        pieces += kept
        owner += [i] * len(kept)
    if not pieces:
        return extra
    joined, starts = pretoken_starts(pieces)
    places = starts.tolist()
    words = [joined[a:b] for a, b in zip(places, places[1:] + [len(joined)])]
    total = np.concatenate(([0], np.cumsum(np.fromiter(map(counts.__getitem__, words), dtype=np.int64, count=len(words)))))
    ends = np.searchsorted(starts, np.cumsum([len(p) for p in pieces]))
    per_piece = np.diff(total[np.concatenate(([0], ends))])
    return extra + np.bincount(owner, weights=per_piece, minlength=len(texts)).astype(np.int64)


def token_counts(
    documents: DataFrame, tokenizer: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document. ``tokenizer`` is the path of a
    byte-level BPE vocabulary."""
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema[key].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    spans = class_spans()  # seconds of work: once on the driver, about a thousand rows to the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        character_classes(spans)
        counts = compiled(tokenizer)
        for batch in batches:
            sizes = pc.binary_length(batch["text"]).fill_null(0).to_pylist()
            for low, high in in_groups([n + 64 for n in sizes], GROUP_BYTES):
                part = batch.slice(low, high - low)
                n = count_tokens([t or "" for t in part["text"].to_pylist()], counts)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(sizes[low:high], pa.int64()), pa.array(n), pa.array(n > limit)],
                    names=schema.fieldNames(),
                )

    given = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return in_batches(given, run, schema)
