"""License scans: winnowed fingerprints pick candidates, banded alignment decides.

Both templates and documents become sequences of lower-cased words. Of every ``WINNOW``
neighbouring ``GRAM``-word shingles the smallest hash is a fingerprint, so any common run of
GRAM + WINNOW - 1 words shares one. The inverted index leads from a fingerprint to its places
in the templates; hits of one template on near diagonals form a candidate, and a local
alignment in a band around them gives the matched words. A template is reported with the
share of its words that matched, and the span of the match in code points of the text.

A short notice must match but for an eighth of its words; of a full text (``LONG`` words or
more) half is enough. A report that spans a word of another variant
(``Lesser``, ``NC``), or not all such words of its own, falls. Of
overlapping reports the one with the most matched words, less the other words it spans, stays.

The index holds the given templates only, a few thousand numbers, and goes with the tasks;
documents are read once and nothing is shuffled.

Defined results: null, empty and wordless texts and documents without a license give no rows;
a null id is passed on; repeated rows are reported alike; an empty table gives no rows; of equal
reports the one with the larger coverage, then the earlier one stays. Very long texts are scanned
whole; a band is aligned only if enough template words occur in it, so that repeated boilerplate
costs a comparison per band.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches
from driftwise.llm.license_texts import LICENSE_TEXTS, VARIANT_WORDS
from driftwise.llm.words import ALPHANUMERIC, in_groups, shingles, word_hashes

GRAM = 3
WINNOW = 3
LONG = 40
GROUP_BYTES = 1 << 20
MATCH, MISS, GAP = 2, -1, -1
_WORDS = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def fingerprints(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the shingles that are smallest in some window; of a sequence too
    short for a window all shingles."""
    found = shingles(words, GRAM)
    if len(found) <= WINNOW:
        return np.arange(len(found)), found
    smallest = found[: len(found) - WINNOW + 1].copy()
    for k in range(1, WINNOW):
        np.minimum(smallest, found[k : k + len(smallest)], out=smallest)
    chosen = np.zeros(len(found), dtype=bool)
    for k in range(WINNOW):
        chosen[k : k + len(smallest)] |= found[k : k + len(smallest)] == smallest
    at = np.flatnonzero(chosen)
    return at, found[at]


class TemplateIndex:
    """Fingerprint -> places in templates."""

    def __init__(self, templates: Sequence[tuple[str, str]]) -> None:
        self.names = [name for name, _ in templates]
        self.words = [word_hashes([text.encode()], ALPHANUMERIC)[0] for _, text in templates]
        variants = [[word_hashes([w.encode()], ALPHANUMERIC)[0].tolist() for w in v] for v in VARIANT_WORDS]
        own = [set(words.tolist()) for words in self.words]
        variants = [{w for (name,), others in variants if name in o for w in others} for o in own]
        #: words of other variants that a report of the template must not span, and its own that it must
        self.foreign = [v - o for v, o in zip(variants, own)]
        self.needed = [v & o for v, o in zip(variants, own)]
        places = defaultdict(list)
        for t, words in enumerate(self.words):
            for at, value in zip(*fingerprints(words)):
                places[int(value)].append((t, int(at)))
        self.places = dict(places)
        self.values = np.array(sorted(places), dtype=np.uint64)

    def least(self, template: int) -> int:
        """Words that must match."""
        n = len(self.words[template])
        return -(-n // 2) if n >= LONG else n - n // 8

    def known(self, values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.values, values)
        at[at == len(self.values)] = 0
        return self.values[at] == values


def _band(template: np.ndarray, words: np.ndarray, centre: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the words of a cell are equal, and whether the cell lies inside the document, by
    template word and diagonal."""
    j = np.arange(len(template))[:, None] + np.arange(centre - band, centre + band + 1)
    inside = (j >= 0) & (j < len(words))
    return inside & (words[np.clip(j, 0, len(words) - 1)] == template[:, None]), inside


def align(template: np.ndarray, words: np.ndarray, centre: int, band: int) -> tuple[int, int, int]:
    """Matched words, first and one past the last matched word of the best local alignment,
    over cells whose diagonal (word - template word) is within ``band`` of ``centre``."""
    same, inside = _band(template, words, centre, band)
    n, width = same.shape
    places = np.arange(width)
    score = np.zeros((n + 1, width + 1), dtype=np.int64)  # a column of zeros on the right
    step = np.zeros((n + 1, width), dtype=np.int8)
    for i in range(1, n + 1):
        straight = score[i - 1, :-1] + np.where(same[i - 1], MATCH, MISS)
        missing = score[i - 1, 1:] + GAP  # a template word is missing
        before = np.where(inside[i - 1], np.maximum(straight, missing), -n)
        # words inserted: the best place to the left, less what the way from there costs
        row = np.maximum.accumulate(before - GAP * places) + GAP * places
        row[~inside[i - 1] | (row < 0)] = 0
        score[i, :-1] = row
        step[i] = np.where(row > before, 3, np.where(missing > straight, 2, 1)) * (row > 0)
    top = int(score.argmax())  # the first of equal ones
    i, k = divmod(top, width + 1)
    value = score[i, k]
    matched, first, last = 0, 0, 0
    while value and step[i, k]:
        j, way = i + centre - band + k, step[i, k]
        if way == 1:
            if template[i - 1] == words[j - 1]:
                matched, first, last = matched + 1, j - 1, last or j
            i -= 1
        elif way == 2:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return matched, first, last


def matches(words: np.ndarray, index: TemplateIndex) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first, one past the last) found in a document's words."""
    at, values = fingerprints(words)
    hit = index.known(values)
    hits = defaultdict(list)
    for p, value in zip(at[hit].tolist(), values[hit].tolist()):
        for t, place in index.places[value]:
            hits[t].append((p - place, p))
    found = set()
    for t, places in hits.items():
        size = len(index.words[t])
        band = 4 + size // 8
        places.sort()
        low = 0
        for i in range(1, len(places) + 1):
            # diagonals that a band can hold, at most a band apart, are aligned together
            if i == len(places) or places[i][0] - places[low][0] > band:
                centre = (places[low][0] + places[i - 1][0]) // 2
                low = i
                # no alignment matches more than the template words that occur in the band at all
                if _band(index.words[t], words, centre, band)[0].any(axis=1).sum() < index.least(t):
                    continue
                matched, first, last = align(index.words[t], words, centre, band)
                spanned = set(words[first:last].tolist())
                if matched >= index.least(t) and index.foreign[t].isdisjoint(spanned) and index.needed[t] <= spanned:
                    found.add((t, matched, first, last))
    out: list[tuple[int, int, int, int]] = []
    ranked = sorted(found, key=lambda f: (f[3] - f[2] - 2 * f[1], -f[1] / len(index.words[f[0]]), f[2], f[0]))
    for t, matched, first, last in ranked:
        if all(last <= a or first >= b for _, _, a, b in out):
            out.append((t, matched, first, last))
    return sorted(out, key=lambda f: f[2])


def scan_licenses(
    documents: DataFrame,
    templates: Sequence[tuple[str, str]] = LICENSE_TEXTS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, license, template (its number), matched and template words, coverage, start and
    end of every license wording found."""
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema[key].dataType),
            T.StructField("license", T.StringType()),
            T.StructField("template", T.IntegerType()),
            T.StructField("matched_words", T.LongType()),
            T.StructField("template_words", T.LongType()),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
    names = schema.fieldNames()[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(templates)
        for batch in batches:
            sizes = pc.binary_length(batch["text"]).fill_null(0).to_pylist()
            for low, high in in_groups([n + 64 for n in sizes], GROUP_BYTES):
                part = batch.slice(low, high - low)
                texts = [t or "" for t in part["text"].to_pylist()]
                words, counts = word_hashes([t.encode("utf-8", "replace") for t in texts], ALPHANUMERIC)
                edges = np.concatenate(([0], np.cumsum(counts)))
                # shingles over the whole group say which documents are worth a look
                owners = np.searchsorted(edges, np.flatnonzero(index.known(shingles(words, GRAM))), side="right") - 1
                rows, found = [], []
                for d in np.unique(owners).tolist():
                    own = words[edges[d] : edges[d + 1]]
                    spans = None
                    for t, matched, first, last in matches(own, index):
                        spans = spans or [m.span() for m in _WORDS.finditer(texts[d])]
                        n = len(index.words[t])
                        rows.append(d)
                        found.append((index.names[t], t, matched, n, matched / n, spans[first][0], spans[last - 1][1]))
                columns = list(zip(*found)) if found else [()] * len(names)
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names=schema.fieldNames(),
                )

    given = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return in_batches(given, run, schema)
