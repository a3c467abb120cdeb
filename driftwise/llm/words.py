"""Words of whole texts as 64-bit hashes, computed over byte arrays many texts at a time.

Texts are taken in stretches of about a megabyte, cut where a separator stands, so memory
follows the stretch and the longest word and not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

STRETCH = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64 (a public finalizer of 64-bit generators)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


class Alphabet:
    """Which bytes separate words, and the value of every other byte (A-Z as a-z)."""

    def __init__(self, separators: Sequence[int]) -> None:
        self.is_word = np.ones(256, dtype=bool)
        self.is_word[list(separators)] = False
        self.value = constants(256, 11)
        self.value[65:91] = self.value[97:123]
        self.value[~self.is_word] = 0


#: Words between white space.
SPACED = Alphabet([32, *range(9, 14)])
#: Words of letters, digits and everything beyond ASCII.
ALPHANUMERIC = Alphabet([b for b in range(128) if not chr(b).isalnum()])

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << int(n - 1).bit_length()
        step = np.full(size, _BASE, dtype=np.uint64)
        back = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        step[0] = back[0] = 1
        _powers, _inverse = np.multiply.accumulate(step), np.multiply.accumulate(back)
    return _powers[:n], _inverse[:n]


def _hash_stretch(data: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Start of every word, and a hash of its bytes wherever it stands."""
    word = alphabet.is_word[data]
    turn = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = turn[::2], turn[1::2]
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    powers, inverse = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(alphabet.value[data] * powers[: len(data)], out=sums[1:])
    inner = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, mix(inner + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: Sequence[bytes], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the number of words of each text."""
    # a separator after every text keeps words apart
    data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    starts, hashes, low = [], [], 0
    while low < len(data):
        high = min(low + STRETCH, len(data))
        while high < len(data):
            gaps = np.flatnonzero(~alphabet.is_word[data[high : high + STRETCH]])
            if len(gaps):
                high += int(gaps[0])
                break
            high = min(high + STRETCH, len(data))
        at, found = _hash_stretch(data[low:high], alphabet)
        starts.append(at + low)
        hashes.append(found)
        low = high
    begins = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    edges = np.searchsorted(begins, np.concatenate(([0], np.cumsum(sizes))))
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), np.diff(edges)


_ORDER = constants(64, 23)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, order included."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += words[k : k + n] * _ORDER[k % len(_ORDER)] ^ np.uint64(k)
    return mix(total + np.uint64(size))


def text_shingles(
    words: np.ndarray, counts: np.ndarray, size: int
) -> Iterator[np.ndarray]:
    """Distinct shingles of each text, sorted; a text of fewer words is one shingle of them all."""
    runs = shingles(words, size)
    low = 0
    for n in counts.tolist():
        if n >= size:
            yield np.unique(runs[low : low + n - size + 1])
        elif n:
            yield shingles(words[low : low + n], n)
        else:
            yield np.zeros(0, dtype=np.uint64)
        low += n


def in_groups(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``most``."""
    low = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield low, i
            low, total = i, 0
        total += n
    if low < len(sizes):
        yield low, len(sizes)
