"""Personal data: plain identifiers, and disguised ones by offset-preserving transducers.

The base rules find e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers
as they are written. The transducers then rewrite a line: look-alike and full-width characters
to ASCII, invisible ones away, ``[at]`` and ``dot`` to their signs, spelled digits to digits.
Every character they give carries the span of source characters it came from, so what the base
rules find in the rewritten line maps back to exact positions in the source. Only spans that
were disguised and reach beyond the base spans of their kind are added.

All rules run in time linear in the text. Only lines that hold a disguise are rewritten.

Defined results: null and empty text has no spans; repeated rows are reported alike; a null id
is passed on; an empty table gives no rows. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits can only match from its first digit on
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest local part before it and a dotted domain after it. A scan
    from every start of a long word would take quadratic time."""
    free, at = 0, text.find("@")
    while at >= 0:
        local = text[free:at]
        start = free + len(local.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that hold; failing ones are dropped."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        # longer parts with leading zeros can still be small numbers
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Letters of other alphabets that look like the ASCII letter before the colon.
LOOKALIKES = (
    "a:аα c:с d:ԁ e:еε g:ɡ h:һ i:іıι j:ј k:кκ l:ӏ m:м n:п o:оοσ p:рρ q:ԛ r:г s:ѕ t:тτ u:υ v:νѵ w:ԝω x:хχ y:уγ "
    "A:АΑ B:ВΒ C:СϹ E:ЕΕ H:НΗ I:ІΙӀ J:Ј K:КΚ M:МΜ N:Ν O:ОΟ P:РΡ S:Ѕ T:ТΤ X:ХΧ Y:ҮΥ Z:Ζ"
)
# Characters without width.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
# Digits as words, in the order of their value.
SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGIT_OF = {w: str(n) for line in SPELLED for n, w in enumerate(line.split())} | {"oh": "0"}

_PLAIN = {c: group[0] for group in LOOKALIKES.split() for c in group[2:]}
_PLAIN |= {c: "" for c in INVISIBLE} | {c: "-" for c in "‐‑‒–—−"} | {c: " " for c in "\u00a0\u2007\u202f"} | {"。": "."}


def _plain_char(c: str) -> str:
    if c in _PLAIN:
        return _PLAIN[c]
    if c < "\u0250":
        return c
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if len(folded) == 1 and folded.isascii() else c


class Aligned:
    """Rewritten text, and for every character of it the source span it came from."""

    def __init__(self, text: str, begins: list[int], ends: list[int]) -> None:
        self.text, self.begins, self.ends = text, begins, ends

    @classmethod
    def of(cls, source: str) -> Aligned:
        """The character transducer: look-alikes to ASCII, invisible characters away."""
        kept, begins = [], []
        for i, c in enumerate(source):
            plain = c if c.isascii() else _plain_char(c)
            if plain:
                kept.append(plain), begins.append(i)
        # invisible characters inside an identifier belong to it, those after it do not
        return cls("".join(kept), begins, [b + 1 for b in begins])

    def rewrite(self, pattern: re.Pattern, give: Callable[[re.Match], list[tuple[str, int, int]]]) -> Aligned:
        """Replaces every match by characters that ``give`` names with their place in this text."""
        pieces, begins, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            pieces.append(self.text[at : m.start()])
            begins += self.begins[at : m.start()]
            ends += self.ends[at : m.start()]
            for c, s, e in give(m):
                pieces.append(c), begins.append(self.begins[s]), ends.append(self.ends[e - 1])
            at = m.end()
        if not at:
            return self
        return Aligned(
            "".join(pieces) + self.text[at:], begins + self.begins[at:], ends + self.ends[at:]
        )


# Bounds keep every search linear: a local part has 64 characters at most, a label 63.
_GAP = r"[ \t]{0,4}"
# Character references of the at sign and the point.
_AT_REFERENCE = r"&(?:#0{0,6}64|#x0{0,6}40|commat);"
_DOT_REFERENCE = r"&(?:#0{0,6}46|#x0{0,6}2e|period);"
_BRACKETED_AT = rf"(?:{_GAP}[\[({{<]{_GAP}(?:at|arroba|@){_GAP}[\])}}>]{_GAP}|{_GAP}{_AT_REFERENCE}{_GAP})"
_SPACED = r"(?:[ \t_]{1,4}|\.)"
_SPELLED_DOT = rf"(?:{_GAP}[\[({{<]{_GAP}(?:dot|punkt|point|punto|\.){_GAP}[\])}}>]{_GAP}|{_DOT_REFERENCE}|{_SPACED}(?:dot|punto){_SPACED})"
# Endings that make "x at y dot z" an address whatever y is.
ENDINGS = "com|org|net|edu|gov|mil|int|info|biz|io|ai|app|dev|eu|de|at|ch|fr|be|es|it|nl|pl|pt|ru|se|uk|us|ca|au|br|mx|in|jp|cn|co|me|tv|example|test|invalid|local"
# Words before (a single) and after a "dot" in sentences about dots; any other word there is a name or an ending.
NO_NAME = "a|an|another|any|each|every|her|his|its|my|one|our|polka|that|the|their|this|your"
NO_ENDING = "and|but|for|from|notation|of|on|or|plot|plots|product|products|that|the|then|was|were|when|where|which|with"
_LABEL = "[A-Z0-9-]{1,63}"
#: What follows a spelled at: the last dot is spelled too.
_SPELLED_DOMAIN = (
    rf"(?:(?!(?:{NO_NAME}){_SPELLED_DOT}{_LABEL}+(?!{_SPELLED_DOT})){_LABEL}(?:(?:\.|{_SPELLED_DOT}){_LABEL}){{0,7}}{_SPELLED_DOT}(?!(?:{NO_ENDING})(?![A-Z0-9]))[A-Z]{{2,63}}(?![A-Z0-9])"
    rf"|{_LABEL}(?:{_SPELLED_DOT}{_LABEL}){{0,7}}{_SPELLED_DOT}(?:{ENDINGS})(?![A-Z0-9]))"
)
#: An address whose at sign or dots are disguised. A plain " at " counts only before a spelled
#: dot. Where underscores or points join the words, the local part ends before the joined at.
_ADDRESS = re.compile(
    rf"(?i)(?<![A-Z0-9._%+-])(?:(?:[A-Z0-9_%+-]{{1,64}}(?:\.|{_SPELLED_DOT})){{0,6}}+[A-Z0-9_%+-]{{1,64}}+"
    rf"(?:(?P<sign>{_BRACKETED_AT}|{_GAP}@{_GAP}){_LABEL}(?:(?:\.|{_SPELLED_DOT}){_LABEL}){{1,8}}"
    rf"|(?P<spelled>[ \t_]{{1,4}}(?:at|arroba)[ \t_]{{1,4}}){_SPELLED_DOMAIN})"
    rf"|(?:[A-Z0-9%+-]{{1,64}}+(?:_{{1,4}}|\.)){{0,6}}?[A-Z0-9%+-]{{1,64}}+(?P<joined>(?:_{{1,4}}|\.)at{_SPACED}){_SPELLED_DOMAIN})"
)
_DOT = re.compile(rf"(?i){_SPELLED_DOT}")
_LOOSE_POINT = r"[ \t]{1,4}\.[ \t]{1,4}"
#: An address with room around its at sign and its last point; only before a known ending, since
#: sentences too have points with room around them.
_LOOSE = re.compile(
    rf"(?i)(?<![A-Z0-9._%+-])(?:[A-Z0-9_%+-]{{1,64}}(?:\.|{_LOOSE_POINT})){{0,3}}+[A-Z0-9_%+-]{{1,64}}+(?P<sign>{_GAP}@{_GAP})"
    rf"{_LABEL}(?:(?:\.|{_LOOSE_POINT}){_LABEL}){{0,4}}{_LOOSE_POINT}(?:{ENDINGS})(?![A-Z0-9])"
)
_LOOSE_DOT = re.compile(_LOOSE_POINT)
_NUMBER_DOT = rf"(?:{_SPELLED_DOT}|{_LOOSE_POINT})"
#: Four numbers between points, some of them disguised, or all with room around them.
_QUAD = re.compile(
    rf"(?i)(?<![0-9.])[0-9]{{1,3}}(?:(?:(?:\.|{_SPELLED_DOT})[0-9]{{1,3}}){{3}}|(?:{_LOOSE_POINT}[0-9]{{1,3}}){{3}})(?![0-9])"
)
_QUAD_DOT = re.compile(rf"(?i){_NUMBER_DOT}")
#: Card digits with letters that look like 0 and 1 among them.
_LETTERED = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl](?:[ -]?[0-9OoIl]){12,18}(?![A-Za-z0-9])")
_DIGIT_LETTER = {"O": "0", "o": "0", "I": "1", "l": "1"}
_WORD_OF_DIGIT = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_DIGIT = rf"(?:\b(?:{_WORD_OF_DIGIT})\b|[0-9]+)"
_DIGIT_GAP = rf"(?:{_GAP}(?:\bdot\b|\.){_GAP}|{_GAP}[-,]{_GAP}|[ \t]{{1,4}})"
_RUN = re.compile(rf"(?i)(?:(?:\bplus\b|\+){_GAP})?+{_DIGIT}(?:{_DIGIT_GAP}{_DIGIT}){{3,}}+")
_RUN_PART = re.compile(rf"(?i)(?P<plus>\bplus\b|\+)|(?P<word>\b(?:{_WORD_OF_DIGIT})\b)|(?P<digits>[0-9]+)|(?P<dot>\bdot\b|\.)")
#: What a line must hold to be rewritten at all.
_DISGUISE = re.compile(
    rf"[^\x00-\u024f]|\u00ad|\u00a0|(?i:(?<![^\W_])(?:dot|arroba)(?![^\W_])|[\[({{<]{_GAP}(?:at|arroba|@|dot|punkt|point|punto|\.){_GAP}[\])}}>]"
    rf"|{_AT_REFERENCE}|{_DOT_REFERENCE}|[ \t]\.[ \t]{{1,4}}(?:[0-9]|(?:{ENDINGS})(?![A-Z0-9]))|[0-9][ -]?[oil]{{1,3}}[ -]?[0-9]"
    rf"|\b(?:{_WORD_OF_DIGIT})\b[ \t,.-]{{1,4}}(?:{_WORD_OF_DIGIT})\b)"
)


def _pointed(m: re.Match, low: int, high: int, dot: re.Pattern) -> list[tuple[str, int, int]]:
    """A stretch with every disguised point as one."""
    out, text = [], m.string
    for s in dot.finditer(text, low, high):
        out += [(text[i], i, i + 1) for i in range(low, s.start())]
        out.append((".", s.start(), s.end()))
        low = s.end()
    return out + [(text[i], i, i + 1) for i in range(low, high)]


def _signs(m: re.Match) -> list[tuple[str, int, int]]:
    """The at and dot transducer inside one address."""
    begin, end = m.span("sign" if m["sign"] else "spelled" if m["spelled"] else "joined")
    return [*_pointed(m, m.start(), begin, _DOT), ("@", begin, end), *_pointed(m, end, m.end(), _DOT)]


def _loose_signs(m: re.Match) -> list[tuple[str, int, int]]:
    begin, end = m.span("sign")
    return [*_pointed(m, m.start(), begin, _LOOSE_DOT), ("@", begin, end), *_pointed(m, end, m.end(), _LOOSE_DOT)]


def _quad_dots(m: re.Match) -> list[tuple[str, int, int]]:
    return _pointed(m, m.start(), m.end(), _QUAD_DOT)


def _lettered_digits(m: re.Match) -> list[tuple[str, int, int]]:
    """Letters as the digits they look like, where most characters are digits."""
    letters = sum(c in _DIGIT_LETTER for c in m[0])
    give = _DIGIT_LETTER if 0 < letters <= 4 else {}
    return [(give.get(m.string[i], m.string[i]), i, i + 1) for i in range(m.start(), m.end())]


def _digits(m: re.Match) -> list[tuple[str, int, int]]:
    """The digit transducer: words to digits, gaps away. Runs of fewer than three words stay."""
    parts = list(_RUN_PART.finditer(m.string, m.start(), m.end()))
    if sum(p["word"] is not None for p in parts) < 3:
        return [(m.string[i], i, i + 1) for i in range(m.start(), m.end())]
    out = []
    for p in parts:
        if p["word"]:
            out.append((DIGIT_OF[p["word"].lower()], p.start(), p.end()))
        elif p["digits"]:
            out += [(m.string[i], i, i + 1) for i in range(p.start(), p.end())]
        else:
            out.append(("+" if p["plus"] else ".", p.start(), p.end()))
    return out


def disguised_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans in source characters of identifiers that only the rewritten lines show."""
    if not _DISGUISE.search(text):
        return []
    out, low = [], 0
    for line in text.split("\n"):
        if _DISGUISE.search(line):
            aligned = Aligned.of(line).rewrite(_ADDRESS, _signs).rewrite(_LOOSE, _loose_signs).rewrite(_QUAD, _quad_dots)
            aligned = aligned.rewrite(_RUN, _digits).rewrite(_LETTERED, _lettered_digits)
            for kind, s, e in base_spans(aligned.text):
                start, end = low + aligned.begins[s], low + aligned.ends[e - 1]
                if text[start:end] != aligned.text[s:e]:
                    out.append((kind, start, end))
        low += len(line) + 1
    known: dict[str, list[tuple[int, int]]] = {}
    for kind, s, e in base:
        known.setdefault(kind, []).append((s, e))
    return [
        (kind, s, e)
        for kind, s, e in dict.fromkeys(out)
        if not any(b <= s and e <= f for b, f in known.get(kind, ()))
    ]


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans, by kind and start."""
    base = base_spans(text)
    order = {k: i for i, k in enumerate(KINDS)}
    spans = sorted(base + disguised_spans(text, base), key=lambda x: (order[x[0]], x[1], x[2]))
    return base, spans


def redacted(text: str) -> str:
    """The text with every stretch of spans replaced by the kind of its first."""
    out, at = [], 0
    for s, e, kind in sorted((s, e, kind) for kind, s, e in all_spans(text)[1]):
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_personal_data(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the count of base spans of each kind, base_sha256 and spans of every document."""
    counts = [f"n_{k}" for k in KINDS]
    schema = T.StructType(
        [T.StructField("doc_id", documents.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in counts]
        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers: list[list[int]] = [[] for _ in KINDS]
            digests, joined = [], []
            for value in batch["text"]:
                base, spans = all_spans(value.as_py() or "")
                for k, n in zip(KINDS, numbers):
                    n.append(sum(kind == k for kind, _, _ in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(spans))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    *(pa.array(n, pa.int64()) for n in numbers),
                    pa.array(digests, pa.string()),
                    pa.array(joined, pa.string()),
                ],
                names=schema.fieldNames(),
            )

    given = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return in_batches(given, run, schema)


def redact(documents: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data replaced; the column of text lengths follows."""
    at = documents.columns.index(text)
    lengths = documents.columns.index(n_chars) if n_chars in documents.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(at).to_pylist()
            clean = [None if t is None else redacted(t) for t in given]
            columns = list(batch.columns)
            columns[at] = pa.array(clean, columns[at].type)
            if lengths is not None:
                old = columns[lengths].to_pylist()
                columns[lengths] = pa.array(
                    [n if c is None or c == g else len(c) for n, c, g in zip(old, clean, given)],
                    columns[lengths].type,
                )
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    # Python stages take no dots in names, and names may be repeated
    names = [f"c{i}" for i in range(len(documents.columns))]
    plain = documents.toDF(*names)
    return in_batches(plain, run, plain.schema).toDF(*documents.columns)
