"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a column that is true for a rejected document. ``order_rules`` measures on a
sample what a rule costs per row and what share it rejects; ``cascade`` then tries the rules
by falling rejection per cost and stops at the first hit. The order changes the time and the
rule named as the reason, never which documents are kept.

Defined results: a null text counts as empty (no words, so the base rules reject it); repeated
rows are judged alike; other columns of the input are not looked at; an empty table gives an
empty result and the declared order of the rules.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwise.session import stage

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` computed once: inside nested functions a plain column
    expression would be computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.octet_length(F.regexp_replace(text, "[^" + SYMBOLS + "]+", "")).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def repeated_lines(lines: Column) -> Column:
    """Lines equal to an earlier one."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the text.

    Windows are compared by hash. Only a text with a repeated hash pays for the sort that
    finds the places; each place then adds the words up to the next place or its own end.
    """

    def places(hashes: Column) -> Column:
        ranked = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return let(
            ranked,
            lambda rows: F.sort_array(
                F.transform(
                    F.filter(
                        rows,
                        lambda row, k: F.coalesce(row["h"] == F.get(rows, k + 1)["h"], F.lit(False))
                        | F.coalesce(
                            F.when(k > 0, row["h"] == F.get(rows, k - 1)["h"]), F.lit(False)
                        ),
                    ),
                    lambda row: row["i"],
                )
            ),
        )

    def covered(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda s, k: F.least(
                F.lit(window), F.coalesce(F.get(starts, k + 1) - s, F.lit(window))
            ).cast("long"),
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def in_text(words: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(1), F.size(words) - (window - 1)),
            lambda i: F.xxhash64(F.slice(words, i, F.lit(window))),
        )
        return let(
            hashes,
            lambda h: F.when(
                F.size(F.array_distinct(h)) < F.size(h), let(places(h), covered)
            ).otherwise(F.lit(0).cast("long")),
        )

    return F.when(F.size(words) > window, let(words, in_text)).otherwise(F.lit(0).cast("long"))


@dataclass(frozen=True)
class Measures:
    """What the rules look at. Each is a column that is only computed where it is used."""

    text: Column
    words: Column

    @property
    def n_words(self) -> Column:
        return F.size(self.words).cast("long")

    @property
    def word_chars(self) -> Column:
        return word_chars(self.words)

    @property
    def n_symbols(self) -> Column:
        return symbol_count(self.text)

    @property
    def n_lines(self) -> Column:
        return F.size(lines_with_words(self.text)).cast("long")

    @property
    def n_dup_lines(self) -> Column:
        return let(lines_with_words(self.text), repeated_lines)

    @property
    def n_repeat_words(self) -> Column:
        return repeated_words(self.words)

    @property
    def n_stutter(self) -> Column:
        """Words equal to the word before."""
        return let(
            self.words,
            lambda w: F.size(F.filter(w, lambda x, k: (k > 0) & (x == F.get(w, k - 1)))),
        ).cast("long")

    @property
    def n_worded(self) -> Column:
        """Words with a letter."""
        return F.size(F.filter(self.words, lambda w: w.rlike(r"\p{L}"))).cast("long")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[..., Column]


BASE_RULES = (
    Rule("too_few_words", lambda m: m.n_words < MIN_WORDS),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > MAX_REPEAT_PERCENT * m.n_words),
)
#: Thresholds of published web-corpus filters: symbols to words, mean word length,
#: share of repeated lines, share of words that repeat the one before or hold no letter.
EXTRA_RULES = (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule(
        "word_length",
        lambda m: (m.word_chars < 3 * m.n_words) | (m.word_chars > 15 * m.n_words),
    ),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
    Rule("stutter", lambda m: 10 * m.n_stutter > 3 * m.n_words),
    Rule("letterless", lambda m: 10 * m.n_worded < 7 * m.n_words),
)
RULES = BASE_RULES + EXTRA_RULES


def text_measures(text: str) -> tuple[Column, Callable[[Callable[[Measures], Column]], Column]]:
    """The text column without nulls, and a function that gives its lazy measures to a body."""
    value = F.coalesce(F.col(text), F.lit(""))
    return value, lambda body: let(
        F.struct(value.alias("text"), words_of(value).alias("words")),
        lambda both: body(Measures(both["text"], both["words"])),
    )


def cascade(measures: Measures, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null for a kept document. Later rules are
    not computed once one has rejected."""
    reason = None
    for rule in rules:
        hit = rule.rejects(measures)
        reason = (
            F.when(hit, F.lit(rule.name)) if reason is None else reason.when(hit, F.lit(rule.name))
        )
    return F.lit(None).cast("string") if reason is None else reason


@dataclass(frozen=True)
class RuleEstimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def rank(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def _seconds(job: DataFrame, runs: int = 3) -> tuple[float, object]:
    """Shortest time of a few runs, and the row; the first run also compiles."""
    times, row = [], None
    for _ in range(runs):
        began = time.perf_counter()
        row = job.first()
        times.append(time.perf_counter() - began)
    return min(times), row


def estimate_rules(
    documents: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = 2_000,
    seed: int = 7,
    repeats: int = 4,
) -> list[RuleEstimate]:
    """Seconds per sampled row and share rejected, one small job per rule.

    ``sample_rows`` is the expected size of the sample. It only steers the order of the rules.
    A job itself takes longer than most rules do on the sample, so every sampled row is judged
    ``repeats`` times, and the time of a job that only cuts the words, which all rules share, is
    taken off.
    """
    _, measured = text_measures(text)
    rows = documents.select(text)
    share = min(1.0, sample_rows / max(rows.count(), 1))
    sample = stage(rows.sample(fraction=share, seed=seed), "rule-sample")
    again = sample.select(text, F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("again"))

    def job(rejects: Callable[[Measures], Column]) -> DataFrame:
        hits = F.coalesce(measured(rejects), F.lit(False))
        return again.agg(F.count("*").alias("n"), F.sum(hits.cast("long")).alias("hits"))

    idle, _ = _seconds(job(lambda m: F.size(m.words) < 0))
    out = []
    for rule in rules:
        took, row = _seconds(job(rule.rejects))
        out.append(RuleEstimate(rule, max(took - idle, 1e-6) / max(row.n, 1), (row.hits or 0) / max(row.n, 1)))
    return out


def order_rules(documents: DataFrame, rules: Sequence[Rule] = RULES, **options) -> list[Rule]:
    """``rules`` by falling rejection per cost; rules that reject nothing go last, cheap ones first."""
    found = estimate_rules(documents, rules, **options)
    return [e.rule for e in sorted(found, key=lambda e: (-e.rank, e.seconds))]


def keep_good(
    documents: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text"
) -> DataFrame:
    """Rows that no rule rejects, all columns unchanged."""
    rules = order_rules(documents, text=text) if rules is None else rules
    _, measured = text_measures(text)
    return documents.where(measured(lambda m: cascade(m, rules)).isNull())


def quality_report(
    documents: DataFrame,
    rules: Sequence[Rule] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every measure of the base rules for every document, and the verdict of the cascade.

    All measures are wanted here, so they are computed once and the cascade reads them.
    """
    extra = order_rules(documents, EXTRA_RULES, text=text) if rules is None else rules
    _, measured = text_measures(text)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = documents.select(
        F.col(key).alias("doc_id"),
        measured(
            lambda m: let(
                F.struct(
                    m.text.alias("text"),
                    m.words.alias("words"),
                    *[getattr(m, name).alias(name) for name in names],
                ),
                lambda row: F.struct(
                    *[row[name].alias(name) for name in names],
                    cascade(_Read(row), extra).alias("reason"),
                ),
            )
        ).alias("m"),
    ).select("doc_id", "m.*")
    read = _Read({name: F.col(name) for name in names})
    failed = BASE_RULES[0].rejects(read)
    for rule in BASE_RULES[1:]:
        failed = failed | rule.rejects(read)
    return rows.select(
        "doc_id",
        *names,
        failed.alias("base_failed"),
        (~failed & F.col("reason").isNull()).alias("kept"),
    )


class _Read:
    """Measures that are there already; the others come from the text as before."""

    def __init__(self, row) -> None:
        self._row = row

    def __getattr__(self, name: str) -> Column:
        if name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
            return self._row[name]
        return getattr(Measures(self._row["text"], self._row["words"]), name)
