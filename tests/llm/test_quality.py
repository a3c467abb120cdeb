"""Quality measures against a plain count, and the cascade against all rules at once."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.quality import EXTRA_RULES, RULES, Measures, Rule, cascade, estimate_rules, keep_good, order_rules, quality_report, text_measures

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
WORD = r"[^\x20\x09-\x0D]+"
PROSE = " ".join(f"word{i} in a line of prose" for i in range(30))
TEXTS = [
    None, "", " \n\t", "one", PROSE, PROSE + "\n" + PROSE, "a b c d e f g h " * 5, "a b c d e f g h a b c d e f g h i",
    "same line here\n" * 12, "x # $ % & | < > *", "\x0b\x0c\r\x1c \x85 　 é\u0000b", "é" * 50_000, "w " * 3_000,
    "\n\n a \n a\n a \n", "!! ?? 12 34 " * 9, " ".join(f"t{i % 9}" for i in range(40)), "a" + " b" * 8, "This This This that that that " * 5,
]


def plain(text):
    text = text or ""
    words = re.findall(WORD, text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = len({i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(8)})
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), covered,
            n < 20 or 100 * covered > 30 * n)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA)


def test_measures_equal_a_plain_count(docs):
    for r in quality_report(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == plain(TEXTS[r.doc_id]), r.doc_id
        assert not (r.kept and r.base_failed)


def test_the_order_of_the_rules_changes_no_verdict(docs):
    kept = [sorted(r.doc_id for r in keep_good(docs, rules).collect()) for rules in (None, RULES, RULES[::-1], order_rules(docs))]
    assert kept[0] == kept[1] == kept[2] == kept[3] == sorted(r.doc_id for r in quality_report(docs).where("kept").collect())
    assert 4 in kept[0]


def test_a_later_rule_is_not_computed_for_a_rejected_document(docs):
    """A rule that fails on short texts never sees them behind one that rejects them."""
    short = Rule("short", lambda m: m.n_words < 5)
    breaks = Rule("breaks", lambda m: F.when(m.n_words < 5, F.raise_error(F.lit("seen")).cast("boolean")).otherwise(False))
    _, measured = text_measures("text")
    names = docs.select(measured(lambda m: cascade(m, [short, breaks])).alias("reason")).collect()
    assert {r.reason for r in names} == {"short", None}
    with pytest.raises(Exception, match="seen"):
        docs.select(measured(lambda m: cascade(m, [breaks, short]))).collect()


def test_rules_are_ordered_by_rejection_per_cost(docs):
    found = {e.rule.name: e for e in estimate_rules(docs, RULES)}
    ordered = [found[r.name] for r in order_rules(docs, RULES)]
    assert all(e.seconds > 0 and 0 <= e.rejected <= 1 for e in ordered) and len(ordered) == len(RULES)


def test_a_costly_rule_is_ranked_by_its_cost(spark):
    texts = spark.createDataFrame([(i, PROSE + f" {i}") for i in range(1500)], SCHEMA).repartition(8)
    slow = Rule("slow", lambda m: F.aggregate(F.sequence(F.lit(1), 400 + F.size(m.words)), F.lit(0), lambda a, i: (a + i) % 7) >= 0)
    quick = [Rule(f"quick{k}", lambda m, k=k: F.size(m.words) > k) for k in range(2)]
    for _ in range(10):
        assert order_rules(texts, [slow, *quick])[-1].name == "slow"


def test_plan_has_no_python(docs):
    plan = quality_report(docs, EXTRA_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_clashing_names_repeats_and_empty_tables(docs):
    odd = docs.union(docs).selectExpr("*", "1 AS n_words", "2 AS words", "3 AS reason", "4 AS m", "5 AS `a.b`")
    assert quality_report(odd, RULES).count() == 2 * len(TEXTS)
    assert keep_good(odd).columns == odd.columns
    assert quality_report(docs.limit(0)).collect() == [] and keep_good(docs.limit(0)).collect() == []
    assert isinstance(Measures(F.col("text"), F.col("text")), Measures)
