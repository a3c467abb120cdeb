"""Decontamination against a plain search of every window."""

import random
import re

import pytest
from pyspark.sql import types as T

from driftwise.llm.decontamination import contamination

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for doc, text in docs:
        own = words(text)
        hit, found = set(), set()
        for item, item_text in items:
            wanted = words(item_text)
            n = min(10, len(wanted))
            windows = {tuple(wanted[i : i + n]) for i in range(len(wanted) - n + 1)} if n else set()
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= {str(item)} if item is not None else set()
        out.append((doc, len(own), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    found = contamination(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **options)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("few", [0, 100_000])
def test_equals_a_plain_search(spark, few):
    """Once with the windows broadcast and once with shuffled joins."""
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "中文", "x1"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 4, 9, 10, 11, 25])))) for i in range(25)]
    items += [(3, items[9][1]), (40, items[9][1].upper()), (None, items[10][1]), (41, None)]
    docs = []
    for i in range(60):
        parts = rng.choices(vocabulary, k=rng.randrange(40))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = (rng.choice(items)[1] or "").split()[: rng.randrange(4, 30)]
        docs.append((i, rng.choice([" ", ", ", "-", "\n"]).join(parts)))
    docs += [(100, None), (101, ""), (102, "!?"), (None, items[9][1]), (5, docs[5][1])]
    assert run(spark, docs, items, broadcast_windows=few) == brute(docs, items)


def test_long_documents_and_overlapping_occurrences(spark):
    item = " ".join(f"q{i}" for i in range(30))
    text = ("filler " * 50_000) + item + " " + item + (" filler" * 50_000) + " q0 q1 q2 q3 q4 q5 q6 q7 q8"
    docs, items = [(1, text), (2, "ab " * 40)], [(1, item), (2, "ab ab ab"), (3, " ".join(["filler"] * 12))]
    assert run(spark, docs, items) == [(1, 100_069, 100_060, ["1", "3"]), (2, 40, 40, ["2"])]


def test_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c")], DOCS).selectExpr("*", "1 AS row", "2 AS places", "3 AS n", "4 AS `a.b`")
    items = spark.createDataFrame([(1, "a b")], ITEMS).selectExpr("*", "1 AS words", "2 AS size")
    assert [(r.n_hit, r["items"]) for r in contamination(docs, items).collect()] == [(2, ["1"])]
    assert [(r.n_hit, r["items"]) for r in contamination(docs, items.limit(0)).collect()] == [(0, [])]
    assert contamination(docs.limit(0), items).collect() == []
