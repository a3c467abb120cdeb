"""Ranked search against a plain count of terms."""

import math
import random
import re

import pytest

from driftwise.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(documents, items, top=20):
    docs = [(key, terms(text)) for key, text in documents]
    docs = [d for d in docs if d[1]]
    n_docs, n_terms = len(docs), sum(len(d[1]) for d in docs)
    df = {}
    for _, words in docs:
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for key, words in docs:
            m, score = 75 + 25 * len(words) * n_docs // n_terms, 0
            for t in terms(text):
                tf = words.count(t)
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1)))
                score += weight * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, key is None, key))
        for rank, (score, _, key) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, key, -score))
    return out


def found(spark, documents, items, **options):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r) for r in lexical.ranked(docs, wanted, **options).collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["ab", "AB", "a", "b", "zz9", "Été", "été", "x1", "中文", "straße", "q", "rare"]
    gaps = [" ", ", ", "\n", "-", "\x00", "@[`{", "\x7f", "  "]

    def text(n):
        return "".join(rng.choice(words[: rng.randint(2, 12)]) + rng.choice(gaps) for _ in range(n))

    documents = [(i, text(rng.randint(0, 40))) for i in range(150)]
    documents += [(200 + i, "ab zz9 rare") for i in range(30)]  # ties
    documents += [(7, "ab zz9 rare"), (7, "ab zz9 rare"), (None, "ab zz9 rare"), (300, None), (301, ""), (302, " ,-"), (303, "nothing here")]
    items = [(i, text(rng.randint(1, 12))) for i in range(25)]
    items += [(90, "ab ab Zz9"), (91, None), (92, ""), (93, "unseen"), (94, "rare"), (94, "rare"), (None, "q q")]
    return documents, items


def test_ranks_equal_a_plain_count(spark, texts):
    assert in_order(found(spark, *texts)) == in_order(brute(*texts))


def test_blocks_do_not_change_the_ranks(spark, texts):
    assert in_order(found(spark, *texts, block_bytes=250, top=3)) == in_order(brute(*texts, top=3))


def test_small_groups_and_early_cuts(spark, texts, monkeypatch):
    best = lexical.Best(len(texts[1]), 4)
    best.most = 1  # the cut must not lose a tie
    assert best.least.min() == 1
    monkeypatch.setattr(lexical, "CELLS", 64)
    assert in_order(found(spark, *texts, top=4)) == in_order(brute(*texts, top=4))


def test_long_texts_are_read_whole(spark):
    long = "filler " * 400_000 + "Needle" + ", filler" * 10 + " x" * 100 + "y" * 2_000_000 + " needle"
    documents, items = [(1, long), (2, "needle filler"), (3, "filler")], [(1, "needle filler")]
    assert found(spark, documents, items) == brute(documents, items)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_stretches_hold_whole_terms(size):
    text = "ab  cd ef a b ab-ab ab " + "z" * 60 + " ab"
    parts = list(lexical.stretches(lexical.folded(text.encode()), size))
    assert [w for p in parts for w in p.decode().split()] == terms(text)
    assert sum(map(lexical.term_count, parts)) == len(terms(text))


def test_terms_need_both_boundaries():
    automaton = lexical.automaton_of([b"ab", "é".encode(), b"b"])
    assert lexical.occurrences(automaton, "ab,ab abb xab É é ab9 9 b".encode()) == (9, {0: 2, 1: 1, 2: 1})


def test_empty_tables_and_other_columns(spark):
    assert found(spark, [], [(1, "a")]) == [] == found(spark, [(1, "a")], [])
    assert found(spark, [(1, None)], [(1, "a")]) == [] == found(spark, [(1, "a")], [(1, ".")])
    docs = spark.createDataFrame([("k", "a b", 1, 2, 3)], "`d.id` string, text string, n int, terms int, item_id int")
    items = spark.createDataFrame([("i", "a", 1)], "item_id string, body string, doc_id int")
    rows = lexical.ranked(docs.withColumnRenamed("d.id", "key"), items, key="key", item_text="body").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in rows] == [("i", 1, "k")]
