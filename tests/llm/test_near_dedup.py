"""Near-duplicates against all pairs, on groups, chains, dense regions and odd tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from driftwise.llm import near_dedup
from driftwise.llm.components import components
from driftwise.llm.dense_links import cross_pairs
from driftwise.llm.near_dedup import near_duplicates, smallest_set
from driftwise.llm.words import ALPHANUMERIC, SPACED, shingles, word_hashes

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                head[high] = low
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def run(spark, rows):
    return sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()))


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.random():.6f}"
    return out


def test_groups_chains_and_limits(spark):
    rng = random.Random(3)
    texts = []
    for g in range(25):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([5, 6, 12, 60, 200, 400]))]
        texts.append(base)
        for _ in range(rng.randrange(6)):  # some edits of edits: chains that leave the limit
            texts.append(edited(rng.choice([base, texts[-1]]), rng, rng.randrange(4)))
        texts.append([w.upper() for w in base] if g % 3 else base[::-1])
    rows = list(enumerate(" ".join(t) for t in texts))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n"), (len(rows) + 3, "a b"), (len(rows) + 4, "A\tB")]
    assert run(spark, rows) == brute(rows)


def test_dense_region_is_connected(spark):
    """Many edits of one text, of which most pairs lie above and some below the limit."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(edited(base, rng, rng.randrange(1, 5)))) for i in range(250)]
    shared = " ".join(f"s{i}" for i in range(60))
    rows += [(1000 + i, shared + " " + " ".join(f"u{i}x{k}" for k in range(60))) for i in range(60)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize(("percent", "orders", "depth", "least"), [(85, 25, 5, 92), (80, 32, 4, 84), (90, 21, 6, 100), (50, 64, 2, 42)])
def test_the_forest_follows_the_limit(percent, orders, depth, least):
    assert near_dedup.forest_shape(percent) == (orders, depth) and near_dedup.least_agreeing(percent) == least


def test_a_limit_beyond_the_signature_is_refused(spark):
    with pytest.raises(ValueError):
        near_duplicates(spark.createDataFrame([(1, "a b")], SCHEMA), 5)


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_between_80_and_85(spark, percent):
    """Pairs of 100 shingles with nine to twelve changed: 0.835, 0.818, 0.802 and 0.786."""
    rows, want = [], []
    for g in range(2400):
        n = 9 + g % 4
        base = [f"g{g}w{i}" for i in range(104)]
        linked = 100 * (100 - n) >= percent * (100 + n)
        for k, words in enumerate((base, base[:-n] + [f"g{g}c{i}" for i in range(n)])):
            rows.append((2 * g + k, " ".join(words)))
            want.append((2 * g + k, 100, 2 * g + k * (not linked), not (linked and k)))
    for (_, x), (_, y), linked in zip(rows[:40:2], rows[1:40:2], [w[2] % 2 == 0 for w in want[1:40:2]]):
        one, two = shingle_set(x), shingle_set(y)
        assert (100 * len(one & two) >= percent * len(one | two)) == linked
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(8), percent).collect()))
    assert got == want


def test_links_hidden_in_a_dense_region(spark):
    """Texts that share a long passage and are no copies, with a few copies among them."""
    rng = random.Random(11)
    passage = [f"s{i}" for i in range(310)]
    texts = [passage + [f"u{i}x{k}" for k in range(36)] for i in range(700)]
    for i in rng.sample(range(700), 60):
        copy = list(texts[i])
        copy[-24:] = [f"c{i}x{k}" for k in range(24)]
        texts.append(copy)
    rows = list(enumerate(" ".join(t) for t in texts))
    assert run(spark, rows) == brute(rows)


def test_prefix_join_finds_all_similar_pairs_of_different_roots(spark):
    rng = random.Random(13)
    sets = []
    for g in range(60):
        base = [rng.randrange(10**9) for _ in range(rng.choice([6, 7, 20, 45, 130]))]
        for _ in range(4):
            n = rng.randrange(len(base) // 5 + 1)
            sets.append(set(base[n:] if rng.random() < 0.5 else base[: len(base) - n] + [rng.randrange(10**9) for _ in range(n // 2)]))
    rows = [(i.to_bytes(2, "big"), (i - i % 2 if i % 3 else i).to_bytes(2, "big"), sorted(s)) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "node binary, root binary, set array<long>")
    got = {(bytes(r.a), bytes(r.b)) for r in cross_pairs(df, 85).collect()}
    want = set()
    for x, (a, root_a, s) in enumerate(rows):
        for b, root_b, t in rows[x + 1 :]:
            common = len(set(s) & set(t))
            if root_a != root_b and 100 * common >= 85 * (len(s) + len(t) - common):
                want.add((a, b))
    assert len(want) > 50 and want <= got
    assert len(got) < 3 * len(want)


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (5, text), (5, text), (7, text.upper()), (None, None), (None, "alone in here with no other one")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS row", "3 AS kept", "4 AS `a.b`")
    out = sorted(map(str, map(tuple, near_duplicates(df).collect())))
    assert out == sorted(map(str, [(None, 3, 5, False), (5, 3, 5, True), (5, 3, 5, True), (7, 3, 5, False), (None, 0, None, True), (None, 3, None, True)]))
    assert near_duplicates(df.limit(0)).collect() == []


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, k) for k in range(2, 40)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {k: 1 for k in range(1, 40)} | {200 + i: 200 for i in range(9)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_smallest_set():
    assert smallest_set(85) == 6 and smallest_set(80) == 4


@pytest.mark.parametrize("alphabet", [SPACED, ALPHANUMERIC])
def test_word_hashes_do_not_depend_on_the_place(monkeypatch, alphabet):
    from driftwise.llm import words as module

    texts = [b"the cat  THE Cat\nsat", b"", b"  ", b"x" * 5000 + b" the", "é ü the".encode(), b"cat the"]
    whole, counts = word_hashes(texts, alphabet)
    assert counts.tolist() == [5, 0, 0, 2, 3, 2]
    the = whole[0]
    assert whole[2] == the and whole[6] == the and whole[9] == the and whole[11] == the and whole[1] == whole[3] == whole[10]
    assert len(set(whole.tolist())) == 6
    monkeypatch.setattr(module, "STRETCH", 7)
    again, _ = word_hashes(texts, alphabet)
    assert np.array_equal(whole, again)
    assert len(set(shingles(whole, 2).tolist())) == len(set(zip(whole.tolist(), whole.tolist()[1:])))
