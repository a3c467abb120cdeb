"""Packing against the library's ids, and the schedule against a sequential round-robin."""

import pickle
import time
import zlib

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from driftwise.llm import packing
from driftwise.llm.tables import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
WORDS = packing.WordIds(PATH)
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType())]
)
ODD = [
    "a\x1cb c\x1fd\x00 \x85\xa0x", "It's we'LL 'S ''s don't'", "<|endoftext|>a <|endoftext|> b<|x", "ΑΣ ΑΣΑ Σ İx ǅ",
    "é 가 ﬁ ½²Ⅷ٣", "中文 字符　日本 — “x”", "", " ", "\n\t ", "ÀÉß µ ª º", "x" * 3000, "a_b #$% 12 3,4",
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("ab'sTrEvÉ <|>endoftx\n12!\x1c　Σ", max_size=40), st.sampled_from(ODD)))
def test_ids_equal_the_library(text):
    assert np.frombuffer(WORDS.of(text), "<u2").tolist() == ids_of(text)


def test_words_of_every_latin_character():
    plain = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")
    for c in map(chr, range(256)):
        text = f"a{c}b 1{c}2 {c}{c} '{c} {c}'s'".lower()
        assert WORDS._words(text) == plain.findall(text)


def test_a_full_table_is_cleared(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    words = packing.WordIds(PATH)
    text = "one two three four five one two 日本 语言 six"
    assert np.frombuffer(words.of(text), "<u2").tolist() == ids_of(text)


def check(rows, pieces, sequence):
    """Every id of every row in exactly one piece; sequences are gapless and full but for the last."""
    wanted = {}
    for doc, _, text in rows:
        wanted.setdefault((doc, len(ids_of(text)) + 1), []).append(np.array(ids_of(text) + [1], "<u4"))
    got = {}
    for p in pieces:
        got.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    assert set(got) == set(wanted)
    for k, docs in wanted.items():
        assert sum(p.length for p in got[k]) == sum(map(len, docs))
        if len(docs) == 1:
            at = 0
            for p in sorted(got[k], key=lambda p: p.start):
                assert p.start == at and zlib.crc32(docs[0][at : at + p.length]) == p.ids_crc32
                at += p.length
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0) and p.length > 0
        filled[p.sequence_id] = p.offset + p.length
    assert sorted(filled) == list(range(len(filled)))
    assert all(n == sequence for s, n in filled.items() if s != len(filled) - 1)


ROWS = [(i, f"s{min(i % 7, 3)}", ODD[i % len(ODD)] * (1 + i % 5) + " plain words here" * (i % 11)) for i in range(200)]


@pytest.mark.parametrize("weights", [None, {"s0": 1.0, "s1": 5.0, "s9": 1.0}])
def test_every_id_is_packed_once(spark, weights):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    pieces = packing.pack(df, PATH, weights=weights, sequence=64, window=256).collect()
    check(ROWS, pieces, 64)


def test_natural_shares_hold_in_every_window(spark):
    rows = [(i, "big" if i % 3 else "small", "word " * (5 + i % 9)) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    pieces = packing.pack(df, PATH, sequence=64, window=512).collect()
    check(rows, pieces, 64)
    source = {i: s for i, s, _ in rows}
    total = sum(p.length for p in pieces)
    share = sum(p.length for p in pieces if source[p.doc_id] == "big") / total
    for w in range(total // 512):
        taken = sum(
            p.length for p in pieces if (p.sequence_id * 64) // 512 == w and source[p.doc_id] == "big"
        )
        assert abs(taken - share * 512) <= 16


def test_ids_come_back(spark):
    df = spark.createDataFrame(ROWS[:40], SCHEMA)
    pieces = packing.pack(df, PATH, sequence=32, window=64, with_ids=True).collect()
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    rows = [(None, None, None), (1, None, ""), (1, "a", "x y"), (1, "a", "x y"), (2, "", "z")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS start", "2 AS ids", "'q' AS queue", "3 AS part", "4 AS n", "5 AS _queue", "6 AS `a.b`"
    )
    pieces = packing.pack(df, PATH, sequence=4, window=8).collect()
    check(rows, pieces, 4)
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_many_sources_share_queues(spark):
    rows = [(i, f"s{i}", "a b c") for i in range(50)]
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA), PATH, sequence=16, window=32, max_queues=7).collect()
    check(rows, pieces, 16)


def test_weights_hold_beyond_the_bound_of_queues(spark):
    rows = [(i, f"s{i % 30}", "a b c") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _named", "2 AS `a.b`")
    pieces = packing.pack(df, PATH, weights={"s3": 3.0, "s9": 1.0, "none": 1.0}, sequence=8, window=16, max_queues=7).collect()
    check(rows, pieces, 8)
    early = [p for p in pieces if p.sequence_id < 4]
    taken = {s: sum(p.length for p in early if p.doc_id % 30 == s) for s in (3, 9)}
    assert taken[3] + taken[9] == 32 and abs(taken[3] - 24) <= 2
    with pytest.raises(ValueError):
        packing.pack(df, PATH, weights={f"s{i}": 1.0 for i in range(7)}, max_queues=7)


def test_schedule_is_deficit_round_robin():
    names, phases = packing.schedule({"a": 1000, "b": 330, "c": 3}, None, 100)
    (phase,) = phases
    credit = np.zeros(3)
    given_so_far = np.zeros(3, dtype=int)
    for w in range(phase.windows):
        credit += np.array([1000, 330, 3]) / phase.windows
        spent = np.floor(credit + 1e-9).astype(int)
        credit -= spent
        given_so_far += spent
        assert given_so_far.tolist() == phase.given(w + 1).tolist()


def test_phases_follow_the_weights():
    names, phases = packing.schedule({"a": 100, "b": 100, "c": 50}, {"a": 3.0, "b": 1.0}, 40)
    assert [p.taken.tolist() for p in phases] == [[100, 33, 0], [0, 67, 0], [0, 0, 50]]
    assert [p.base for p in phases] == [0, 133, 200]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.sampled_from([0.0, 0.3, 1.0, 2.5, 1e-9, 7.0])), min_size=1, max_size=9), st.integers(4, 50))
def test_weighted_pieces_tile_the_stream(queues, window):
    totals = {f"q{i}": n for i, (n, _) in enumerate(queues)}
    names, phases = packing.schedule(totals, {f"q{i}": w for i, (_, w) in enumerate(queues)}, window)
    cut, places = packing._pieces(names, phases, 8), []
    for q, n in totals.items():
        at = 0
        for first in range(0, n, 7):  # documents of seven tokens
            pieces = list(cut(q, first, min(7, n - first)))
            assert [p[0] for p in pieces] == np.cumsum([0, *(p[1] for p in pieces)])[:-1].tolist()
            at += sum(p[1] for p in pieces)
            places += [place + k for _, length, place in pieces for k in range(length)]
        assert at == n
    assert sorted(places) == list(range(sum(totals.values())))


def test_state_is_linear_in_the_weighted_sources():
    rng = np.random.default_rng(4)
    sizes = {}
    for n in (2_500, 5_000):
        totals = {f"s{i}": int(rng.integers(1, 10**9)) for i in range(n)}
        start = time.perf_counter()
        names, phases = packing.schedule(totals, {q: float(rng.random()) for q in totals}, packing.WINDOW)
        assert time.perf_counter() - start < 10 and len(phases) > n // 2
        sizes[n] = len(pickle.dumps((names, phases)))
    assert sizes[5_000] < 2.2 * sizes[2_500] < 1 << 20
    before = sum(totals.values())
    assert sum(int(phases[p].taken.sum()) for p in range(0, len(phases), 500)) < before == int(phases.bases[-1])


def test_layouts_keep_to_their_bound(monkeypatch):
    monkeypatch.setattr(packing, "LAYOUT_BYTES", 24 * 4)
    totals = {"a": 1000, "b": 700, "c": 40}
    names, phases = packing.schedule(totals, {"a": 1.0, "b": 2.0, "c": 1.0}, 64)
    cut = packing._pieces(names, phases, 16)
    places = sorted(place + k for q, n in totals.items() for _, length, place in cut(q, 0, n) for k in range(length))
    assert places == list(range(1740))
