"""Every stage on its own input against a plain version, and the whole run."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from driftwise.llm.pii import redacted
from driftwise.llm.tables import tokenizer_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = r"[^\x20\x09-\x0D]+"
STAGE = dict(pipeline.STAGES)


def is_good(text):
    words = re.findall(SPACED, text or "")
    n = len(words)
    grams = [tuple(words[i : i + 8]) for i in range(n - 7)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(SPACED, x)]
    stutter = sum(a == b for a, b in zip(words, words[1:]))
    return not (
        n < 20 or 100 * len(covered) > 30 * n or 10 * len(re.findall(r"[#*$%&|<>]", text)) > n
        or not 3 * n <= sum(map(len, words)) <= 15 * n or 2 * (len(lines) - len(set(lines))) > len(lines)
        or 10 * stutter > 3 * n or 10 * sum(any(c.isalpha() for c in w) for w in words) < 7 * n
    )


def shingle_set(text):
    words = re.findall(SPACED, (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def kept_ids(docs):
    sets = {i: shingle_set(t) for i, t in docs.items()}
    head = {i: i for i in docs}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(docs)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                head[high] = low
    return {i for i in ids if find(i) == i}


def item_windows(items):
    out = set()
    for text in items:
        words = re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").translate(LOWER))
        n = min(10, len(words))
        out |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    return out


def is_clean(text, windows):
    words = re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").translate(LOWER))
    sizes = {len(w) for w in windows}
    return not any(tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1))


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def by_id(df):
    return {r.doc_id: tuple(r) for r in df.collect()}


def test_stages_one_by_one(spark, sf_dir, given):
    docs = by_id(given)
    good = by_id(STAGE["quality_rules"](spark, given, sf_dir))
    assert good == {i: r for i, r in docs.items() if is_good(r[1])} and 0 < len(good) < len(docs)
    single = by_id(STAGE["near_dedup"](spark, given, sf_dir))
    assert single == {i: docs[i] for i in kept_ids({i: r[1] for i, r in docs.items()})} and 0 < len(single) < len(docs)
    windows = item_windows(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect())
    clean = by_id(STAGE["decontamination"](spark, given, sf_dir))
    assert clean == {i: r for i, r in docs.items() if is_clean(r[1], windows)} and 0 < len(clean) < len(docs)
    private = by_id(STAGE["personal_data"](spark, given, sf_dir))
    assert {i: r[1] for i, r in private.items()} == {i: redacted(r[1]) for i, r in docs.items()}
    assert all(r[4] == len(r[1]) or r == docs[i] for i, r in private.items())
    assert any(r != docs[i] for i, r in private.items())


def test_whole_run(spark, sf_dir, given):
    docs = {i: r[1] for i, r in by_id(given).items()}
    docs = {i: t for i, t in docs.items() if is_good(t)}
    docs = {i: docs[i] for i in kept_ids(docs)}
    windows = item_windows(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect())
    docs = {i: redacted(t) for i, t in docs.items() if is_clean(t, windows)}
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in docs.items()}
    pieces = sorted(pipeline.run(spark, sf_dir).collect(), key=lambda p: (p.doc_id, p.start))
    assert {p.doc_id for p in pieces} == set(ids)
    at = {}
    for p in pieces:
        assert p.start == at.get(p.doc_id, 0) and p.doc_tokens == len(ids[p.doc_id])
        raw = b"".join(n.to_bytes(4, "little") for n in ids[p.doc_id][p.start : p.start + p.length])
        assert zlib.crc32(raw) == p.ids_crc32
        at[p.doc_id] = p.start + p.length
    assert at == {i: len(v) for i, v in ids.items()}


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


def test_stages_take_odd_tables(spark, sf_dir):
    """Missing and repeated ids, null and repeated texts, clashing names, and no rows at all."""
    prose = [" ".join(hashlib.md5(f"{k}{i}".encode()).hexdigest()[:6].translate(str.maketrans("0123456789", "ghijklmnop")) for i in range(40)) for k in range(3)]
    rows = [
        (None, prose[0], None, None, None), (None, prose[0], "en", "a", 1), (None, None, None, None, None), (1, "", "en", "a", 0),
        (2, prose[0], "en", "a", 2), (2, prose[0], "en", "a", 2), (2, prose[1], "en", "b", 3), (3, prose[1].upper(), "en", "b", 3),
        (4, prose[2], "de", "c", 4), (5, prose[2] + " tail", "de", "c", 4),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _kept", "2 AS _hit", "3 AS node", "4 AS `row`", "5 AS kept", "6 AS _row_key")
    good = STAGE["quality_rules"](spark, df, sf_dir)
    assert good.columns == df.columns and good.count() == 8
    single = STAGE["near_dedup"](spark, good, sf_dir)
    assert single.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in single.collect()) == sorted([(2, prose[0]), (2, prose[1]), (4, prose[2])])
    clean = STAGE["decontamination"](spark, df, sf_dir)
    assert clean.columns == df.columns and clean.count() == len(rows)
    private = STAGE["personal_data"](spark, df, sf_dir)
    assert sorted(map(str, private.collect())) == sorted(map(str, df.collect()))
    for name, function in pipeline.STAGES:
        assert function(spark, df.limit(0), sf_dir).collect() == [], name
