"""Sharding against its laws, and the mixture of every shard."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.sharding import interleaved_shards

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType())]
)


@pytest.mark.parametrize("slice_rows", [7, 100, 50_000])
def test_laws_and_mixture(spark, slice_rows):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 5}", "é" * (i % 4)) for i in range(997)]
    out = interleaved_shards(spark.createDataFrame(rows, SCHEMA), slice_rows=slice_rows).collect()
    assert sorted(r.doc_id for r in out) == list(range(997))
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(n))
    for source in {r[1] for r in rows}:
        each = Counter(r.shard for r in out if r.source == source)
        assert max(each.values()) - min(each[s] for s in range(16)) <= 2
    text = {r[0]: (r[2] or "").encode() for r in rows}
    assert all(r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in out)


def hashed(spark, rows):
    """Shuffle keys of the rows and phases of the sources, from the same hash functions."""
    df = spark.createDataFrame(rows, SCHEMA).select(
        "doc_id", "source", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc")
    ).withColumn("queue", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    return df.select(
        "doc_id", "queue", "crc", F.xxhash64(F.lit(17), "doc_id", "crc").alias("shuffled"),
        (F.pmod(F.xxhash64(F.lit(18), "queue"), F.lit(1 << 20)) / float(1 << 20)).alias("phase"),
    ).collect()


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_order_is_a_plain_sort_by_fractional_rank(spark, shards):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 11 == 0 else f"s{i % 5}", "é" * (i % 4)) for i in range(601)]
    queues = {}
    for r in hashed(spark, rows):
        queues.setdefault(r.queue, []).append(r)
    order = []
    for queue in queues.values():
        queue.sort(key=lambda r: (r.shuffled, r.doc_id, r.crc))
        order += [((i + r.phase) / len(queue), r.shuffled, r.doc_id, r.crc) for i, r in enumerate(queue)]
    order.sort()
    small, larger = divmod(len(order), shards)
    sizes = [small + (s < larger) for s in range(shards)]
    places = [(s, slot) for s, n in enumerate(sizes) for slot in range(n)]
    wanted = {o[2]: place for o, place in zip(order, places)}
    out = interleaved_shards(spark.createDataFrame(rows, SCHEMA), shards, slice_rows=50).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in out} == wanted


def test_the_slice_size_does_not_change_the_order(spark):
    df = spark.createDataFrame([(i, f"s{i % 4}", "x" * i) for i in range(300)], SCHEMA)
    a, b = (sorted(map(tuple, interleaved_shards(df, slice_rows=n).collect())) for n in (11, 1000))
    assert a == b


def test_single_row_sources_are_spread(spark):
    out = interleaved_shards(spark.createDataFrame([(i, f"s{i}", "") for i in range(800)], SCHEMA)).collect()
    assert len({r.shard for r in out}) == 16 and max(Counter(r.shard for r in out).values()) == 50


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    rows = [(None, None, None), (1, None, None), (1, "a", "x"), (1, "a", "x"), (2, "", "z" * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS shard", "2 AS _queue", "3 AS size", "4 AS _piece")
    out = interleaved_shards(df, shards=2).collect()
    assert Counter((r.doc_id, r.source) for r in out) == Counter((r[0], r[1]) for r in rows)
    assert sorted((r.shard, r.slot) for r in out) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert {r["size"] for r in out if r.doc_id is None} == {1}
    assert interleaved_shards(df.limit(0)).collect() == []
