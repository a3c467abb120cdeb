"""Packages: exact round trip, agreement with the standard ZIP reader, broken input."""

import base64
import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import types as T

from driftwise.llm.archives import DATA, INDEX, PackageReader, PackageWriter, archived, parse_record, warc_record

SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
)


def brute(rows):
    """page_id, url, bytes, digest, type, refers_to of rows with unique ids."""
    first = {}
    for i, _, html in rows:
        first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, url, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        revisit = first[html or ""] != i
        out.append((i, url or "", len(raw), digest, "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out)


def got(df):
    return sorted(
        (r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()
    )


@pytest.mark.parametrize("zip64", [False, True])
def test_round_trip(spark, zip64):
    rows = [(i, f"http://x/{i}", f"<p>é {i % 7}" * (i % 5)) for i in range(300)] + [(900, None, None), (901, "a b", "x" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    back = archived(df, package_bytes=2_000, range_records=7, always_zip64=zip64)
    assert got(back) == brute(rows)
    html = {r.page_id: r.html for r in back.collect() if r.record_type == "response"}
    given = {i: h or "" for i, _, h in rows}
    assert all(given[i] == h for i, h in html.items())


def test_given_pages(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert got(archived(df)) == brute([(r.page_id, r.url, r.html) for r in df.collect()])


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    rows = [(None, None, None), (None, "u", "x"), (3, "a\nb", "x"), (4, "u", "x"), (4, "u", "x"), (5, "u", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS payload", "2 AS refers_to", "'z' AS sha1", "3 AS `a.b`")
    out = sorted(((r.page_id, r.url, r.record_type, r.refers_to) for r in archived(df).collect()), key=str)
    assert out == sorted(
        [(None, "", "response", None), (None, "u", "response", None), (3, "a b", "response", None),
         (4, "u", "revisit", 3), (4, "u", "revisit", 3), (5, "u", "response", None)], key=str)
    assert archived(df.limit(0)).collect() == []


def package(zip64, records):
    out = io.BytesIO()
    writer = PackageWriter(out, zip64)
    writer.begin(DATA)
    index = []
    for raw in records:
        packed = gzip.compress(raw)
        index.append((writer.add(packed), len(packed)))
    writer.end()
    writer.begin(INDEX)
    writer.add(repr(index).encode())
    writer.end()
    writer.close()
    return out.getvalue(), index


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_zip_files(zip64):
    records = [warc_record(f"r{i}", "u", b"x" * i, "D", None, "1970-01-01T00:00:00Z") for i in range(20)]
    raw, index = package(zip64, records)
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and z.namelist() == [DATA, INDEX]
        assert {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
        assert gzip.decompress(z.read(DATA)) == b"".join(records)
    reader = PackageReader(io.BytesIO(raw))
    assert [gzip.decompress(reader.stored(DATA, *place)) for place in index] == records
    assert parse_record(records[5])[1] == b"xxxxx"


def test_foreign_packages():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(DATA, b"stored bytes")
        z.writestr("other.txt", b"packed " * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 inside"
    reader = PackageReader(io.BytesIO(out.getvalue()))
    assert reader.stored(DATA, 7, 5) == b"bytes" and set(reader.members) == {DATA, "other.txt"}
    with pytest.raises(ValueError, match="compressed"):
        reader.stored("other.txt")
    with pytest.raises(ValueError, match="outside"):
        reader.stored(DATA, 7, 50)


@pytest.mark.parametrize("cut", [1, 30, 100, 5000])
def test_cut_off_packages_are_refused(cut):
    raw, _ = package(True, [b"x" * 3000])
    with pytest.raises(ValueError):
        PackageReader(io.BytesIO(raw[:-cut] if cut < len(raw) else b""))


def test_ids_of_any_type(spark):
    import datetime
    from decimal import Decimal

    for ids, kind in (
        ([Decimal("1.50"), Decimal("2.25"), None], "decimal(6,2)"),
        ([datetime.date(2020, 1, 2), datetime.date(1999, 12, 31), None], "date"),
        ([b"\x00\xff", b"a", None], "binary"),
        (['q"\n,}', "ä", None], "string"),
    ):
        rows = [(k, "http://x/", "same") for k in ids[:2]] + [(ids[2], "http://y/", "other")]
        table = spark.createDataFrame(rows, f"page_id {kind}, url string, html string")
        got = {r.page_id if kind != "binary" or r.page_id is None else bytes(r.page_id): r for r in archived(table).collect()}
        assert set(got) == set(ids) and got[None].record_type == "response"
        assert got[max(ids[:2])].record_type == "revisit" and got[max(ids[:2])].refers_to == min(ids[:2])
