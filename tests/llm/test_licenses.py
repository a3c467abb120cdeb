"""License scans against full alignment of every template, and on changed wordings."""

import time

import numpy as np
import pytest
from pyspark.sql import types as T

from driftwise.llm.license_texts import LICENSE_TEXTS
from driftwise.llm.licenses import GAP, MATCH, MISS, TemplateIndex, align, matches, scan_licenses
from driftwise.llm.words import ALPHANUMERIC, word_hashes

INDEX = TemplateIndex(LICENSE_TEXTS)
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def words(text):
    return word_hashes([text.encode()], ALPHANUMERIC)[0]


def brute(template, doc):
    """Matched words of the best local alignment, without a band."""
    n, m = len(template), len(doc)
    score = np.zeros((n + 1, m + 1), dtype=int)
    count = np.zeros((n + 1, m + 1), dtype=int)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            same = template[i - 1] == doc[j - 1]
            ways = [(score[i - 1, j - 1] + (MATCH if same else MISS), count[i - 1, j - 1] + same),
                    (score[i - 1, j] + GAP, count[i - 1, j]), (score[i, j - 1] + GAP, count[i, j - 1])]
            value, matched = max(ways)
            if value > 0:
                score[i, j], count[i, j] = value, matched
    at = score.argmax()
    return int(count.flat[at])


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, scan_licenses(df, **options).collect()))


@pytest.mark.parametrize("t", range(len(LICENSE_TEXTS)))
def test_every_template_is_found_in_itself(t):
    doc = words("Some words before. " + LICENSE_TEXTS[t][1] + " And some after.")
    found = matches(doc, INDEX)
    assert [(LICENSE_TEXTS[f[0]][0], f[1]) for f in found] == [(LICENSE_TEXTS[t][0], len(INDEX.words[t]))]


@pytest.mark.parametrize("t", [0, 5, 8, 11, 16])
def test_changed_wordings_equal_full_alignment(t):
    rng = np.random.default_rng(t)
    for _ in range(5):
        changed = []
        for w in LICENSE_TEXTS[t][1].split():
            r = rng.random()
            changed += [] if r < 0.04 else [w, "extra"] if r < 0.08 else ["other"] if r < 0.12 else [w]
        doc = words("a b c " + " ".join(changed) + " d e f")
        (found,) = [f for f in matches(doc, INDEX) if LICENSE_TEXTS[f[0]][0] == LICENSE_TEXTS[t][0]][:1]
        assert found[1] == brute(INDEX.words[t], doc)


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
        ("Licensed under CC BY-NC-ND 3.0", "CC-BY-NC-ND-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version "
         "2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, "
         "but WITHOUT ANY WARRANTY", "LGPL-2.1"),
        ("You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free "
         "Software Foundation, either version 3 of the License, or (at your option) any later version. It is distributed in the hope "
         "that it will be useful, but WITHOUT ANY WARRANTY", "AGPL"),
    ],
)
def test_variants_go_under_their_own_name(text, name):
    assert [LICENSE_TEXTS[f[0]][0] for f in matches(words(f"Read this. {text} And so on."), INDEX)] == [name]


def test_a_library_under_the_general_license():
    text = next(t for name, t in LICENSE_TEXTS if name == "GPL").replace("program", "library")
    assert [LICENSE_TEXTS[f[0]][0] for f in matches(words(text), INDEX)] == ["GPL"]
    old = next(t for name, t in LICENSE_TEXTS if name == "LGPL-2.0").replace("program", "library")
    assert [LICENSE_TEXTS[f[0]][0] for f in matches(words(old), INDEX)] == ["LGPL-2.0"]


def test_permission_notices_go_under_their_own_name():
    texts = [(name, text) for name, text in LICENSE_TEXTS if name in ("ISC", "0BSD", "HPND", "CC0-1.0")]
    for name, text in texts:
        for form in (text, text.replace("THE AUTHOR", "ANY HOLDER OF RIGHTS").replace("the author", "Some Holder")):
            doc = words(f"Copyright 1999 by somebody {form} Table of contents")
            assert [LICENSE_TEXTS[f[0]][0] for f in matches(doc, INDEX)] == [name]
    both = words(f"{texts[0][1]} Between the two. {texts[-2][1]}")
    assert [LICENSE_TEXTS[f[0]][0] for f in matches(both, INDEX)] == [texts[0][0], texts[-2][0]]


def test_boilerplate_repeated_many_times_is_quick():
    for text in ("the software is provided as is without warranty ", "permission is hereby granted to any person to use copy modify "):
        doc = words(text * 2500)
        began = time.process_time()
        assert matches(doc, INDEX) == []
        assert time.process_time() - began < 3


def test_alignment_of_rows_equals_cell_by_cell():
    """The band row by row in NumPy against single cells."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        template, doc = rng.integers(0, 5, rng.integers(1, 25)), rng.integers(0, 5, rng.integers(1, 40))
        centre, band = int(rng.integers(-20, 40)), int(rng.integers(0, 8))
        score = {}
        for i in range(1, len(template) + 1):
            for k in range(2 * band + 1):
                j = i + centre - band + k
                if 1 <= j <= len(doc):
                    same = MATCH if template[i - 1] == doc[j - 1] else MISS
                    left, above = score.get((i, k - 1), 0), score.get((i - 1, k + 1), 0)
                    score[i, k] = max(0, score.get((i - 1, k), 0) + same, above + GAP, left + GAP)
        best = max(score.values(), default=0)
        matched, first, last = align(template, doc, centre, band)
        assert (matched == 0) == (best == 0) and MATCH * matched >= best
        assert matched <= last - first and (not matched or first < last <= len(doc))


def test_no_variant_is_taken_for_another():
    """Without its own wording a variant gives no row."""
    few = TemplateIndex([t for t in LICENSE_TEXTS if t[0] in ("GPL", "GPL-3.0", "CC-BY-4.0")])
    for text in ("Licensed under CC BY-NC-SA 4.0", "This work is licensed under the GNU Lesser General Public License, version 3."):
        assert matches(words(text), few) == []


def test_spans_are_code_points_and_overlaps_go(spark):
    notice = "Licensed under the Apache License, Version 2.0"
    text = f"Élan vital.\n{notice}. Ütz!\nReleased under the MIT License\n{notice}"
    got = run(spark, [(7, text)])
    assert [(r[1], text[r[6] : r[7]], r[5]) for r in sorted(got, key=lambda r: r[6])] == [
        ("Apache-2.0", notice, 1.0), ("MIT", "Released under the MIT License", 1.0), ("Apache-2.0", notice, 1.0)
    ]


@pytest.mark.parametrize(
    "clean", ["", "under the sea", "Released under the moon by the license", "the rights to use, copy, modify a thing", "a " * 5000]
)
def test_clean_text_has_no_license(clean):
    assert matches(words(clean), INDEX) == []


def test_given_documents_report_every_known_line(spark, sf_dir):
    lines = [t for _, t in LICENSE_TEXTS if "\n" not in t]
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = {(r.doc_id, line) for r in df.collect() for line in lines if line in (r.text or "")}
    text = {r.doc_id: r.text for r in df.collect()}
    got = {(r.doc_id, text[r.doc_id][r.start : r.end]) for r in scan_licenses(df).collect()}
    assert wanted and {(d, line.rstrip(".")) for d, line in wanted} <= got


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    rows = [(None, "x Released under the MIT License."), (1, None), (1, ""), (2, "Licensed under CC BY 4.0"), (2, "Licensed under CC BY 4.0")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS license", "2 AS start", "3 AS `a.b`")
    got = sorted(((r.doc_id, r.license, r.start) for r in scan_licenses(df).collect()), key=str)
    assert got == [(2, "CC-BY-4.0", 0), (2, "CC-BY-4.0", 0), (None, "MIT", 2)]
    assert scan_licenses(df.limit(0)).collect() == []
