"""Registered queries of near-duplicates, decontamination and license texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwise.llm.decontamination import contamination
from driftwise.llm.near_dedup import near_duplicates
from driftwise.llm.tables import benchmark, documents

OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
                      WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                      ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3),
                             lambda i: array_to_string(words[i:i + 4], ' ')))) END AS shingles
  FROM w),
classes AS (SELECT shingles, min(doc_id) AS id FROM s WHERE len(shingles) > 0 GROUP BY shingles),
t AS (SELECT id, len(shingles) AS n, unnest(shingles) AS x FROM classes),
common AS (
  SELECT a.id AS a, b.id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM t a JOIN t b ON a.x = b.x AND a.id < b.id
  GROUP BY a.id, b.id),
edges AS (
  SELECT a, b FROM common WHERE 100 * k >= 85 * (na + nb - k)
  UNION ALL SELECT b, a FROM common WHERE 100 * k >= 85 * (na + nb - k)),
reach AS (
  SELECT id, id AS other FROM classes
  UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.other),
heads AS (SELECT id, min(other) AS head FROM reach GROUP BY id)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles,
       coalesce(head, s.doc_id) AS component_id, coalesce(head, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN classes c ON len(s.shingles) > 0 AND c.shingles = s.shingles
       LEFT JOIN heads h ON h.id = c.id"""


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n,
         array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS w
  FROM b, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS r(i)
  WHERE len(words) > 0),
hits AS (
  SELECT doc_id, i, x.n, item_id FROM (
    SELECT doc_id, i, s.n, array_to_string(words[i:i + s.n - 1], ' ') AS dw
    FROM d, (SELECT DISTINCT n FROM w) AS s, unnest(range(1, len(words) - s.n + 2)) AS r(i)) AS x
  JOIN w ON w.n = x.n AND w.w = x.dw),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) AS r(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), benchmark(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
