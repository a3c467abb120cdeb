"""Registered query of the quality rules and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwise.llm.quality import quality_report
from driftwise.llm.tables import documents

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w8
  FROM d, unnest(range(1, len(words) - 6)) AS r(i)),
twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w8) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 8)) AS r(k) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines,
         len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutter,
         len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) AS n_worded
  FROM d LEFT JOIN covered c USING (doc_id)),
b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words
            OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines
            OR 10 * n_stutter > 3 * n_words
            OR 10 * n_worded < 7 * n_words) AS kept
FROM b"""


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(documents(spark, sf_dir))
