"""Registered queries of ranked search, url filters and clustering, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwise.llm.clusters import clustered
from driftwise.llm.lexical import ranked
from driftwise.llm.tables import benchmark, documents, embeddings, pages
from driftwise.llm.url_rules import judged

_TERMS = r"""regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+')"""
OP11_SQL = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, {_TERMS} AS words FROM documents),
b AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT item_id, row_number() OVER () AS item, unnest({_TERMS}) AS term FROM benchmark)
  GROUP BY item, item_id, term),
size AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms
  FROM d WHERE len(words) > 0),
held AS (
  SELECT row, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT row, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM b) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), size),
scores AS (
  SELECT item, item_id, doc_id, row,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(words) * n_docs) // n_terms))))
              AS BIGINT) AS score
  FROM held JOIN weights USING (term) JOIN b USING (term) JOIN d USING (row), size
  GROUP BY item, item_id, doc_id, row)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20"""


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), benchmark(spark, sf_dir))


#: Rules of the contract (fixed values).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
OP12_SQL = rf"""
WITH u AS (
  SELECT page_id, row_number() OVER () AS row,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r (rule_host, rule_path, verdict) AS (VALUES {_RULES_SQL}),
fits AS (
  SELECT row, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY row)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fits USING (row)"""


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(pages(spark, sf_dir), spark.createDataFrame(RULES, "host string, path string, verdict string"))


_APART = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"


def _nearest(centroids: str) -> str:
    return f"""(
  SELECT row, CAST(arg_min(j, d * 8 + j) AS INTEGER) AS j, CAST(min(d) AS BIGINT) AS d
  FROM (SELECT row, c.j, CAST({_APART} AS HUGEINT) AS d FROM v, {centroids} AS c) GROUP BY row)"""


def _next(r: int) -> str:
    """Centroids after round r, from those before it; floor division by the non-negative rest."""
    return f"""a{r} AS MATERIALIZED {_nearest(f"c{r - 1}")},
c{r} AS MATERIALIZED (
  SELECT j, coalesce(moved, x) AS x FROM c{r - 1} LEFT JOIN (
    SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS moved FROM (
      SELECT j, i, sum(v.x[i]) AS s, count(*) AS n
      FROM a{r} JOIN v USING (row), unnest(range(1, 65)) AS t(i) GROUP BY j, i)
    GROUP BY j) USING (j))"""


OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, x
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h, x LIMIT 8)),
{", ".join(_next(r) for r in range(1, 11))},
last AS MATERIALIZED {_nearest("c10")}
SELECT vec_id, last.j AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY last.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c10.x, ',')) AS centroid_sha256
FROM last JOIN v USING (row) JOIN c10 ON c10.j = last.j"""


def clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(embeddings(spark, sf_dir))
