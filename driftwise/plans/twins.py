"""SQL text of the renewal tables, for checking the queries in another engine."""

from __future__ import annotations

RENEWALS = """
li AS (
  SELECT l_orderkey,
         CAST(floor(CAST(sum(CAST(round(l_discount*100) AS BIGINT)) AS DOUBLE)/count(*)) AS DOUBLE) AS pct,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS insured
  FROM lineitem GROUP BY l_orderkey),
o AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus, o_totalprice, li.pct, li.insured
  FROM orders LEFT JOIN li ON l_orderkey = o_orderkey),
w AS (
  SELECT o.*, lag(o_orderkey) OVER t AS prior_id, lag(pct) OVER t AS pct_before,
         lag(o_totalprice) OVER t AS premium_before, lag(insured) OVER t AS insured_before
  FROM o WINDOW t AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
renewals AS (
  SELECT o_orderkey AS policy_id, prior_id AS prior_policy_id, o_custkey AS party_id,
         pct_before, pct AS pct_after, premium_before, o_totalprice AS premium_after,
         insured_before, insured AS insured_after, c_acctbal AS score,
         o_orderpriority AS band, o_orderstatus AS status, c_mktsegment AS maker, r_name AS branch
  FROM w JOIN customer ON c_custkey = o_custkey
         JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  WHERE prior_id IS NOT NULL)"""

SCORED = (
    RENEWALS
    + """,
scored AS (
  SELECT *, 0.8::DOUBLE*z AS p_up, 0.8::DOUBLE*(1.0::DOUBLE-z) AS p_down, 0.2::DOUBLE AS p_keep,
         CASE WHEN z >= 0.75::DOUBLE THEN 'up' WHEN z <= 0.25::DOUBLE THEN 'down' ELSE 'keep' END AS class_pred,
         CASE WHEN pct_before+(q-0.5::DOUBLE)*4.0::DOUBLE < 0 THEN 0.0::DOUBLE
              ELSE pct_before+(q-0.5::DOUBLE)*4.0::DOUBLE END AS reg_pred,
         CASE WHEN pct_after > pct_before THEN 'up' WHEN pct_after < pct_before THEN 'down' ELSE 'keep' END AS class_true
  FROM (SELECT *, premium_after/(premium_after+premium_before) AS z,
                  insured_after/(insured_after+insured_before) AS q FROM renewals)),
complete AS (SELECT * FROM scored WHERE reg_pred IS NOT NULL AND pct_after IS NOT NULL)"""
)

GAPPY = ("pct_before", "pct_after", "insured_before", "insured_after")

# Gaps filled by the median of the column, so that every renewal is fitted or scored.
FILLED = (
    SCORED
    + ",\nmedians AS (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in GAPPY)
    + """ FROM renewals),
filled AS (
  SELECT policy_id, class_true, premium_before, premium_after, score, """
    + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in GAPPY)
    + " FROM scored, medians)"
)


def direction(before: str, after: str) -> str:
    return f"CASE WHEN {after} > {before} THEN 'up' WHEN {after} < {before} THEN 'down' ELSE 'keep' END"


FUSED = (
    SCORED
    + f""",
fused AS (
  SELECT *, {direction("pct_before", "reg_pred")} AS reg_direction,
         {direction("pct_before", "pct_after")} AS real_direction,
         {direction("pct_before", "fused_pred")} AS fused_direction
  FROM (SELECT *, CASE WHEN raw < 0 THEN 0.0::DOUBLE ELSE raw END AS fused_pred
        FROM (SELECT *, CASE WHEN pct_before IS NULL OR reg_pred IS NULL OR class_pred IS NULL THEN reg_pred
                             WHEN class_pred = 'keep' THEN pct_before
                             WHEN (class_pred = 'up' AND reg_pred < pct_before) OR (class_pred = 'down' AND reg_pred > pct_before)
                               THEN pct_before - (reg_pred - pct_before)
                             ELSE reg_pred END AS raw FROM scored))),
fused_complete AS (SELECT * FROM fused WHERE reg_pred IS NOT NULL AND pct_after IS NOT NULL)"""
)

LONG = """
ovr AS (
  SELECT policy_id, 'down' AS class, CAST(class_true = 'down' AS INTEGER) AS is_positive, p_down AS score FROM scored
  UNION ALL SELECT policy_id, 'keep', CAST(class_true = 'keep' AS INTEGER), p_keep FROM scored
  UNION ALL SELECT policy_id, 'up', CAST(class_true = 'up' AS INTEGER), p_up FROM scored)"""

# Distinct scores with running counts, from the highest score down.
STEPS = """
pts AS (
  SELECT class, score, CAST(sum(is_positive) AS BIGINT) AS pos, CAST(sum(1 - is_positive) AS BIGINT) AS neg
  FROM ovr GROUP BY class, score),
steps AS (
  SELECT *, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp,
         sum(pos) OVER (PARTITION BY class) AS n_pos, sum(neg) OVER (PARTITION BY class) AS n_neg,
         lead(pos) OVER down AS next_pos, lead(neg) OVER down AS next_neg,
         row_number() OVER down AS step
  FROM pts WINDOW down AS (PARTITION BY class ORDER BY score DESC))"""


def uniform(seed: str, key: str, digits: int = 8, start: int = 1) -> str:
    stretch = f"substr(md5(concat('{seed}:', CAST({key} AS VARCHAR))), {start}, {digits})"
    return f"(('0x' || {stretch})::BIGINT / {16**digits}::DOUBLE)"


def hash_order(seed: str, key: str = "policy_id") -> str:
    return f"md5(concat('{seed}:', CAST({key} AS VARCHAR))), {key}"


def standard_normal(seed: str, key: str) -> str:
    return (
        f"(sqrt(-2.0::DOUBLE * ln({uniform(seed, key)} + 0.5::DOUBLE / 4294967296::DOUBLE))"
        f" * cos(6.283185307179586::DOUBLE * {uniform(seed, key, start=9)}))"
    )


def over(ctes: str, *more: str, select: str) -> str:
    return "WITH " + ",".join([ctes, *more]) + "\n" + select
