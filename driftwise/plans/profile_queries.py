"""Profiles, missing counts, shares, segments and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwise.functions.scalar import absolute_error
from driftwise.operators.prep import quantile_bin, quantile_edges
from driftwise.operators.profile import class_share, histogram, mean_by_segment, missing_counts, numeric_columns, other_columns, profile
from driftwise.plans.bindings import renewals, scored, staged_scores, table
from driftwise.plans.catalog import query
from driftwise.plans.fusion_queries import rounded
from driftwise.plans.twins import RENEWALS, SCORED, over
from driftwise.session import new_table_path, stage
from driftwise.sources.tables import read_table, write_table

NUMBERS = [
    "policy_id", "prior_policy_id", "party_id", "pct_before", "pct_after", "premium_before", "premium_after", "insured_before", "insured_after", "score",
]
STRINGS = ["band", "status", "maker", "branch"]
MOMENTS = ("mean", "std", "min", "q25", "q50", "q75", "max")


def _profile_sql(view: str, numbers: list[str], strings: list[str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS count, NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq,
  round(avg({c}::DOUBLE), 3) AS mean, round(stddev_samp({c}::DOUBLE), 3) AS std, round(min({c})::DOUBLE, 3) AS min,
  round(quantile_cont({c}::DOUBLE, 0.25), 3) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 3) AS q50,
  round(quantile_cont({c}::DOUBLE, 0.75), 3) AS q75, round(max({c})::DOUBLE, 3) AS max FROM {view}"""
        for c in numbers
    ]
    parts += [
        f"""SELECT '{c}', (SELECT count({c}) FROM {view}), (SELECT count(DISTINCT {c}) FROM {view}), v, n,
  NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE
FROM (SELECT {c} AS v, count(*) AS n FROM {view} GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"""
        for c in strings
    ]
    return " UNION ALL ".join(parts)


@query("profile_table", over(RENEWALS, select=_profile_sql("renewals", NUMBERS, STRINGS)))
def profile_table(spark, sf_dir):
    return rounded(profile(stage(renewals(spark, sf_dir), "profiled")), 3, *MOMENTS)


LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_STRINGS = ["l_returnflag", "l_linestatus"]


@query("profile_lineitem", _profile_sql("lineitem", LINE_NUMBERS, LINE_STRINGS))
def profile_lineitem(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(*LINE_NUMBERS, *LINE_STRINGS)
    return rounded(profile(df), 3, *MOMENTS)


@query("profile_sink", over(RENEWALS, select=_profile_sql("renewals", NUMBERS, STRINGS)))
def profile_sink(spark, sf_dir):
    path = new_table_path(spark, "profile")
    write_table(profile(stage(renewals(spark, sf_dir), "profiled")), path)
    return rounded(read_table(spark, path), 3, *MOMENTS)


@query(
    "missing_counts",
    over(
        RENEWALS,
        "\nm AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM renewals" for c in [*NUMBERS, *STRINGS]) + ")",
        select="SELECT * FROM m WHERE missing > 0",
    ),
)
def missing_by_column(spark, sf_dir):
    return missing_counts(renewals(spark, sf_dir))


@query(
    "class_share",
    over(
        SCORED,
        select="""SELECT class_true, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share
FROM scored GROUP BY class_true""",
    ),
)
def shares(spark, sf_dir):
    return rounded(class_share(scored(spark, sf_dir), "class_true"), 6, "share")


TERCILES = """
edges AS (SELECT min(premium_before) AS e0, quantile_cont(premium_before, 1.0::DOUBLE/3) AS e1,
                 quantile_cont(premium_before, 2.0::DOUBLE/3) AS e2 FROM renewals)"""
SEGMENT = "CASE WHEN premium_before <= e1 THEN 'low' WHEN premium_before <= e2 THEN 'middle' ELSE 'high' END"
SEGMENT_NAMES = ["low", "middle", "high"]


@query("tercile_bins", over(RENEWALS, TERCILES, select=f"SELECT policy_id, {SEGMENT} AS segment FROM renewals, edges"))
def tercile_bins(spark, sf_dir):
    df = stage(renewals(spark, sf_dir).select("policy_id", "premium_before"), "segments")
    edges = quantile_edges(df, "premium_before", 3)
    return df.select("policy_id", quantile_bin("premium_before", edges, SEGMENT_NAMES).alias("segment"))


@query(
    "mae_by_segment",
    over(
        SCORED,
        TERCILES,
        select=f"""SELECT {SEGMENT} AS segment, count(abs(pct_after - reg_pred)) AS n, round(avg(abs(pct_after - reg_pred)), 6) AS mae
FROM scored, edges GROUP BY 1""",
    ),
)
def mae_by_segment(spark, sf_dir):
    df = staged_scores(spark, sf_dir, "premium_before", "pct_after", "reg_pred")
    segment = quantile_bin("premium_before", quantile_edges(df, "premium_before", 3), SEGMENT_NAMES)
    return rounded(mean_by_segment(df, segment, absolute_error("pct_after", "reg_pred"), "mae"), 6, "mae")


@query(
    "histogram_1d",
    over(
        SCORED,
        """
box AS (SELECT min(reg_pred) AS lo, max(reg_pred) AS hi FROM scored)""",
        select="""SELECT CAST(least(floor((reg_pred - lo) / (hi - lo) * 40.0::DOUBLE), 39) AS INTEGER) AS bin, count(*) AS n
FROM scored, box WHERE reg_pred IS NOT NULL GROUP BY 1""",
    ),
)
def histogram_of_predictions(spark, sf_dir):
    return histogram(staged_scores(spark, sf_dir, "reg_pred"), "reg_pred", 40).select("bin", "n")


@query(
    "role_split",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_tax FROM lineitem",
)
def role_split(spark, sf_dir):
    """Numeric features by type, minus a named target."""
    df = table(spark, sf_dir, "lineitem")
    return df.select(*numeric_columns(df, exclude=("l_discount", "absent_column")))


@query("text_roles", over(RENEWALS, select="SELECT policy_id, band, status, maker, branch FROM renewals"))
def text_roles(spark, sf_dir):
    df = renewals(spark, sf_dir)
    return df.select("policy_id", *[F.col(c) for c in other_columns(df)])
