"""Sources, sinks, resampling and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwise.functions.scalar import clamp
from driftwise.operators.resample import bootstrap, jitter, noise_scale_table, noise_scales
from driftwise.operators.splits import aligned, contiguous_folds, exact_sample, random_split, stratified_folds, stratified_split
from driftwise.plans import twins
from driftwise.plans.bindings import CLASSES, renewals, scored, staged_scores, table
from driftwise.plans.catalog import query
from driftwise.plans.fusion_queries import rounded
from driftwise.plans.twins import RENEWALS, SCORED, hash_order, over
from driftwise.session import new_table_path, stage
from driftwise.sources.tables import read_delimited, read_table, write_delimited, write_table


@query("delimited_roundtrip", over(RENEWALS, select="SELECT * FROM renewals"))
def delimited_roundtrip(spark, sf_dir):
    df = renewals(spark, sf_dir)
    path = new_table_path(spark, "delimited")
    write_delimited(df, path)
    return read_delimited(spark, path, df.schema)


@query("delimited_inferred", over(RENEWALS, select="SELECT * FROM renewals"))
def delimited_inferred(spark, sf_dir):
    """The same file without a schema: every column comes back with its type."""
    path = new_table_path(spark, "delimited")
    write_delimited(renewals(spark, sf_dir), path)
    return read_delimited(spark, path)


@query("parquet_scan", "SELECT * FROM customer")
def parquet_scan(spark, sf_dir):
    return table(spark, sf_dir, "customer")


@query("parquet_roundtrip", over(SCORED, select="SELECT policy_id, class_pred, round(reg_pred, 6) AS reg_pred FROM scored"))
def parquet_roundtrip(spark, sf_dir):
    path = new_table_path(spark, "parquet")
    write_table(scored(spark, sf_dir).select("policy_id", "class_pred", "reg_pred"), path)
    return rounded(read_table(spark, path), 6, "reg_pred")


@query(
    "bootstrap_exact",
    over(
        RENEWALS,
        f"""
numbered AS (SELECT *, row_number() OVER (ORDER BY {hash_order("42")}) AS rn FROM renewals),
draws AS (
  SELECT range AS draw, least(CAST(floor({twins.uniform("42:draw", "range", 13)} * n::DOUBLE) AS BIGINT), n - 1) + 1 AS rn
  FROM range(2 * (SELECT count(*) FROM renewals)), (SELECT count(*) AS n FROM renewals))""",
        select="SELECT draw, policy_id, party_id, premium_before, pct_before FROM draws JOIN numbered USING (rn)",
    ),
)
def bootstrap_exact(spark, sf_dir):
    df = stage(renewals(spark, sf_dir).select("policy_id", "party_id", "premium_before", "pct_before"), "drawn")
    return bootstrap(df, 2 * df.count(), "policy_id", "42")


JITTERED = ["premium_before", "premium_after", "insured_before", "score"]

SCALES = "\nscales AS (SELECT " + ", ".join(
    f"0.1::DOUBLE * CASE WHEN stddev_samp({c}) IS NULL OR stddev_samp({c}) = 0 THEN 0.05::DOUBLE * abs(avg({c})) ELSE stddev_samp({c}) END AS s_{c}"
    for c in JITTERED
) + " FROM renewals)"


@query(
    "noise_scale",
    over(RENEWALS, SCALES, select=" UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(s_{c}, 4) AS scale FROM scales" for c in JITTERED)),
)
def noise_scale(spark, sf_dir):
    return rounded(noise_scale_table(renewals(spark, sf_dir), [*JITTERED, "absent_column"]), 4, "scale")


def _jitter_sql(floor_names: tuple[str, ...]) -> str:
    items = []
    for c in JITTERED:
        noisy = f"{c} + s_{c} * {twins.standard_normal('42:' + c, 'policy_id')}"
        if any(s in c for s in floor_names):
            noisy = f"CASE WHEN {noisy} < 0 THEN 0.0::DOUBLE ELSE {noisy} END"
        items.append(f"round({noisy}, 4) AS {c}")
    return f"SELECT policy_id, {', '.join(items)} FROM renewals, scales"


@query("gaussian_jitter", over(RENEWALS, SCALES, select=_jitter_sql(())))
def gaussian_jitter(spark, sf_dir):
    df = stage(renewals(spark, sf_dir).select("policy_id", *JITTERED), "jittered")
    return rounded(jitter(df, noise_scales(df, JITTERED), "policy_id", "42"), 4, *JITTERED)


@query("conditional_floor", over(RENEWALS, SCALES, select=_jitter_sql(("premium", "score"))))
def conditional_floor(spark, sf_dir):
    df = stage(renewals(spark, sf_dir).select("policy_id", *JITTERED), "jittered")
    return rounded(jitter(df, noise_scales(df, JITTERED), "policy_id", "42", ("premium", "score")), 4, *JITTERED)


@query(
    "clamp_range",
    over(RENEWALS, select="SELECT policy_id, greatest(10.0::DOUBLE, least(40.0::DOUBLE, 5 * pct_after)) AS pct_clamped FROM renewals"),
)
def clamp_range(spark, sf_dir):
    return renewals(spark, sf_dir).select("policy_id", clamp(5 * F.col("pct_after"), 10, 40).alias("pct_clamped"))


@query(
    "exact_sample",
    over(RENEWALS, select=f"SELECT policy_id, premium_after FROM renewals ORDER BY {hash_order('7')} LIMIT 3000"),
)
def sample_rows(spark, sf_dir):
    return exact_sample(stage(renewals(spark, sf_dir).select("policy_id", "premium_after"), "sampled"), 3000, "policy_id", "7")


@query(
    "random_split",
    over(
        RENEWALS,
        select=f"""SELECT policy_id, CASE WHEN row_number() OVER (ORDER BY {hash_order("42")})
  <= count(*) OVER () - ceil(0.3::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM renewals""",
    ),
)
def split_at_random(spark, sf_dir):
    return random_split(stage(renewals(spark, sf_dir).select("policy_id"), "split"), 0.3, "policy_id", "42")


@query(
    "stratified_split",
    over(
        SCORED,
        select=f"""SELECT policy_id, class_true, CASE WHEN row_number() OVER (PARTITION BY class_true ORDER BY {hash_order("42")})
  <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY class_true)) THEN 'train' ELSE 'test' END AS split FROM scored""",
    ),
)
def split_by_class(spark, sf_dir):
    rows = staged_scores(spark, sf_dir, "policy_id", "class_true")
    return stratified_split(rows, 0.8, "class_true", "policy_id", "42", CLASSES.names())


@query(
    "stratified_folds",
    over(
        SCORED,
        select=f"""SELECT policy_id, class_true,
  CAST(ntile(3) OVER (PARTITION BY class_true ORDER BY {hash_order("42")}) - 1 AS INTEGER) AS fold FROM scored""",
    ),
)
def folds_by_class(spark, sf_dir):
    rows = staged_scores(spark, sf_dir, "policy_id", "class_true")
    return stratified_folds(rows, 3, "class_true", "policy_id", "42", CLASSES.names())


@query(
    "contiguous_folds",
    over(RENEWALS, select="SELECT policy_id, CAST(ntile(3) OVER (ORDER BY policy_id) - 1 AS INTEGER) AS fold FROM renewals"),
)
def folds_in_order(spark, sf_dir):
    return contiguous_folds(stage(renewals(spark, sf_dir).select("policy_id"), "folds"), 3, "policy_id")


@query(
    "align_predictions",
    over(
        SCORED,
        select="""SELECT policy_id, a.pct_after, round(b.reg_pred, 6) AS reg_pred
FROM renewals a JOIN (SELECT policy_id, reg_pred FROM scored WHERE class_pred <> 'keep') b USING (policy_id)""",
    ),
)
def align_predictions(spark, sf_dir):
    truth = renewals(spark, sf_dir).select("policy_id", "pct_after")
    predictions = scored(spark, sf_dir).filter("class_pred <> 'keep'").select("policy_id", "reg_pred")
    return rounded(aligned(truth, predictions, "policy_id"), 6, "reg_pred")
