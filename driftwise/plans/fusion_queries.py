"""Labels, scalar functions and the fusion of class and value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwise.functions.scalar import (
    absolute_error,
    decimal_text,
    difference,
    direction,
    floor_at_zero,
    guarded_ratio,
    percent_text,
    residual,
    signed_points_text,
)
from driftwise.operators.fusion import agreeing, disagreeing, fusion_kpis, rate, with_fusion
from driftwise.operators.kpis import kpi_table, side_by_side
from driftwise.operators.regression import density_grid, smooth_surface
from driftwise.operators.splits import random_split
from driftwise.plans.bindings import CLASSES, complete, probabilities, renewals, scored, staged_scores
from driftwise.plans.catalog import query
from driftwise.plans.twins import FUSED, RENEWALS, SCORED, hash_order, over
from driftwise.plans.twins import direction as direction_sql


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def fused(spark, sf_dir) -> DataFrame:
    return with_fusion(scored(spark, sf_dir), "pct_before", "pct_after", "reg_pred", "class_pred", CLASSES)


@query(
    "direction_label",
    over(RENEWALS, select=f"SELECT policy_id, {direction_sql('pct_before', 'pct_after')} AS target_class FROM renewals"),
)
def direction_label(spark, sf_dir):
    return renewals(spark, sf_dir).select("policy_id", direction("pct_before", "pct_after", CLASSES).alias("target_class"))


@query(
    "prediction_directions",
    over(FUSED, select="SELECT policy_id, reg_direction, real_direction, fused_direction FROM fused"),
)
def prediction_directions(spark, sf_dir):
    return fused(spark, sf_dir).select("policy_id", "reg_direction", "real_direction", "fused_direction")


@query(
    "guarded_ratio",
    over(
        RENEWALS,
        select="""SELECT policy_id,
  round(CASE WHEN pct_before = 0 THEN 1.0::DOUBLE ELSE pct_after / pct_before END, 6) AS ratio_pct,
  round(CASE WHEN premium_before = 0 THEN 1.0::DOUBLE ELSE premium_after / premium_before END, 6) AS ratio_premium
FROM renewals""",
    ),
)
def ratio_features(spark, sf_dir):
    df = renewals(spark, sf_dir).select(
        "policy_id",
        guarded_ratio("pct_after", "pct_before").alias("ratio_pct"),
        guarded_ratio("premium_after", "premium_before").alias("ratio_premium"),
    )
    return rounded(df, 6, "ratio_pct", "ratio_premium")


@query(
    "difference_feature",
    over(RENEWALS, select="SELECT policy_id, round(insured_after - insured_before, 6) AS diff_insured FROM renewals"),
)
def difference_feature(spark, sf_dir):
    df = renewals(spark, sf_dir).select("policy_id", difference("insured_after", "insured_before").alias("diff_insured"))
    return rounded(df, 6, "diff_insured")


@query(
    "floor_predictions",
    over(
        SCORED,
        select="""SELECT policy_id, round(CASE WHEN v < 0 THEN 0.0::DOUBLE ELSE v END, 6) AS floored
FROM (SELECT policy_id, pct_before + (q - 0.5::DOUBLE) * 12.0::DOUBLE AS v FROM scored)""",
    ),
)
def floor_predictions(spark, sf_dir):
    raw = F.col("pct_before") + (F.col("q") - 0.5) * 12.0
    return rounded(scored(spark, sf_dir).select("policy_id", floor_at_zero(raw).alias("floored")), 6, "floored")


@query(
    "residuals",
    over(
        SCORED,
        select="""SELECT policy_id, round(pct_after - reg_pred, 6) AS residual,
  round(abs(pct_after - reg_pred), 6) AS absolute_error FROM scored""",
    ),
)
def residuals(spark, sf_dir):
    df = scored(spark, sf_dir).select(
        "policy_id",
        residual("pct_after", "reg_pred").alias("residual"),
        absolute_error("pct_after", "reg_pred").alias("absolute_error"),
    )
    return rounded(df, 6, "residual", "absolute_error")


@query(
    "metric_transforms",
    over(
        SCORED,
        select="""SELECT policy_id, round(ln(1.0::DOUBLE + reg_pred), 6) AS log_value, round(sqrt(reg_pred), 6) AS root_value,
  round(reg_pred * reg_pred, 6) AS square_value, round(abs(reg_pred - pct_before), 6) AS distance FROM scored""",
    ),
)
def metric_transforms(spark, sf_dir):
    v = F.col("reg_pred")
    df = scored(spark, sf_dir).select(
        "policy_id",
        F.log1p(v).alias("log_value"),
        F.sqrt(v).alias("root_value"),
        (v * v).alias("square_value"),
        F.abs(v - F.col("pct_before")).alias("distance"),
    )
    return rounded(df, 6, "log_value", "root_value", "square_value", "distance")


@query("agreeing_rows", over(FUSED, select="SELECT policy_id, class_pred FROM fused WHERE class_pred = reg_direction"))
def agreeing_rows(spark, sf_dir):
    return agreeing(fused(spark, sf_dir)).select("policy_id", "class_pred")


@query(
    "disagreeing_rows",
    over(FUSED, select="SELECT policy_id, class_pred, reg_direction FROM fused WHERE class_pred <> reg_direction"),
)
def disagreeing_rows(spark, sf_dir):
    return disagreeing(fused(spark, sf_dir)).select("policy_id", "class_pred", "reg_direction")


@query(
    "agreement_rates",
    over(
        FUSED,
        select="""SELECT class_pred, count(*) AS n,
  round(avg(CASE WHEN class_pred = reg_direction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS agreement,
  round(avg(CASE WHEN class_pred = class_true THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS hit_rate
FROM fused GROUP BY class_pred""",
    ),
)
def agreement_rates(spark, sf_dir):
    df = (
        fused(spark, sf_dir)
        .groupBy("class_pred")
        .agg(
            F.count(F.lit(1)).alias("n"),
            rate(F.col("class_pred") == F.col("reg_direction")).alias("agreement"),
            rate(F.col("class_pred") == F.col("class_true")).alias("hit_rate"),
        )
    )
    return rounded(df, 6, "agreement", "hit_rate")


@query("fused_value", over(FUSED, select="SELECT policy_id, class_pred, round(fused_pred, 6) AS fused_pred FROM fused"))
def fused_value(spark, sf_dir):
    return rounded(fused(spark, sf_dir).select("policy_id", "class_pred", "fused_pred"), 6, "fused_pred")


@query(
    "fused_output",
    over(
        FUSED,
        select="""SELECT policy_id, pct_before, pct_after, class_pred, round(reg_pred, 6) AS reg_pred,
  round(fused_pred, 6) AS fused_pred, reg_direction, real_direction, fused_direction FROM fused""",
    ),
)
def fused_output(spark, sf_dir):
    df = fused(spark, sf_dir).select(
        "policy_id", "pct_before", "pct_after", "class_pred", "reg_pred", "fused_pred", "reg_direction", "real_direction", "fused_direction"
    )
    return rounded(df, 6, "reg_pred", "fused_pred")


FUSION_KPIS = """SELECT count(*) AS n_rows,
  avg(CASE WHEN class_pred = reg_direction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS agreement_rate,
  count(CASE WHEN class_pred <> reg_direction THEN 1 END) AS discordant,
  avg(abs(pct_after - reg_pred)) AS mae_reg, avg(abs(pct_after - fused_pred)) AS mae_fused,
  avg(abs(pct_after - reg_pred)) - avg(abs(pct_after - fused_pred)) AS mae_gain,
  avg(CASE WHEN reg_direction = real_direction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS direction_accuracy_reg,
  avg(CASE WHEN fused_direction = real_direction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS direction_accuracy_fused
FROM fused_complete"""

KPI_NAMES = ("agreement_rate", "mae_reg", "mae_fused", "mae_gain", "direction_accuracy_reg", "direction_accuracy_fused")


def business_kpis(spark, sf_dir) -> DataFrame:
    rows = with_fusion(complete(scored(spark, sf_dir)), "pct_before", "pct_after", "reg_pred", "class_pred", CLASSES)
    return fusion_kpis(rows, "pct_after", "reg_pred", "class_pred")


@query(
    "fusion_kpis",
    over(
        FUSED,
        f"\nk AS ({FUSION_KPIS})",
        select="SELECT n_rows, discordant, " + ", ".join(f"round({c}, 6) AS {c}" for c in KPI_NAMES) + " FROM k",
    ),
)
def fusion_kpi_row(spark, sf_dir):
    return rounded(business_kpis(spark, sf_dir), 6, *KPI_NAMES)


@query(
    "kpi_texts",
    over(
        FUSED,
        f"\nk AS ({FUSION_KPIS})",
        select="""SELECT printf('%.2f%%', agreement_rate * 100) AS agreement, printf('%.4f', mae_fused) AS mae_fused,
  printf('%.3f', mae_reg) AS mae_reg, printf('%+.4f pp', mae_gain) AS gain FROM k""",
    ),
)
def kpi_texts(spark, sf_dir):
    return business_kpis(spark, sf_dir).select(
        percent_text("agreement_rate").alias("agreement"),
        decimal_text("mae_fused", 4).alias("mae_fused"),
        decimal_text("mae_reg", 3).alias("mae_reg"),
        signed_points_text("mae_gain").alias("gain"),
    )


@query(
    "correction_surface",
    over(
        FUSED,
        """
box AS (SELECT min(reg_pred) AS x0, max(reg_pred) AS x1, min(fused_pred) AS y0, max(fused_pred) AS y1 FROM fused_complete),
cells AS (
  SELECT CAST(least(floor((reg_pred - x0) / (x1 - x0) * 50.0::DOUBLE), 49) AS INTEGER) AS cell_x,
         CAST(least(floor((fused_pred - y0) / (y1 - y0) * 50.0::DOUBLE), 49) AS INTEGER) AS cell_y, count(*) AS n
  FROM fused_complete, box GROUP BY 1, 2),
shares AS (
  SELECT *, n::DOUBLE / sum(n) OVER () AS share,
         sum(n) OVER (ORDER BY n RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE / sum(n) OVER () AS upto FROM cells)""",
        select="SELECT cell_x, cell_y, n, round(share, 6) AS share FROM shares WHERE upto > 0.05::DOUBLE",
    ),
)
def correction_surface(spark, sf_dir):
    scores = complete(staged_scores(spark, sf_dir, "pct_before", "pct_after", "reg_pred", "class_pred"))
    rows = with_fusion(scores, "pct_before", "pct_after", "reg_pred", "class_pred", CLASSES)
    return rounded(density_grid(rows, "reg_pred", "fused_pred", 50, 0.05), 6, "share")


@query(
    "smooth_surface",
    over(
        FUSED,
        """
stats AS (
  SELECT count(*) AS n, var_samp(reg_pred) * pow(count(*), -1.0 / 3) AS a, covar_samp(reg_pred, fused_pred) * pow(count(*), -1.0 / 3) AS b,
         var_samp(fused_pred) * pow(count(*), -1.0 / 3) AS c, min(reg_pred) AS x0, max(reg_pred) AS x1,
         min(fused_pred) AS y0, max(fused_pred) AS y1 FROM fused_complete),
grid AS (
  SELECT *, x0 - 3 * sqrt(a) AS px, (x1 - x0 + 6 * sqrt(a)) / 99 AS dx, y0 - 3 * sqrt(c) AS py, (y1 - y0 + 6 * sqrt(c)) / 99 AS dy FROM stats),
placed AS (
  SELECT (reg_pred - px) / dx AS u, (fused_pred - py) / dy AS v FROM fused_complete, grid),
corners AS (
  SELECT CAST(floor(u) AS INTEGER) + di AS i, CAST(floor(v) AS INTEGER) + dj AS j,
         sum(abs(1 - di - (u - floor(u))) * abs(1 - dj - (v - floor(v)))) AS w
  FROM placed, (VALUES (0), (1)) AS p(di), (VALUES (0), (1)) AS q(dj) GROUP BY 1, 2),
spread AS (
  SELECT CAST(i + di AS INTEGER) AS cell_x, CAST(j + dj AS INTEGER) AS cell_y, w,
         (c * di * dx * di * dx - 2 * b * di * dx * dj * dy + a * dj * dy * dj * dy) / (a * c - b * b) AS q
  FROM corners, grid, (SELECT unnest(range(-40, 41)) AS di), (SELECT unnest(range(-40, 41)) AS dj)),
points AS (
  SELECT cell_x, cell_y, sum(w * exp(-q / 2)) / (2 * pi() * max(sqrt(a * c - b * b)) * max(n)) AS density
  FROM spread, grid WHERE q <= 25 AND cell_x BETWEEN 0 AND 99 AND cell_y BETWEEN 0 AND 99 GROUP BY 1, 2),
ranked AS (
  SELECT *, sum(density) OVER (ORDER BY density RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(density) OVER () AS upto FROM points)""",
        select="""SELECT cell_x, cell_y, round(px + cell_x * dx, 6) AS x, round(py + cell_y * dy, 6) AS y, round(density, 6) AS density
FROM ranked, grid WHERE upto > 0.05""",
    ),
)
def smoothed(spark, sf_dir):
    scores = complete(staged_scores(spark, sf_dir, "pct_before", "pct_after", "reg_pred", "class_pred"))
    rows = with_fusion(scores, "pct_before", "pct_after", "reg_pred", "class_pred", CLASSES)
    return rounded(smooth_surface(rows, "reg_pred", "fused_pred"), 6, "x", "y", "density")


def split_rows(spark, sf_dir) -> DataFrame:
    """A cut reads its input several times, so the columns the figures need are written once."""
    names = ("policy_id", "pct_before", "pct_after", "reg_pred", "class_true", "class_pred", "p_down", "p_keep", "p_up")
    return random_split(complete(staged_scores(spark, sf_dir, *names)), 0.2, "policy_id", "42")


SPLIT = f"""
parts AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY {hash_order("42")})
                      <= count(*) OVER () - ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split
  FROM fused_complete),
both_parts AS (SELECT *, split AS part FROM parts UNION ALL SELECT *, 'all' AS part FROM parts)"""

_KPI_SQL = {
    "accuracy": "avg(CASE WHEN class_pred = class_true THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)",
    "balanced_accuracy": "("
    + " + ".join(
        f"avg(CASE WHEN class_true = '{c}' THEN CASE WHEN class_pred = class_true THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END)"
        for c in ("down", "keep", "up")
    )
    + ") / 3",
    "log_loss": "avg(-ln(greatest(2.220446049250313e-16::DOUBLE, least(1.0::DOUBLE - 2.220446049250313e-16::DOUBLE,"
    " CASE class_true WHEN 'up' THEN p_up WHEN 'down' THEN p_down ELSE p_keep END))))",
    "brier": "("
    + " + ".join(f"avg(pow(p_{c} - CAST(class_true = '{c}' AS DOUBLE), 2))" for c in ("down", "keep", "up"))
    + ") / 3",
    "rmse": "sqrt(avg(pow(pct_after - reg_pred, 2)))",
    "mae": "avg(abs(pct_after - reg_pred))",
    "log10_mape": "log10(avg(abs(pct_after - reg_pred) / greatest(abs(pct_after), 2.220446049250313e-16::DOUBLE)))",
    "rmsle": "sqrt(avg(pow(ln(1 + pct_after) - ln(1 + reg_pred), 2)))",
    "r2": "1 - sum(pow(pct_after - reg_pred, 2)) / (var_pop(pct_after) * count(*))",
    "r2_adj": "1 - (sum(pow(pct_after - reg_pred, 2)) / (var_pop(pct_after) * count(*))) * (count(*) - 1) / (count(*) - 7)",
    "n_rows": "count(*)",
    "agreement_rate": "avg(CASE WHEN class_pred = reg_direction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)",
    "discordant": "count(CASE WHEN coalesce(class_pred = reg_direction, false) THEN NULL ELSE 1 END)",
    "mae_reg": "avg(abs(pct_after - reg_pred))",
    "mae_fused": "avg(abs(pct_after - fused_pred))",
    "mae_gain": "avg(abs(pct_after - reg_pred)) - avg(abs(pct_after - fused_pred))",
    "direction_accuracy_reg": "avg(CASE WHEN reg_direction = real_direction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)",
    "direction_accuracy_fused": "avg(CASE WHEN fused_direction = real_direction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)",
}
_KPI_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, part AS split, round(CAST({expr} AS DOUBLE), 6) AS value FROM both_parts GROUP BY part"
    for name, expr in _KPI_SQL.items()
)


def all_kpis(spark, sf_dir) -> DataFrame:
    table = kpi_table(
        split_rows(spark, sf_dir), "pct_before", "pct_after", "reg_pred", "class_true", "class_pred", probabilities(), 6
    )
    # On whole percentages with zeros the relative error explodes; its logarithm can be compared.
    is_mape = F.col("metric") == "mape"
    return table.select(
        F.when(is_mape, "log10_mape").otherwise(F.col("metric")).alias("metric"),
        "split",
        F.when(is_mape, F.log10("value")).otherwise(F.col("value")).alias("value"),
    )


@query("kpi_table", over(FUSED, SPLIT, select=_KPI_ROWS))
def kpi_rows(spark, sf_dir):
    return rounded(all_kpis(spark, sf_dir), 6, "value")


@query(
    "kpi_side_by_side",
    over(
        FUSED,
        SPLIT,
        f"\nk AS ({_KPI_ROWS})",
        select="""SELECT metric, max(CASE WHEN split = 'train' THEN value END) AS train,
  max(CASE WHEN split = 'test' THEN value END) AS test, max(CASE WHEN split = 'all' THEN value END) AS "all"
FROM k GROUP BY metric""",
    ),
)
def kpi_columns(spark, sf_dir):
    return rounded(side_by_side(all_kpis(spark, sf_dir)), 6, "train", "test", "all")
