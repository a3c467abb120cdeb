"""Classification and regression evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwise.functions import normal
from driftwise.functions.scalar import residual
from driftwise.operators import classification as cls
from driftwise.operators import curves
from driftwise.operators import regression as reg
from driftwise.plans.bindings import CLASSES, complete, probabilities, scored, staged_scores, table
from driftwise.plans.catalog import query
from driftwise.plans.fusion_queries import FUSED, SPLIT, rounded, split_rows
from driftwise.plans.twins import LONG, SCORED, STEPS, hash_order, over
from driftwise.session import stage

NAMES = CLASSES.names()


def _rows(spark, sf_dir):
    return scored(spark, sf_dir).select("policy_id", "class_true", "class_pred", "p_down", "p_keep", "p_up")


def _curve_rows(spark, sf_dir):
    """Curves read scores twice: for range edges and for the counts."""
    return staged_scores(spark, sf_dir, "class_true", "p_down", "p_keep", "p_up")


def _values(spark, sf_dir):
    """Gridded tables read values twice: for the span and for the counts."""
    return staged_scores(spark, sf_dir, "pct_after", "reg_pred")


@query(
    "accuracy",
    over(SCORED, select="SELECT round(avg(CASE WHEN class_pred = class_true THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy FROM scored"),
)
def accuracy(spark, sf_dir):
    return rounded(cls.accuracy(_rows(spark, sf_dir), "class_true", "class_pred"), 6, "accuracy")


@query(
    "balanced_accuracy",
    over(
        SCORED,
        select="""SELECT round(avg(recall), 6) AS balanced_accuracy FROM
(SELECT avg(CASE WHEN class_pred = class_true THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS recall FROM scored GROUP BY class_true)""",
    ),
)
def balanced_accuracy(spark, sf_dir):
    return rounded(cls.balanced_accuracy(_rows(spark, sf_dir), "class_true", "class_pred", NAMES), 6, "balanced_accuracy")


@query(
    "log_loss",
    over(
        SCORED,
        select="""SELECT round(avg(-ln(greatest(2.220446049250313e-16::DOUBLE, least(1.0::DOUBLE - 2.220446049250313e-16::DOUBLE,
  CASE class_true WHEN 'up' THEN p_up WHEN 'down' THEN p_down ELSE p_keep END)))), 6) AS log_loss FROM scored""",
    ),
)
def log_loss(spark, sf_dir):
    return rounded(cls.log_loss(_rows(spark, sf_dir), "class_true", probabilities()), 6, "log_loss")


@query(
    "mean_brier",
    over(SCORED, LONG, select="SELECT round(avg(b), 6) AS brier FROM (SELECT avg(pow(score - is_positive, 2)) AS b FROM ovr GROUP BY class)"),
)
def mean_brier(spark, sf_dir):
    return rounded(cls.mean_brier(_rows(spark, sf_dir), "class_true", probabilities()), 6, "brier")


REPORT = """
counts AS (
  SELECT class, count(CASE WHEN class_true = class AND class_pred = class THEN 1 END)::DOUBLE AS tp,
         count(CASE WHEN class_pred = class THEN 1 END)::DOUBLE AS chosen, count(CASE WHEN class_true = class THEN 1 END) AS support
  FROM scored, (VALUES ('down'), ('keep'), ('up')) AS c(class) GROUP BY class),
report AS (
  SELECT class, CASE WHEN chosen = 0 THEN 0 ELSE tp / chosen END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
         CASE WHEN chosen + support = 0 THEN 0 ELSE 2 * tp / (chosen + support) END AS f1, support FROM counts)"""


@query(
    "class_report",
    over(
        SCORED,
        REPORT,
        select="SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report",
    ),
)
def class_report(spark, sf_dir):
    report = cls.class_report(_rows(spark, sf_dir), "class_true", "class_pred", NAMES)
    return rounded(report, 6, "precision", "recall", "f1")


@query(
    "averaged_report",
    over(
        SCORED,
        REPORT,
        select="""SELECT 'macro' AS average, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
  round(avg(f1), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM report
UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM report""",
    ),
)
def averaged_report(spark, sf_dir):
    report = cls.averaged_report(_rows(spark, sf_dir), "class_true", "class_pred", NAMES)
    return rounded(report, 6, "precision", "recall", "f1")


_CELLS = ", ".join(f"count(CASE WHEN class_pred = '{c}' THEN 1 END) AS pred_{c}" for c in ("down", "keep", "up"))


@query("confusion_matrix", over(SCORED, select=f"SELECT class_true AS actual, {_CELLS} FROM scored GROUP BY class_true"))
def confusion_matrix(spark, sf_dir):
    return cls.confusion_matrix(_rows(spark, sf_dir), "class_true", "class_pred", NAMES)


@query(
    "confusion_by_split",
    over(FUSED, SPLIT, select=f"SELECT split, class_true AS actual, {_CELLS} FROM parts GROUP BY split, class_true"),
)
def confusion_by_split(spark, sf_dir):
    return cls.confusion_matrix(split_rows(spark, sf_dir), "class_true", "class_pred", NAMES, ("split",))


@query(
    "roc_curve",
    over(
        SCORED,
        LONG,
        STEPS,
        select="""SELECT class, round(score, 9) AS score, round(fp::DOUBLE / n_neg, 9) AS fpr, round(tp::DOUBLE / n_pos, 9) AS tpr FROM steps
WHERE step = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg
UNION ALL SELECT DISTINCT class, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM steps""",
    ),
)
def roc_curve(spark, sf_dir):
    return rounded(curves.roc_curve(_curve_rows(spark, sf_dir), "class_true", probabilities()), 9, "score", "fpr", "tpr")


@query(
    "precision_recall_curve",
    over(
        SCORED,
        LONG,
        STEPS,
        select="""SELECT class, round(score, 9) AS score, round(tp::DOUBLE / (tp + fp), 9) AS precision, round(tp::DOUBLE / n_pos, 9) AS recall
FROM steps UNION ALL SELECT DISTINCT class, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM steps""",
    ),
)
def precision_recall_curve(spark, sf_dir):
    points = curves.precision_recall_curve(_curve_rows(spark, sf_dir), "class_true", probabilities())
    return rounded(points, 9, "score", "precision", "recall")


@query(
    "roc_auc",
    over(
        SCORED,
        LONG,
        STEPS,
        select="""SELECT class, round(sum(neg::DOUBLE * (2 * tp - pos)) / 2 / max(n_pos) / max(n_neg), 6) AS auc FROM steps GROUP BY class""",
    ),
)
def roc_auc(spark, sf_dir):
    areas = curves.areas(_curve_rows(spark, sf_dir), "class_true", probabilities())
    return rounded(areas.select("class", "auc"), 6, "auc")


@query(
    "average_precision",
    over(
        SCORED,
        LONG,
        STEPS,
        select="""SELECT class, round(sum(pos::DOUBLE * tp / (tp + fp)) / max(n_pos), 6) AS average_precision FROM steps GROUP BY class""",
    ),
)
def average_precision(spark, sf_dir):
    areas = curves.areas(_curve_rows(spark, sf_dir), "class_true", probabilities())
    return rounded(areas.select("class", "average_precision"), 6, "average_precision")


@query(
    "reliability_bins",
    over(
        SCORED,
        LONG,
        select="""SELECT class, CAST(greatest(0, ceil(score * 10) - 1) AS INTEGER) AS bin, count(*) AS n,
  round(avg(score), 6) AS mean_score, round(avg(is_positive), 6) AS observed_rate FROM ovr GROUP BY 1, 2""",
    ),
)
def reliability_bins(spark, sf_dir):
    bins = cls.reliability_bins(_rows(spark, sf_dir), "class_true", probabilities())
    return rounded(bins, 6, "mean_score", "observed_rate")


def _document_quality(spark, sf_dir):
    """Binary variant: labelled documents scored by their length."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labelled = table(spark, sf_dir, "labels").join(documents, "doc_id")
    return labelled.select(
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label"), (F.col("n_chars") / (F.col("n_chars") + 2000.0)).alias("p")
    )


DOCUMENTS = """
ovr AS (
  SELECT 'good' AS class, CAST(quality = 1 AS INTEGER) AS is_positive, n_chars::DOUBLE / (n_chars + 2000.0::DOUBLE) AS score
  FROM labels JOIN documents USING (doc_id))"""


@query(
    "document_reliability",
    "WITH "
    + DOCUMENTS
    + """SELECT class, CAST(greatest(0, ceil(score * 10) - 1) AS INTEGER) AS bin, count(*) AS n,
  round(avg(score), 6) AS mean_score, round(avg(is_positive), 6) AS observed_rate FROM ovr GROUP BY 1, 2""",
)
def document_reliability(spark, sf_dir):
    bins = cls.reliability_bins(_document_quality(spark, sf_dir), "label", {"good": F.col("p")})
    return rounded(bins, 6, "mean_score", "observed_rate")


@query(
    "document_areas",
    "WITH "
    + DOCUMENTS
    + ","
    + STEPS
    + """SELECT class, round(sum(neg::DOUBLE * (2 * tp - pos)) / 2 / max(n_pos) / max(n_neg), 6) AS auc,
  round(sum(pos::DOUBLE * tp / (tp + fp)) / max(n_pos), 6) AS average_precision FROM steps GROUP BY class""",
)
def document_areas(spark, sf_dir):
    return rounded(curves.areas(stage(_document_quality(spark, sf_dir), "quality"), "label", {"good": F.col("p")}), 6, "auc", "average_precision")


@query(
    "regression_metrics",
    over(
        FUSED,
        SPLIT,
        select="""SELECT split, count(*) AS n, round(sqrt(avg(pow(pct_after - reg_pred, 2))), 6) AS rmse,
  round(avg(abs(pct_after - reg_pred)), 6) AS mae,
  round(log10(avg(abs(pct_after - reg_pred) / greatest(abs(pct_after), 2.220446049250313e-16::DOUBLE))), 9) AS log10_mape,
  round(sqrt(avg(pow(ln(1 + pct_after) - ln(1 + reg_pred), 2))), 6) AS rmsle,
  round(1 - sum(pow(pct_after - reg_pred, 2)) / (var_pop(pct_after) * count(*)), 6) AS r2,
  round(1 - (sum(pow(pct_after - reg_pred, 2)) / (var_pop(pct_after) * count(*))) * (count(*) - 1) / (count(*) - 7), 6) AS r2_adj
FROM parts GROUP BY split""",
    ),
)
def regression_metrics(spark, sf_dir):
    """The relative error explodes on zero percentages by definition, so its magnitude is compared."""
    metrics = reg.regression_metrics(split_rows(spark, sf_dir), "pct_after", "reg_pred", 6, ("split",))
    metrics = metrics.withColumn("log10_mape", F.round(F.log10("mape"), 9)).drop("mape")
    return rounded(metrics, 6, "rmse", "mae", "rmsle", "r2", "r2_adj")


def _polynomial(coefficients: tuple[float, ...], x: str) -> str:
    text = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        text = f"({c!r}::DOUBLE + {x} * {text})"
    return text


_QUANTILE = (
    f"CASE WHEN abs(p - 0.5::DOUBLE) <= 0.425::DOUBLE THEN (p - 0.5::DOUBLE) * {_polynomial(normal.CENTER_OVER, 'r1')} / {_polynomial(normal.CENTER_UNDER, 'r1')}"
    f" ELSE sign(p - 0.5::DOUBLE) * {_polynomial(normal.TAIL_OVER, 'r2')} / {_polynomial(normal.TAIL_UNDER, 'r2')} END"
)
QQ = f"""
drawn AS (SELECT policy_id, pct_after - reg_pred AS ordered FROM complete),
medians AS (
  SELECT row_number() OVER (ORDER BY ordered, policy_id) AS rank, ordered, count(*) OVER () AS n FROM drawn),
shares AS (
  SELECT rank, ordered, CASE WHEN rank = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n) WHEN rank = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n)
              ELSE (rank - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM medians),
radii AS (
  SELECT *, 0.180625::DOUBLE - pow(p - 0.5::DOUBLE, 2) AS r1, sqrt(-ln(least(p, 1 - p))) - 1.6::DOUBLE AS r2 FROM shares),
qq AS (SELECT rank, ordered, {_QUANTILE} AS theoretical FROM radii)"""


def _qq(spark, sf_dir):
    return reg.qq_points(complete(staged_scores(spark, sf_dir, "policy_id", "pct_after", "reg_pred")), residual("pct_after", "reg_pred"), "policy_id")


@query("qq_points", over(SCORED, QQ, select="SELECT CAST(rank AS BIGINT) AS rank, round(theoretical, 6) AS theoretical, round(ordered, 6) AS ordered FROM qq"))
def qq_points(spark, sf_dir):
    return rounded(_qq(spark, sf_dir), 6, "theoretical", "ordered")


@query(
    "qq_line",
    over(
        SCORED,
        QQ,
        select="""SELECT round(regr_slope(ordered, theoretical), 6) AS slope, round(regr_intercept(ordered, theoretical), 6) AS intercept,
  round(corr(theoretical, ordered), 6) AS r FROM qq""",
    ),
)
def qq_line(spark, sf_dir):
    return rounded(reg.qq_line(_qq(spark, sf_dir)), 6, "slope", "intercept", "r")


@query(
    "residuals_by_fitted",
    over(
        SCORED,
        "\nbox AS (SELECT min(reg_pred) AS lo, max(reg_pred) AS hi FROM complete)",
        select="""SELECT CAST(least(floor((reg_pred - lo) / (hi - lo) * 40.0::DOUBLE), 39) AS INTEGER) AS bin, count(*) AS n,
  round(avg(reg_pred), 6) AS mean_fitted, round(avg(pct_after - reg_pred), 6) AS mean_residual,
  round(stddev_samp(pct_after - reg_pred), 6) AS sd_residual FROM complete, box GROUP BY 1""",
    ),
)
def residuals_by_fitted(spark, sf_dir):
    bins = reg.residuals_by_fitted(_values(spark, sf_dir), "pct_after", "reg_pred")
    return rounded(bins, 6, "mean_fitted", "mean_residual", "sd_residual")


@query(
    "hexagon_counts",
    over(
        SCORED,
        """
box AS (SELECT min(pct_after) AS x0, (max(pct_after) - min(pct_after)) / 20 AS sx,
               min(reg_pred) AS y0, (max(reg_pred) - min(reg_pred)) / 11 AS sy FROM complete),
scaled AS (SELECT (pct_after - x0) / sx AS u, (reg_pred - y0) / sy AS v, x0, y0, sx, sy FROM complete, box),
near AS (
  SELECT *, pow(u - floor(u + 0.5::DOUBLE), 2) + 3 * pow(v - floor(v + 0.5::DOUBLE), 2)
            < pow(u - floor(u) - 0.5::DOUBLE, 2) + 3 * pow(v - floor(v) - 0.5::DOUBLE, 2) AS first_lattice FROM scaled),
centers AS (
  SELECT CASE WHEN first_lattice THEN floor(u + 0.5::DOUBLE) ELSE floor(u) + 0.5::DOUBLE END AS cu,
         CASE WHEN first_lattice THEN floor(v + 0.5::DOUBLE) ELSE floor(v) + 0.5::DOUBLE END AS cv, x0, y0, sx, sy FROM near)""",
        select="""SELECT round(cu * any_value(sx) + any_value(x0), 6) AS center_x, round(cv * any_value(sy) + any_value(y0), 6) AS center_y,
  count(*) AS n FROM centers GROUP BY cu, cv""",
    ),
)
def hexagon_counts(spark, sf_dir):
    return rounded(reg.hexagon_counts(_values(spark, sf_dir), "pct_after", "reg_pred", 20), 6, "center_x", "center_y")


@query(
    "agreement_limits",
    over(
        SCORED,
        select="""SELECT round(greatest(min(pct_after), min(reg_pred)), 6) AS low, round(least(max(pct_after), max(reg_pred)), 6) AS high
FROM complete""",
    ),
)
def agreement_limits(spark, sf_dir):
    return rounded(reg.agreement_limits(scored(spark, sf_dir), "pct_after", "reg_pred"), 6, "low", "high")
