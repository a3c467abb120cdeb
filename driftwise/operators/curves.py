"""ROC and precision-recall curves whose running counts do not pass through one task.

A curve needs cumulative counts in score order per class, and there are only a
few classes. Scores are collapsed to distinct values first (a score shared by a
third of the rows becomes one row in the map-side combine), then cut into ranges
of similar size. Counts run inside a range; the totals of the ranges above it,
a table of (classes x ranges) rows, shift them into place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwise.operators.classification import one_vs_rest
from driftwise.operators.ranges import default_ranges, range_edges, with_range

def score_steps(
    df: DataFrame, label: str, probabilities: dict[str, Column], by: tuple[str, ...] = (), ranges: int | None = None
) -> DataFrame:
    """One row per class and distinct score, in descending order of score:
    positives and negatives at the score (pos, neg), down to and including it (tp, fp),
    at the next lower score (next_pos, next_neg), and in total (n_pos, n_neg)."""
    group = [*by, "class"]
    long = one_vs_rest(df, label, probabilities, by).filter("score IS NOT NULL")
    edges = range_edges(long, "score", ranges or default_ranges(df))
    points = long.groupBy(*group, "score").agg(
        F.sum("is_positive").alias("pos"), F.sum(1 - F.col("is_positive")).alias("neg")
    )
    points = with_range(points, "score", edges, "_range")
    downward = Window.partitionBy(*group).orderBy(F.desc("_range"))
    above = downward.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*group)
    totals = (
        points.groupBy(*group, "_range")
        .agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"), F.max_by(F.struct("pos", "neg"), "score").alias("_top"))
        .select(
            *group,
            "_range",
            F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_tp"),
            F.coalesce(F.sum("_neg").over(above), F.lit(0)).alias("_fp"),
            F.sum("_pos").over(every).alias("n_pos"),
            F.sum("_neg").over(every).alias("n_neg"),
            F.lead("_top").over(downward).alias("_below"),
        )
    )
    inside = Window.partitionBy(*group, "_range").orderBy(F.desc("score"))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.coalesce(F.lead(F.struct("pos", "neg")).over(inside), F.col("_below"))
    # (classes x ranges) rows, at most MAX_RANGES per class.
    return points.join(F.broadcast(totals), [*group, "_range"]).select(
        *group,
        "score",
        "pos",
        "neg",
        (F.sum("pos").over(upto) + F.col("_tp")).alias("tp"),
        (F.sum("neg").over(upto) + F.col("_fp")).alias("fp"),
        following["pos"].alias("next_pos"),
        following["neg"].alias("next_neg"),
        "n_pos",
        "n_neg",
    )


def _with_start(steps: DataFrame, by: tuple[str, ...], start: list[Column], point: list[Column]) -> DataFrame:
    """Emit the fixed end of the curve together with the highest score."""
    is_first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    rows = F.when(is_first, F.array(F.struct(*start), F.struct(*point))).otherwise(F.array(F.struct(*point)))
    return steps.select(*by, "class", F.inline(rows))


def _share(count: str, total: str) -> Column:
    return F.when(F.col(total) > 0, F.col(count) / F.col(total))


def roc_curve(df: DataFrame, label: str, probabilities: dict[str, Column], by: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """(class, score, fpr, tpr) from (0, 0) on; inner points on a straight line are left out."""
    steps = score_steps(df, label, probabilities, by, ranges)
    is_first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    is_last = F.col("next_pos").isNull()
    turns = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
    return _with_start(
        steps.filter(is_first | is_last | turns),
        by,
        [F.lit(None).cast("double").alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")],
        [F.col("score"), _share("fp", "n_neg").alias("fpr"), _share("tp", "n_pos").alias("tpr")],
    )


def precision_recall_curve(
    df: DataFrame, label: str, probabilities: dict[str, Column], by: tuple[str, ...] = (), ranges: int | None = None
) -> DataFrame:
    """(class, score, precision, recall); ends at recall 0, precision 1."""
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return _with_start(
        score_steps(df, label, probabilities, by, ranges),
        by,
        [F.lit(None).cast("double").alias("score"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")],
        [F.col("score"), precision.alias("precision"), _share("tp", "n_pos").alias("recall")],
    )


def areas(df: DataFrame, label: str, probabilities: dict[str, Column], by: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """(class, auc, average_precision): trapezoids under ROC and the step sum under precision-recall."""
    steps = score_steps(df, label, probabilities, by, ranges)
    trapezoid = F.col("neg").cast("double") * (F.col("tp") * 2.0 - F.col("pos")) / 2.0
    step = F.col("pos").cast("double") * F.col("tp") / (F.col("tp") + F.col("fp"))
    sums = steps.groupBy(*by, "class").agg(
        F.sum(trapezoid).alias("_area"), F.sum(step).alias("_steps"), F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg")
    )
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return sums.select(
        *by,
        "class",
        F.when(both, F.col("_area") / F.col("n_pos") / F.col("n_neg")).alias("auc"),
        F.when(F.col("n_pos") > 0, F.col("_steps") / F.col("n_pos")).alias("average_precision"),
    )
