"""Classification metrics from one aggregate over (label, predicted class, probabilities).

Per-class sums are conditional aggregates over class literals: the data is read
once, each task sends one row per split, and the layout happens on that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: machine epsilon of a double.
EPSILON = 2.220446049250313e-16


def one_vs_rest(df: DataFrame, label: str, probabilities: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """(class, is_positive, score): one row per input row and class."""
    rows = [
        F.struct(F.lit(c).alias("class"), (F.col(label) == c).cast("int").alias("is_positive"), p.alias("score"))
        for c, p in probabilities.items()
    ]
    return df.select(*by, F.inline(F.array(*rows)))


def _ratio(numerator: Column, denominator: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def accuracy(df: DataFrame, label: str, predicted: str, by: tuple[str, ...] = ()) -> DataFrame:
    hit = F.when(F.col(label) == F.col(predicted), 1.0).otherwise(0.0)
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def _class_counts(df: DataFrame, label: str, predicted: str, classes: list[str], by: tuple[str, ...]) -> DataFrame:
    sums = []
    for i, c in enumerate(classes):
        actual, chosen = F.col(label) == c, F.col(predicted) == c
        sums += [
            F.count(F.when(actual & chosen, 1)).alias(f"_tp{i}"),
            F.count(F.when(chosen, 1)).alias(f"_pred{i}"),
            F.count(F.when(actual, 1)).alias(f"_true{i}"),
        ]
    return df.groupBy(*by).agg(*sums)


def class_report(df: DataFrame, label: str, predicted: str, classes: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(class, precision, recall, f1, support); 0 where a denominator is 0."""
    rows = []
    for i, c in enumerate(classes):
        tp, pred, true = F.col(f"_tp{i}"), F.col(f"_pred{i}"), F.col(f"_true{i}")
        rows.append(
            F.struct(
                F.lit(c).alias("class"),
                _ratio(tp, pred).alias("precision"),
                _ratio(tp, true).alias("recall"),
                _ratio(tp * 2.0, pred + true).alias("f1"),
                true.alias("support"),
            )
        )
    return _class_counts(df, label, predicted, classes, by).select(*by, F.inline(F.array(*rows)))


def balanced_accuracy(df: DataFrame, label: str, predicted: str, classes: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Mean recall over the classes that occur."""
    report = class_report(df, label, predicted, classes, by).filter("support > 0")
    return report.groupBy(*by).agg(F.avg("recall").alias("balanced_accuracy"))


def averaged_report(df: DataFrame, label: str, predicted: str, classes: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Macro and support-weighted means of the class report."""
    report = class_report(df, label, predicted, classes, by)
    names = ("precision", "recall", "f1")
    means = report.groupBy(*by).agg(
        *[F.avg(m).alias(f"_macro_{m}") for m in names],
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"_weighted_{m}") for m in names],
        F.sum("support").alias("_support"),
    )
    rows = [
        F.struct(F.lit(kind).alias("average"), *[F.col(f"_{kind}_{m}").alias(m) for m in names], F.col("_support").alias("support"))
        for kind in ("macro", "weighted")
    ]
    return means.select(*by, F.inline(F.array(*rows)))


def _log_loss(label: str, probabilities: dict[str, Column], eps: float) -> Column:
    chosen = F.lit(None).cast("double")
    for c, p in probabilities.items():
        chosen = F.when(F.col(label) == c, p).otherwise(chosen)
    clipped = F.when(chosen.isNotNull(), F.greatest(F.lit(eps), F.least(F.lit(1.0 - eps), chosen)))
    return F.avg(-F.log(clipped))


def _mean_brier(label: str, probabilities: dict[str, Column]) -> Column:
    squares = [F.avg((p - (F.col(label) == c).cast("double")) ** 2) for c, p in probabilities.items()]
    return sum(squares, F.lit(0.0)) / len(squares)


def log_loss(df: DataFrame, label: str, probabilities: dict[str, Column], eps: float = EPSILON, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by).agg(_log_loss(label, probabilities, eps).alias("log_loss"))


def mean_brier(df: DataFrame, label: str, probabilities: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Mean over classes of the one-vs-rest squared error."""
    return df.groupBy(*by).agg(_mean_brier(label, probabilities).alias("brier"))


def summary_columns(label: str, predicted: str, probabilities: dict[str, Column], eps: float = EPSILON) -> list[Column]:
    """Accuracy, balanced accuracy, log loss and Brier score as aggregates."""
    classes = list(probabilities)
    hit = F.when(F.col(label) == F.col(predicted), 1.0).otherwise(0.0)
    recalls, present = F.lit(0.0), F.lit(0)
    for c in classes:
        actual = F.col(label) == c
        recalls = recalls + F.coalesce(F.avg(F.when(actual, hit)), F.lit(0.0))
        present = present + F.when(F.count(F.when(actual, 1)) > 0, 1).otherwise(0)
    return [
        F.avg(hit).alias("accuracy"),
        F.when(present > 0, recalls / present).alias("balanced_accuracy"),
        _log_loss(label, probabilities, eps).alias("log_loss"),
        _mean_brier(label, probabilities).alias("brier"),
    ]


def summary(
    df: DataFrame, label: str, predicted: str, probabilities: dict[str, Column], by: tuple[str, ...] = (), eps: float = EPSILON
) -> DataFrame:
    return df.groupBy(*by).agg(*summary_columns(label, predicted, probabilities, eps))


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Row per actual class, column ``pred_<class>`` per predicted class, zeros filled."""
    counts = df.groupBy(*by, F.col(label).alias("_a"), F.col(predicted).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    cells = [
        F.coalesce(F.sum(F.when((F.col("_a") == a) & (F.col("_p") == p), F.col("_n"))), F.lit(0)).alias(f"_{i}_{j}")
        for i, a in enumerate(classes)
        for j, p in enumerate(classes)
    ]
    rows = [
        F.struct(F.lit(a).alias("actual"), *[F.col(f"_{i}_{j}").alias(f"pred_{p}") for j, p in enumerate(classes)])
        for i, a in enumerate(classes)
    ]
    return counts.groupBy(*by).agg(*cells).select(*by, F.inline(F.array(*rows)))


def reliability_bins(df: DataFrame, label: str, probabilities: dict[str, Column], bins: int = 10, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean predicted probability and observed rate per (a, b] bin; empty bins are absent."""
    bin_ = F.greatest(F.lit(0), F.ceil(F.col("score") * bins).cast("int") - 1)
    return (
        one_vs_rest(df, label, probabilities, by)
        .filter("score IS NOT NULL")
        .groupBy(*by, "class", bin_.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"), F.avg("is_positive").alias("observed_rate"))
    )
