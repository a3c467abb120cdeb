"""Classification and regression metrics against plain NumPy."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwise.operators import classification as cls
from driftwise.operators import curves
from driftwise.operators import regression as reg

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def case():
    """600 rows; scores are coarse, so many tie; class c is never predicted."""
    rng = np.random.default_rng(11)
    label = rng.integers(0, 3, 600)
    raw = np.round(rng.random((600, 3)) + 0.4 * np.eye(3)[label], 1) + 0.05
    p = raw / raw.sum(1, keepdims=True)
    pred = p[:, :2].argmax(1)
    return label, pred, p


@pytest.fixture(scope="module")
def rows(spark, case):
    label, pred, p = case
    data = [(i, NAMES[t], NAMES[q], *map(float, s)) for i, (t, q, s) in enumerate(zip(label, pred, p))]
    return spark.createDataFrame(data, "k int, label string, pred string, p_a double, p_b double, p_c double")


@pytest.fixture(scope="module")
def probabilities(spark):
    return {c: F.col(f"p_{c}") for c in NAMES}


def numpy_steps(truth, score):
    """(score, tp, fp) at each distinct score, from the highest down."""
    steps = []
    for s in np.unique(score)[::-1]:
        steps.append((s, int((truth & (score >= s)).sum()), int((~truth & (score >= s)).sum())))
    return steps


def test_summary(rows, case, probabilities):
    label, pred, p = case
    got = cls.summary(rows, "label", "pred", probabilities).first()
    assert got.accuracy == pytest.approx((label == pred).mean())
    assert got.balanced_accuracy == pytest.approx(np.mean([(pred[label == c] == c).mean() for c in range(3)]))
    assert got.log_loss == pytest.approx(-np.log(p[np.arange(600), label]).mean())
    assert got.brier == pytest.approx(np.mean([((p[:, c] - (label == c)) ** 2).mean() for c in range(3)]))
    assert cls.accuracy(rows, "label", "pred").first()[0] == got.accuracy
    assert cls.balanced_accuracy(rows, "label", "pred", NAMES).first()[0] == pytest.approx(got.balanced_accuracy)


def test_log_loss_clips_certain_misses(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("b", 0.0, 1.0), ("a", None, 1.0)], "label string, p_a double, p_b double")
    p = {"a": F.col("p_a"), "b": F.col("p_b")}
    assert cls.log_loss(df, "label", p, 1e-15).first()[0] == pytest.approx((-math.log(1e-15) - math.log(1 - 1e-15)) / 2)


def test_balanced_accuracy_ignores_absent_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "b")], "label string, pred string")
    assert cls.balanced_accuracy(df, "label", "pred", NAMES).first()[0] == 0.75


def test_report_confusion_and_averages(rows, case):
    label, pred, _ = case
    report = {r["class"]: r for r in cls.class_report(rows, "label", "pred", NAMES).collect()}
    matrix = {r.actual: [r.pred_a, r.pred_b, r.pred_c] for r in cls.confusion_matrix(rows, "label", "pred", NAMES).collect()}
    assert sum(map(sum, matrix.values())) == 600
    for i, c in enumerate(NAMES):
        hits, chosen, actual = matrix[c][i], sum(matrix[a][i] for a in NAMES), sum(matrix[c])
        assert matrix[c] == [int(((label == i) & (pred == j)).sum()) for j in range(3)]
        assert report[c].recall == pytest.approx(hits / actual) and report[c].support == actual
        assert report[c].precision == pytest.approx(hits / chosen if chosen else 0.0)
    assert report["c"].precision == report["c"].recall == report["c"].f1 == 0.0
    means = {r.average: r for r in cls.averaged_report(rows, "label", "pred", NAMES).collect()}
    assert means["macro"].f1 == pytest.approx(np.mean([report[c].f1 for c in NAMES]))
    assert means["weighted"].recall == pytest.approx((label == pred).mean())


def test_confusion_fills_absent_classes(spark):
    df = spark.createDataFrame([("a", "b")], "label string, pred string")
    got = {r.actual: (r.pred_a, r.pred_b, r.pred_c) for r in cls.confusion_matrix(df, "label", "pred", NAMES).collect()}
    assert got == {"a": (0, 1, 0), "b": (0, 0, 0), "c": (0, 0, 0)}


@pytest.mark.parametrize("ranges", [1, 2, 7, 500])
def test_curves_and_areas(rows, case, probabilities, ranges):
    label, _, p = case
    roc = curves.roc_curve(rows, "label", probabilities, ranges=ranges).collect()
    pr = curves.precision_recall_curve(rows, "label", probabilities, ranges=ranges).collect()
    areas = {r["class"]: r for r in curves.areas(rows, "label", probabilities, ranges=ranges).collect()}
    for i, c in enumerate(NAMES):
        truth, score = label == i, p[:, i]
        steps = numpy_steps(truth, score)
        n_pos, n_neg = int(truth.sum()), int((~truth).sum())
        tp, fp = np.array([s[1] for s in steps]), np.array([s[2] for s in steps])
        keep = np.ones(len(steps), bool)
        keep[1:-1] = (np.diff(fp, 2) != 0) | (np.diff(tp, 2) != 0)
        want = [(0.0, 0.0)] + [(f / n_neg, t / n_pos) for t, f, k in zip(tp, fp, keep) if k]
        got = sorted((r.fpr, r.tpr) for r in roc if r["class"] == c)
        np.testing.assert_allclose(got, sorted(want))
        got = sorted((r.recall, r.precision) for r in pr if r["class"] == c)
        np.testing.assert_allclose(got, sorted([(0.0, 1.0)] + [(t / n_pos, t / (t + f)) for t, f in zip(tp, fp)]))
        pairs = [(a > b) + 0.5 * (a == b) for a in score[truth] for b in score[~truth]]
        assert areas[c].auc == pytest.approx(np.mean(pairs))
        recall = np.concatenate([[0], tp / n_pos])
        assert areas[c].average_precision == pytest.approx(float((np.diff(recall) * tp / (tp + fp)).sum()))


def test_one_shared_score_is_one_point(spark):
    df = spark.createDataFrame([("a", 0.2)] * 6 + [("b", 0.2)] * 3, "label string, p double")
    roc = curves.roc_curve(df, "label", {"a": F.col("p")}).collect()
    assert sorted((r.fpr, r.tpr) for r in roc) == [(0.0, 0.0), (1.0, 1.0)]
    area = curves.areas(df, "label", {"a": F.col("p")}).first()
    assert area.auc == 0.5 and area.average_precision == pytest.approx(2 / 3)


def test_class_without_positives_has_no_area(spark):
    df = spark.createDataFrame([("b", 0.1), ("b", 0.2)], "label string, p double")
    area = curves.areas(df, "label", {"a": F.col("p")}).first()
    assert area.auc is None and area.average_precision is None


def test_reliability_bin_edges(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.1), ("a", 0.3), ("a", 1.0), ("a", None)], "label string, p double")
    got = {r.bin: (r.n, r.mean_score, r.observed_rate) for r in cls.reliability_bins(df, "label", {"a": F.col("p")}).collect()}
    assert got == {0: (2, 0.05, 0.5), 2: (1, 0.3, 1.0), 9: (1, 1.0, 1.0)}


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(2)
    y = rng.gamma(3, 4, 500)
    f = y + rng.normal(0, 1, 500).clip(-0.5)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, f))] + [(900, None, 1.0), (901, 1.0, None)], "k int, y double, f double")
    return df, y, f


def test_regression_metrics(fitted):
    df, y, f = fitted
    got = reg.regression_metrics(df, "y", "f", 4).first()
    e = y - f
    r2 = 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum()
    assert got.n == 500
    assert got.rmse == pytest.approx(np.sqrt((e**2).mean())) and got.mae == pytest.approx(np.abs(e).mean())
    assert got.mape == pytest.approx((np.abs(e) / np.abs(y)).mean())
    assert got.rmsle == pytest.approx(np.sqrt(((np.log1p(y) - np.log1p(f)) ** 2).mean()))
    assert got.r2 == pytest.approx(r2) and got.r2_adj == pytest.approx(1 - (1 - r2) * 499 / 495)


def test_one_negative_value_zeroes_rmsle_and_zeros_explode_mape(spark):
    df = spark.createDataFrame([(1.0, -2.0), (2.0, 2.0)], "y double, f double")
    assert reg.regression_metrics(df, "y", "f", 1).first().rmsle == 0.0
    zero = spark.createDataFrame([(0.0, 1.0)], "y double, f double")
    assert reg.regression_metrics(zero, "y", "f", 1).first().mape == pytest.approx(1 / 2.220446049250313e-16)


def test_r2_of_a_constant_truth(spark):
    df = spark.createDataFrame([("x", 1.0, 1.0), ("x", 1.0, 1.0), ("y", 1.0, 2.0), ("y", 1.0, 1.0)], "g string, y double, f double")
    got = {r.g: r.r2 for r in reg.regression_metrics(df, "y", "f", 0, ("g",)).collect()}
    assert got == {"x": 1.0, "y": 0.0}


def test_qq_points_and_line(fitted):
    df, y, f = fitted
    points = reg.qq_points(df, F.col("y") - F.col("f"), "k", 1)
    rows = points.orderBy("rank").collect()
    n = 500
    medians = [1 - 0.5 ** (1 / n), *[(i - 0.3175) / (n + 0.365) for i in range(2, n)], 0.5 ** (1 / n)]
    x = np.array([NormalDist().inv_cdf(m) for m in medians])
    residuals = np.sort(y - f)
    np.testing.assert_allclose([r.theoretical for r in rows], x, atol=1e-12)
    np.testing.assert_allclose([r.ordered for r in rows], residuals)
    slope, intercept = np.polyfit(x, residuals, 1)
    line = reg.qq_line(points).first()
    assert line.slope == pytest.approx(slope) and line.intercept == pytest.approx(intercept)
    assert line.r == pytest.approx(np.corrcoef(x, residuals)[0, 1])
    assert reg.qq_points(df, F.col("y") - F.col("f"), "k", 1, sample=60).count() == 60


def test_grids_count_every_row(fitted):
    df, _, _ = fitted
    assert reg.hexagon_counts(df, "y", "f").agg(F.sum("n")).first()[0] == 500
    assert reg.density_grid(df, "y", "f", 30, 0.0).agg(F.sum("n")).first()[0] == 500
    assert reg.residuals_by_fitted(df, "y", "f").agg(F.sum("n")).first()[0] == 500


def test_hexagon_centers_are_nearest(fitted):
    df, y, f = fitted
    centers = np.array([(r.center_x, r.center_y) for r in reg.hexagon_counts(df, "y", "f", 12).collect()])
    sx, sy = (y.max() - y.min()) / 12, (f.max() - f.min()) / int(12 / math.sqrt(3))
    distance = ((y[:, None] - centers[:, 0]) / sx) ** 2 + 3 * ((f[:, None] - centers[:, 1]) / sy) ** 2
    assert distance.min(1).max() <= 0.75  # half the diagonal of a lattice cell, squared and scaled


def test_density_tail_is_cut_from_the_sparsest(spark):
    df = spark.createDataFrame([(0.0, 0.0)] * 95 + [(1.0, 1.0)] * 5, "x double, y double")
    assert [r.n for r in reg.density_grid(df, "x", "y", 10, 0.05).collect()] == [95]
    assert sorted(r.n for r in reg.density_grid(df, "x", "y", 10, 0.04).collect()) == [5, 95]


def test_agreement_limits(spark):
    df = spark.createDataFrame([(1.0, 2.0), (9.0, 7.0)], "x double, y double")
    assert tuple(reg.agreement_limits(df, "x", "y").first()) == (2.0, 7.0)


def test_smooth_surface_is_the_kernel_density(spark):
    rng = np.random.default_rng(5)
    xy = rng.standard_normal((400, 2)) @ np.array([[3.0, 1.5], [0.0, 0.7]]) + [10.0, -4.0]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in xy] + [(None, 1.0)], "`x.1` double, y double")
    whole = reg.smooth_surface(df, "x.1", "y", 60, 0.0).collect()
    kernel = np.cov(xy.T) * 400 ** (-1 / 3)
    away = np.array([(r.x, r.y) for r in whole])[:, None, :] - xy[None]
    exact = np.exp(-np.einsum("gni,ij,gnj->gn", away, np.linalg.inv(kernel), away) / 2).sum(1) / (400 * 2 * math.pi * math.sqrt(np.linalg.det(kernel)))
    found = np.array([r.density for r in whole])
    assert np.abs(found - exact).max() < 0.03 * exact.max()  # rows are moved to grid points
    xs, ys = sorted({r.x for r in whole}), sorted({r.y for r in whole})
    assert found.sum() * (xs[1] - xs[0]) * (ys[1] - ys[0]) == pytest.approx(1.0, abs=0.01)
    kept = {(r.cell_x, r.cell_y) for r in reg.smooth_surface(df, "x.1", "y", 60, 0.3).collect()}
    order = np.argsort(found)
    upto = np.cumsum(found[order]) / found.sum()
    assert kept == {(whole[i].cell_x, whole[i].cell_y) for i, u in zip(order, upto) if u > 0.3}


def test_smooth_surface_needs_a_plane(spark):
    for rows in ([(1.0, 1.0)], [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], [(1.0, 5.0)] * 4):
        with pytest.raises(ValueError):
            reg.smooth_surface(spark.createDataFrame(rows, "x double, y double"), "x", "y")


def test_grids_take_names_with_dots(spark):
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(50)], "`a.b` double, `c.d` double")
    for table in (reg.hexagon_counts(df, "a.b", "c.d"), reg.density_grid(df, "a.b", "c.d", 9, 0.0), reg.residuals_by_fitted(df, "a.b", "c.d")):
        assert table.agg(F.sum("n")).first()[0] == 50
    assert tuple(reg.agreement_limits(df, "a.b", "c.d").first()) == (0.0, 6.0)
