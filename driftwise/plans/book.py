"""The whole run over one before/after table: prepare, select, fit, score, fuse, evaluate.

    python -m driftwise.plans.book --csv BOOK.csv --out FOLDER

Everything a step learns is learned from training rows unless ``fit_on="all"``; figures
are reported for train, test and all rows side by side.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwise.functions.scalar import Directions, absolute_error, difference, direction, guarded_ratio, residual
from driftwise.operators import classification as cls
from driftwise.operators import curves
from driftwise.operators import regression as reg
from driftwise.operators.forest import Classifier, fit_forest, forest_grid
from driftwise.operators.fusion import with_fusion
from driftwise.operators.kpis import kpi_table
from driftwise.operators.prep import Imputer, OneHot, PrincipalComponents, quantile_bin, quantile_edges
from driftwise.operators.profile import class_share, mean_by_segment, missing_counts, numeric_columns, other_columns, profile
from driftwise.operators.ridge import RidgeModel, ridge_search
from driftwise.operators.selection import select_by_cells, select_by_trees
from driftwise.operators.splits import exact_sample, hash_folds, random_split, stratified_folds, stratified_split
from driftwise.session import stage
from driftwise.sources.tables import read_delimited, without_identifiers, write_table


@dataclass(frozen=True)
class BookSpec:
    """Roles of the columns of a before/after table."""

    key: str
    before: str
    after: str
    label: str
    identifiers: tuple[str, ...] = ()
    ratios: dict[str, tuple[str, str]] = field(default_factory=dict)  # name -> (after, before)
    differences: dict[str, tuple[str, str]] = field(default_factory=dict)
    segment: str | None = None
    segment_names: tuple[str, ...] = ("low", "middle", "high")
    names: Directions = Directions()

    def not_features(self) -> tuple[str, ...]:
        return (self.key, *self.identifiers, self.after, self.label, "split")


# Fixed values of the insurance commission book: column names and label names.
COMMISSION_SCHEMA = """
    apolice double, apl_renovada1 double, item_renovado bigint, pct_comiss_depois double,
    cod_corretor_depois bigint, is_casco_depois double, Cod_prod_antes bigint, bonus_antes bigint,
    Bonus_depois bigint, ano_mod_veic_depois bigint, fabricante string, nroapolicerefer double,
    nroitemapolicerefer bigint, cod_corretor_antes bigint, Premio_depois double, Premio_antes double,
    Premio_proposto double, ajuste_medio double, faixa_ajuste_medio string, cpf_cnpj bigint,
    is_casco_antes double, Origem string, CIA string, ano_mod_veic_antes bigint, pct_comiss_antes double,
    canal_antes bigint, tp_pessoa string, mudou_corret string, status_comiss string, status_prem string,
    status_filial string, status_is string, mudanca_premio double, regestudo_antes string,
    ajuste_preco double, ajuste_is double, Score_Autoglass_antes bigint, Score_Serasa_antes bigint,
    Score_RF_antes double, Score_Sinistro_antes double, Score_Autoglass_depois bigint,
    Score_Serasa_depois double, Score_RF_depois double, Score_Sinistro_depois double, filial_antes string
"""
COMMISSION_BOOK = BookSpec(
    key="row_key",
    before="pct_comiss_antes",
    after="pct_comiss_depois",
    label="target_class",
    identifiers=("apolice", "apl_renovada1", "item_renovado", "nroapolicerefer", "nroitemapolicerefer", "cpf_cnpj"),
    ratios={"ratio_premio": ("Premio_depois", "Premio_antes")},
    differences={"diff_score_serasa": ("Score_Serasa_depois", "Score_Serasa_antes")},
    segment="Premio_antes",
    segment_names=("Baixo Ticket", "Medio Ticket", "Alto Ticket"),
    names=Directions(up="Aumentou", down="Diminuiu", keep="Manteve"),
)
PERSONAL = ("cpf_cnpj",)


def labelled(df: DataFrame, spec: BookSpec) -> DataFrame:
    """The table with a key and the label, written once. Rows of a file have no key of their
    own; a written number stays the same in every later pass."""
    keyed = df if spec.key in df.columns else df.withColumn(spec.key, F.monotonically_increasing_id())
    return stage(keyed.withColumn(spec.label, direction(spec.before, spec.after, spec.names)), "book")


@dataclass(frozen=True)
class Preparation:
    """Fitted imputation, derived columns, components and encoding."""

    spec: BookSpec
    imputer: Imputer
    components: PrincipalComponents
    encoder: OneHot
    features: list[str]

    @classmethod
    def fit(cls, df: DataFrame, spec: BookSpec) -> Preparation:
        numbers = numeric_columns(df, spec.not_features())
        strings = other_columns(df, spec.not_features())
        imputer = Imputer.fit(df, numbers, strings)
        derived = _derived(imputer.transform(df), spec)
        numbers = numbers + [c for c in (*spec.ratios, *spec.differences) if c in derived.columns]
        components = PrincipalComponents.fit(derived, numbers, 2)
        encoder = OneHot.fit(derived, strings)
        return Preparation(spec, imputer, components, encoder, [*numbers, "pca_comp1", "pca_comp2", *encoder.names()])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.encoder.transform(self.components.transform(_derived(self.imputer.transform(df), self.spec)))


def _derived(df: DataFrame, spec: BookSpec) -> DataFrame:
    """Ratios and differences whose columns are all present."""
    new = {n: guarded_ratio(a, b) for n, (a, b) in spec.ratios.items() if {a, b} <= set(df.columns)}
    new |= {n: difference(a, b) for n, (a, b) in spec.differences.items() if {a, b} <= set(df.columns)}
    return df.withColumns(new) if new else df


@dataclass(frozen=True)
class BookRun:
    preparation: Preparation
    selected: list[tuple[int, str, float]]
    grid: list[tuple[int, int, float]]
    forest: Classifier
    ridge: RidgeModel
    ridge_scores: dict[float, float]
    output: DataFrame

    def probabilities(self) -> dict[str, Column]:
        return {c: F.col(f"p_{c}") for c in self.forest.classes}

    def kpis(self) -> DataFrame:
        spec = self.preparation.spec
        return kpi_table(
            self.output, spec.before, spec.after, "reg_pred", spec.label, "class_pred", self.probabilities(), len(self.preparation.features), names=spec.names
        )


def run(
    df: DataFrame,
    spec: BookSpec,
    seed: int = 42,
    select: int = 15,
    scorer: str = "cells",
    scorer_rows: int | None = None,
    trees: Sequence[int] = (50,),
    depths: Sequence[int] = (10,),
    alphas: Sequence[float] = (0.1, 1.0, 10.0),
    search_rows: int | None = None,
    fit_on: str = "train",
) -> BookRun:
    """Fit both models on a labelled table and score every row of it.

    ``df`` is a table that can be read again cheaply; a derived one should be staged first.
    Features are selected on all training rows unless ``scorer_rows`` asks for a sample, as
    the ``trees`` scorer should: it fits a tree per candidate and round. The forest's grid is
    searched on all training rows unless ``search_rows`` bounds it.
    """
    classes = spec.names.names()
    # written, so that the passes of the fits do not hash every key again
    rows = stage(stratified_split(df, 0.8, spec.label, spec.key, seed, classes), "split")
    preparation = Preparation.fit(rows.filter("split = 'train'") if fit_on == "train" else rows, spec)
    prepared = stage(preparation.transform(rows), "prepared")
    train = prepared.filter("split = 'train'")

    pool = exact_sample(train, scorer_rows, spec.key, f"{seed}:pool") if scorer_rows else train
    halves = random_split(pool, 0.3, spec.key, f"{seed}:selection", "selection_split")
    select_by = {"cells": select_by_cells, "trees": select_by_trees}[scorer]
    selected = select_by(halves, preparation.features, spec.label, classes, "selection_split", select)
    chosen = [name for _, name, _ in selected]

    sample = exact_sample(train, search_rows, spec.key, f"{seed}:search") if search_rows else train
    folds = stage(stratified_folds(sample, 3, spec.label, spec.key, f"{seed}:folds", classes), "grid")
    grid = forest_grid(folds, chosen, spec.label, classes, "fold", trees, depths, seed)
    forest = fit_forest(train, chosen, spec.label, classes, grid[0][0], grid[0][1], seed)

    search = ridge_search(hash_folds(train, 3, spec.key, f"{seed}:ridge"), preparation.features, spec.after, "fold", 3, alphas)
    predicted = search.model.transform(forest.transform(prepared))
    output = with_fusion(predicted, spec.before, spec.after, "reg_pred", "class_pred", spec.names)
    return BookRun(preparation, selected, grid, forest, search.model, search.scores, stage(output, "output"))


def write_reports(result: BookRun, raw: DataFrame, out: str, qq_points: int | None = None) -> None:
    """Every table behind the reports, as Parquet under ``out``; Q-Q points of all test rows, or
    of an exact sample for a drawing."""
    spec, spark = result.preparation.spec, raw.sparkSession
    rows, p, label = result.output, result.probabilities(), spec.label
    classes = list(p)
    test = rows.filter("split = 'test'")
    edges = quantile_edges(rows, spec.segment, len(spec.segment_names)) if spec.segment else None
    tables = {
        "profile": profile(raw),
        "missing": missing_counts(raw),
        "class_share": class_share(raw, label),
        "selected_features": spark.createDataFrame(result.selected, "round int, feature string, accuracy double"),
        "forest_grid": spark.createDataFrame(result.grid, "trees int, depth int, accuracy double"),
        "ridge_grid": spark.createDataFrame(list(result.ridge_scores.items()), "alpha double, r2 double"),
        "importances": result.forest.importance_table(rows),
        "kpis": result.kpis(),
        "class_report": cls.class_report(rows, label, "class_pred", classes, ("split",)),
        "confusion": cls.confusion_matrix(rows, label, "class_pred", classes, ("split",)),
        "roc": curves.roc_curve(test, label, p),
        "precision_recall": curves.precision_recall_curve(test, label, p),
        "areas": curves.areas(test, label, p),
        "reliability": cls.reliability_bins(test, label, p),
        "hexagons": reg.hexagon_counts(test, spec.after, "reg_pred"),
        "qq": reg.qq_points(test, residual(spec.after, "reg_pred"), spec.key, 42, qq_points),
        "residuals": reg.residuals_by_fitted(test, spec.after, "reg_pred"),
        "surface": reg.density_grid(rows, "reg_pred", "fused_pred"),
    }
    if edges:
        segment = quantile_bin(spec.segment, edges, list(spec.segment_names))
        tables["segments"] = mean_by_segment(test, segment, absolute_error(spec.after, "reg_pred"), "mae")
    for name, table in tables.items():
        write_table(table, f"{out}/reports/{name}")


def main(argv: Sequence[str] | None = None) -> None:
    from driftwise.plans.saved import Scorer  # it builds on this module

    arguments = argparse.ArgumentParser(description=__doc__)
    arguments.add_argument("--csv", required=True)
    arguments.add_argument("--out", required=True)
    arguments.add_argument("--search-rows", type=int, help="sample size for the forest grid; all training rows if absent")
    arguments.add_argument("--seed", type=int, default=42)
    arguments.add_argument("--select", type=int, default=15)
    arguments.add_argument("--scorer", choices=["cells", "trees"], default="cells")
    arguments.add_argument("--scorer-rows", type=int, help="sample size for feature selection; all training rows if absent")
    arguments.add_argument("--fit-on", choices=["train", "all"], default="train")
    arguments.add_argument("--qq-points", type=int, help="sample size of the Q-Q points; all test rows if absent")
    given = arguments.parse_args(argv)
    spark = SparkSession.builder.appName("driftwise").getOrCreate()
    rows = without_identifiers(read_delimited(spark, given.csv, COMMISSION_SCHEMA), drop=PERSONAL)
    book = labelled(rows, COMMISSION_BOOK)
    result = run(
        book, COMMISSION_BOOK, given.seed, given.select, given.scorer, given.scorer_rows,
        search_rows=given.search_rows, fit_on=given.fit_on,
    )
    write_table(result.output, f"{given.out}/output")
    write_reports(result, book, given.out, given.qq_points)
    Scorer.of(result).save(spark, f"{given.out}/fit", overwrite=True)  # like the other outputs


if __name__ == "__main__":
    main()
