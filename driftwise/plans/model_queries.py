"""Feature selection, classifiers, ridge and the fused run of both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwise.functions.scalar import residual
from driftwise.operators import classification as cls
from driftwise.operators import selection, trees
from driftwise.operators.forest import class_weight_table, fit_forest, fit_tree, forest_grid
from driftwise.operators.kpis import kpi_table
from driftwise.operators.prep import Imputer
from driftwise.operators.ridge import fit_ridge, ridge_search
from driftwise.operators.sparse import ridge_by_steps, sparse_row
from driftwise.operators.splits import hash_folds, random_split, stratified_folds, stratified_split
from driftwise.plans.bindings import CLASSES, probabilities, renewals, scored
from driftwise.plans.book import BookSpec, labelled, run
from driftwise.plans.catalog import query
from driftwise.plans.fusion_queries import rounded
from driftwise.plans.prep_queries import FEATURES, filled
from driftwise.plans.saved import Scorer
from driftwise.plans.tree_twins import bin_tables, drawn, features_drawn, grown
from driftwise.plans.twins import FILLED, hash_order, over
from driftwise.session import new_table_path, stage, stage_once

NAMES = CLASSES.names()
BINS = 4


_fits: dict[tuple, object] = {}


def _fitted(spark, sf_dir, name: str, make):
    """A model is fitted once per session and table and shared by the queries that report on it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _fits:
        _fits[key] = make()
    return _fits[key]


# Feature selection ----------------------------------------------------------------------

_EDGES = ", ".join(
    f"quantile_cont({c}, {i / BINS}) AS e_{c}_{i}" for c in FEATURES for i in range(1, BINS)
)
_BIN_ROWS = " UNION ALL ".join(
    f"SELECT policy_id, class_true, held_out, '{c}' AS candidate, "
    + " + ".join(f"CAST({c} > e_{c}_{i} AS INTEGER)" for i in range(1, BINS))
    + " AS bin FROM parts, edges"
    for c in FEATURES
)
SELECTION = f"""
parts AS (
  SELECT *, row_number() OVER (ORDER BY {hash_order("42")}) > count(*) OVER () - ceil(0.3::DOUBLE * count(*) OVER ()) AS held_out
  FROM filled),
edges AS (SELECT {_EDGES} FROM filled),
binned AS ({_BIN_ROWS}),
overall AS (SELECT class_true AS c FROM parts WHERE NOT held_out GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
cell0 AS (SELECT policy_id, 0 AS cell FROM parts)"""


def _round_sql(i: int) -> str:
    """Rate every feature not yet chosen, pick the best, refine the cells by it."""
    taken = "".join(f" AND candidate <> (SELECT candidate FROM pick{j})" for j in range(1, i))
    return f"""
counts{i} AS (
  SELECT candidate, cell, bin, class_true,
         count(*) FILTER (WHERE NOT held_out) AS n_train, count(*) FILTER (WHERE held_out) AS n_test
  FROM binned JOIN cell{i - 1} USING (policy_id) WHERE true{taken} GROUP BY 1, 2, 3, 4),
ranked{i} AS (
  SELECT *, sum(n_train) OVER c AS cell_train,
         row_number() OVER (PARTITION BY candidate, cell, bin ORDER BY n_train DESC, class_true) AS place
  FROM counts{i} WINDOW c AS (PARTITION BY candidate, cell, bin)),
rated{i} AS (
  SELECT candidate, sum(CASE WHEN cell_train > 0 AND place = 1 THEN n_test
                             WHEN cell_train = 0 AND class_true = (SELECT c FROM overall) THEN n_test ELSE 0 END)::DOUBLE
                    / sum(n_test) AS accuracy FROM ranked{i} GROUP BY candidate),
pick{i} AS (SELECT * FROM rated{i} ORDER BY accuracy DESC, candidate DESC LIMIT 1),
cell{i} AS (
  SELECT policy_id, cell * {BINS + 1} + bin AS cell
  FROM cell{i - 1} JOIN binned USING (policy_id) WHERE candidate = (SELECT candidate FROM pick{i}))"""


def _selection_rows(spark, sf_dir) -> DataFrame:
    return random_split(filled(spark, sf_dir), 0.3, "policy_id", "42")


@query("candidate_scores", over(FILLED, SELECTION, _round_sql(1), select="SELECT candidate, round(accuracy, 6) AS accuracy FROM rated1"))
def candidate_scores(spark, sf_dir):
    binned = selection.bin_columns(_selection_rows(spark, sf_dir), FEATURES, BINS, ["class_true", "split"])
    return rounded(selection.cell_scores(binned, "class_true", "split", NAMES, BINS, [], FEATURES), 6, "accuracy")


@query("best_candidate", over(FILLED, SELECTION, _round_sql(1), select="SELECT candidate, round(accuracy, 6) AS accuracy FROM pick1"))
def best_candidate(spark, sf_dir):
    binned = selection.bin_columns(_selection_rows(spark, sf_dir), FEATURES, BINS, ["class_true", "split"])
    scores = selection.cell_scores(binned, "class_true", "split", NAMES, BINS, [], FEATURES)
    return rounded(selection.best_candidate(scores), 6, "accuracy")


def _picked(spark, picks) -> DataFrame:
    return spark.createDataFrame(picks, "round int, candidate string, accuracy double")


@query(
    "forward_selection",
    over(
        FILLED,
        SELECTION,
        *[_round_sql(i + 1) for i in range(len(FEATURES))],
        select=" UNION ALL ".join(f"SELECT {i + 1} AS round, candidate, round(accuracy, 6) AS accuracy FROM pick{i + 1}" for i in range(len(FEATURES))),
    ),
)
def forward_selection(spark, sf_dir):
    rows = _selection_rows(spark, sf_dir)
    picks = selection.select_by_cells(rows, FEATURES, "class_true", NAMES, "split", len(FEATURES), BINS)
    return rounded(_picked(spark, picks), 6, "accuracy")


def _tree_round_sql(i: int) -> str:
    """Grow a tree for every feature not yet chosen, over the chosen ones and itself; pick the best."""
    taken = "".join(f" AND f <> (SELECT tree FROM choice{j})" for j in range(1, i))
    chosen = "".join(f", (SELECT tree FROM choice{j})" for j in range(1, i))
    start = (
        "SELECT f AS tree, id, label, CAST(NOT held_out AS INTEGER) AS times FROM "
        f"(SELECT DISTINCT id, label, held_out FROM bins), (SELECT unnest(range({len(FEATURES)})) AS f) WHERE true{taken}"
    )
    return (
        grown(f"g{i}", start, 5, NAMES, allowed=f"AND f IN (n.tree{chosen})")
        + f""",
rated{i} AS MATERIALIZED (
  SELECT tree, avg(CAST(label = CASE WHEN n0 >= n1 AND n0 >= n2 THEN '{NAMES[0]}' WHEN n1 >= n2 THEN '{NAMES[1]}' ELSE '{NAMES[2]}' END AS DOUBLE)) AS accuracy
  FROM g{i}n5 JOIN g{i}nodes USING (tree, node) WHERE times = 0 GROUP BY tree),
choice{i} AS MATERIALIZED (
  SELECT tree, list_extract({FEATURES!r}, CAST(tree AS INTEGER) + 1) AS candidate, accuracy FROM rated{i}
  ORDER BY accuracy DESC, candidate DESC LIMIT 1)"""
    )


@query(
    "forward_selection_by_trees",
    over(
        FILLED,
        SELECTION.split("edges AS")[0].rstrip().rstrip(","),
        bin_tables(FEATURES, trees.BINS, "parts", "NOT held_out"),
        *[_tree_round_sql(i + 1) for i in range(len(FEATURES))],
        select=" UNION ALL ".join(f"SELECT {i + 1} AS round, candidate, round(accuracy, 6) AS accuracy FROM choice{i + 1}" for i in range(len(FEATURES))),
    ),
)
def forward_selection_by_trees(spark, sf_dir):
    rows = _selection_rows(spark, sf_dir)
    picks = selection.select_by_trees(rows, FEATURES, "class_true", NAMES, "split", len(FEATURES))
    return rounded(_picked(spark, picks), 6, "accuracy")


# Classifiers ----------------------------------------------------------------------------


@query(
    "class_weights",
    over(
        FILLED,
        select="""SELECT class_true, round(sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)), 6) AS weight
FROM scored GROUP BY class_true""",
    ),
)
def class_weights(spark, sf_dir):
    return rounded(class_weight_table(scored(spark, sf_dir), "class_true").drop("n"), 6, "weight")


def _split_by_class(spark, sf_dir) -> DataFrame:
    return stratified_split(stage_once(spark, ("spread", sf_dir), lambda: filled(spark, sf_dir), spread=True), 0.8, "class_true", "policy_id", "42", NAMES)


def _forest(spark, sf_dir):
    return _fitted(
        spark, sf_dir, "forest", lambda: fit_forest(_train(_split_by_class(spark, sf_dir)), FEATURES, "class_true", NAMES)
    )


def _train(df: DataFrame) -> DataFrame:
    return df.filter("split = 'train'")


_BY_CLASS = f"""
parts AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY class_true ORDER BY {hash_order("42")}) > floor(0.8::DOUBLE * count(*) OVER (PARTITION BY class_true)) AS held_out
  FROM filled),{bin_tables(FEATURES, trees.BINS, "parts", "NOT held_out")}"""
_ONE_TREE = grown("t", "SELECT DISTINCT 0 AS tree, id, label, CAST(NOT held_out AS INTEGER) AS times FROM bins", 5, NAMES)
_SMALL = {"trees": 3, "depth": 3, "seed": 7}
_WEIGHTS = ", ".join(
    f"count(*)::DOUBLE / (3 * sum(CASE WHEN class_true = '{c}' THEN 1 ELSE 0 END)) AS w{i}" for i, c in enumerate(NAMES)
)
_FEATURE_NAME = f"list_extract({FEATURES!r}, CAST(f AS INTEGER) + 1)"
_SMALL_FOREST = (
    f"balance AS MATERIALIZED (SELECT {_WEIGHTS} FROM parts WHERE NOT held_out),\n"
    + features_drawn(_SMALL["seed"], _SMALL["trees"], _SMALL["depth"], len(FEATURES), 2)
    + ",\n"
    + grown(
        "t", drawn(_SMALL["seed"], _SMALL["trees"]), _SMALL["depth"], NAMES, ["w0", "w1", "w2"],
        allowed="AND (n.tree, node, f) IN (SELECT (tree, node, f) FROM allowed)", weight_table=", balance",
    )
    + """,
leaves AS MATERIALIZED (
  SELECT id, avg(w0 * n0 / (w0 * n0 + w1 * n1 + w2 * n2)) AS p0, avg(w1 * n1 / (w0 * n0 + w1 * n1 + w2 * n2)) AS p1,
         avg(w2 * n2 / (w0 * n0 + w1 * n1 + w2 * n2)) AS p2
  FROM tn3 JOIN tnodes USING (tree, node), balance GROUP BY id)"""
)


def _small_forest(spark, sf_dir):
    def make():
        train = _train(_split_by_class(spark, sf_dir))
        weights = {r["class_true"]: r["weight"] for r in class_weight_table(train, "class_true").collect()}
        return trees.grow_forest(train, FEATURES, "class_true", NAMES, "policy_id", weights=weights, **_SMALL)

    return _fitted(spark, sf_dir, "small forest", make)


@query(
    "tree_predictions",
    over(
        FILLED,
        _BY_CLASS,
        _ONE_TREE,
        select=f"""SELECT id AS policy_id, CASE WHEN held_out THEN 'test' ELSE 'train' END AS split, n.label AS class_true,
       CASE WHEN n0 >= n1 AND n0 >= n2 THEN '{NAMES[0]}' WHEN n1 >= n2 THEN '{NAMES[1]}' ELSE '{NAMES[2]}' END AS class_pred
FROM tn5 AS n JOIN tnodes USING (tree, node) JOIN parts ON policy_id = id""",
    ),
)
def tree_predictions(spark, sf_dir):
    rows, model = _split_by_class(spark, sf_dir), _tree(spark, sf_dir)
    return model.transform(rows).select("policy_id", "split", "class_true", "class_pred")


def _tree(spark, sf_dir):
    return _fitted(
        spark, sf_dir, "tree", lambda: trees.grow_tree(_train(_split_by_class(spark, sf_dir)), FEATURES, "class_true", NAMES)
    )


_SPLIT_COLUMNS = f"tree, node, {_FEATURE_NAME} AS feature, round(edge, 6) AS cut, " + ", ".join(
    f"CAST(n{i} AS BIGINT) AS n_{c}" for i, c in enumerate(NAMES)
)


def _split_rows(model, spark):
    kept = [f"n_{c}" for c in model.classes]
    return rounded(model.table(spark.range(0)).select("tree", "node", "feature", F.round("cut", 6).alias("cut"), *kept, "gain"), 9, "gain")


@query(
    "tree_splits",
    over(
        FILLED,
        _BY_CLASS,
        _ONE_TREE,
        select=f"""SELECT {_SPLIT_COLUMNS}, round(gain, 9) AS gain
FROM tnodes LEFT JOIN tsplits USING (tree, node) LEFT JOIN edges USING (f) WHERE f IS NULL OR i = bin""",
    ),
)
def tree_splits(spark, sf_dir):
    """The fitted tree as a table: a row per node."""
    return _split_rows(_tree(spark, sf_dir), spark)


@query(
    "forest_splits",
    over(
        FILLED,
        _BY_CLASS,
        _SMALL_FOREST,
        select=f"""SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, {_SPLIT_COLUMNS.removeprefix("tree, node, ")}, round(gain, 9) AS gain
FROM tnodes LEFT JOIN tsplits USING (tree, node) LEFT JOIN edges USING (f) WHERE f IS NULL OR i = bin""",
    ),
)
def forest_splits(spark, sf_dir):
    """A small forest, bootstrapped and with drawn features, as a table."""
    return _split_rows(_small_forest(spark, sf_dir), spark)


@query(
    "grown_forest_predictions",
    over(
        FILLED,
        _BY_CLASS,
        _SMALL_FOREST,
        select="""SELECT id AS policy_id, round(p0, 9) AS p_down, round(p1, 9) AS p_keep, round(p2, 9) AS p_up FROM leaves""",
    ),
)
def grown_forest_predictions(spark, sf_dir):
    rows = _small_forest(spark, sf_dir).transform(_split_by_class(spark, sf_dir))
    return rounded(rows.select("policy_id", "p_down", "p_keep", "p_up"), 9, "p_down", "p_keep", "p_up")


@query(
    "grown_forest_importances",
    over(
        FILLED,
        _BY_CLASS,
        _SMALL_FOREST,
        select=f"""SELECT feature, round(coalesce(avg_share, 0) / sum(avg_share) OVER (), 9) AS importance
FROM (SELECT unnest({FEATURES!r}) AS feature) LEFT JOIN (
  SELECT {_FEATURE_NAME} AS feature, sum(share) AS avg_share FROM (
    SELECT f, own / sum(own) OVER (PARTITION BY tree) AS share FROM (
      SELECT tree, f, sum(gain * (w0 * all0 + w1 * all1 + w2 * all2)) AS own FROM tsplits, balance GROUP BY tree, f))
  GROUP BY f) USING (feature)""",
    ),
)
def grown_forest_importances(spark, sf_dir):
    rows = list(_small_forest(spark, sf_dir).importances().items())
    return rounded(spark.createDataFrame(rows, "feature string, importance double"), 9, "importance")


STUMP = """
sides AS (
  SELECT cut, pct_before > cut AS beyond, class_true, count(*)::DOUBLE AS n
  FROM filled, (SELECT DISTINCT pct_before AS cut FROM filled) GROUP BY 1, 2, 3),
impurity AS (
  SELECT cut, sum(total - squares / total) AS gini
  FROM (SELECT cut, beyond, sum(n) AS total, sum(n * n) AS squares FROM sides GROUP BY 1, 2) GROUP BY cut),
best AS (SELECT cut FROM impurity ORDER BY gini, cut LIMIT 1),
leaves AS (
  SELECT beyond, class_true AS class_pred FROM sides JOIN best USING (cut)
  QUALIFY row_number() OVER (PARTITION BY beyond ORDER BY n DESC, class_true) = 1)"""


@query(
    "tree_stump",
    over(
        FILLED,
        STUMP,
        select="""SELECT policy_id, l.class_pred FROM filled c, best JOIN leaves l ON true WHERE l.beyond = (c.pct_before > cut)""",
    ),
)
def tree_stump(spark, sf_dir):
    """A tree of one split on a column of few values, whose best Gini cut SQL can search."""
    rows = filled(spark, sf_dir)
    model = fit_tree(rows, ["pct_before"], "class_true", NAMES, depth=1)
    return model.transform(rows.select("policy_id", "pct_before")).select("policy_id", "class_pred")


@query("forest_predictions")
def forest_predictions(spark, sf_dir):
    rows, model = _split_by_class(spark, sf_dir), _forest(spark, sf_dir)
    return model.transform(rows).select("policy_id", "split", "class_true", "class_pred", "p_down", "p_keep", "p_up")


@query("forest_metrics")
def forest_metrics(spark, sf_dir):
    rows, model = _split_by_class(spark, sf_dir), _forest(spark, sf_dir)
    return cls.summary(model.transform(rows), "class_true", "class_pred", probabilities(), ("split",))


@query("forest_importances")
def forest_importances(spark, sf_dir):
    return _forest(spark, sf_dir).importance_table(filled(spark, sf_dir), 10)


@query("forest_grid")
def forest_grid_search(spark, sf_dir):
    """Three stratified folds of all training rows."""
    train = _train(_split_by_class(spark, sf_dir))
    folds = stage(stratified_folds(train, 3, "class_true", "policy_id", "43", NAMES), "grid", spread=True)
    rated = forest_grid(folds, FEATURES, "class_true", NAMES, "fold")
    return spark.createDataFrame(rated, "trees int, depth int, accuracy double")


@query("forest_grid_points")
def forest_grid_points(spark, sf_dir):
    """The same folds, rated at four settings of small forests."""
    train = _train(_split_by_class(spark, sf_dir))
    folds = stage(stratified_folds(train, 3, "class_true", "policy_id", "43", NAMES), "grid", spread=True)
    rated = forest_grid(folds, FEATURES, "class_true", NAMES, "fold", (5, 10), (3, 6))
    return spark.createDataFrame(rated, "trees int, depth int, accuracy double")


# Ridge ----------------------------------------------------------------------------------


def _ridge_rows(spark, sf_dir) -> DataFrame:
    return random_split(filled(spark, sf_dir), 0.2, "policy_id", "42")


@query(
    "ridge_closed_form",
    over(
        FILLED,
        """
s AS (
  SELECT count(*) * covar_pop(pct_before, pct_before) + 1 AS a, count(*) * covar_pop(pct_before, insured_before) AS b,
         count(*) * covar_pop(insured_before, insured_before) + 1 AS d, count(*) * covar_pop(pct_before, pct_after) AS u,
         count(*) * covar_pop(insured_before, pct_after) AS v, avg(pct_before) AS m1, avg(insured_before) AS m2, avg(pct_after) AS my
  FROM filled),
solved AS (SELECT (u * d - v * b) / (a * d - b * b) AS w1, (a * v - b * u) / (a * d - b * b) AS w2, m1, m2, my FROM s)""",
        select="""SELECT 'pct_before' AS term, round(w1, 6) AS weight FROM solved UNION ALL SELECT 'insured_before', round(w2, 6) FROM solved
UNION ALL SELECT 'intercept', round(my - w1 * m1 - w2 * m2, 6) FROM solved""",
    ),
)
def ridge_closed_form(spark, sf_dir):
    """Two features at alpha 1, where SQL can solve the normal equations."""
    rows = filled(spark, sf_dir)
    model = fit_ridge(rows, ["pct_before", "insured_before"], "pct_after", 1.0)
    terms = [*zip(model.features, model.weights), ("intercept", model.intercept)]
    return rounded(spark.createDataFrame(terms, "term string, weight double"), 6, "weight")


def _ridge_sql() -> str:
    """Normal equations of all features per (held-out fold, alpha), solved by elimination; the
    fit on all folds has f = 3. Folds are cut from the shuffled training rows."""
    n = range(len(FEATURES))
    entries = [f"count(*) * covar_pop({a}, {b})" + (" + alpha" if i == j else "") + f" AS a{i}{j}"
               for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if i <= j]
    right = [f"count(*) * covar_pop({a}, pct_after) AS b{i}, avg({a}) AS m{i}" for i, a in enumerate(FEATURES)]
    steps = []
    for k in n[:-1]:
        changed = [f"a{i}{j} - a{k}{i} * a{k}{j} / a{k}{k} AS a{i}{j}" for i in n for j in n if k < i <= j]
        changed += [f"b{i} - a{k}{i} * b{k} / a{k}{k} AS b{i}" for i in n if i > k]
        steps.append(f"\nstep{k + 1} AS (SELECT * REPLACE ({', '.join(changed)}) FROM step{k})")
    source = f"step{len(FEATURES) - 1}"
    for i in reversed(n):
        known = "".join(f" - a{i}{j} * w{j}" for j in n if j > i)
        steps.append(f"\nweight{i} AS (SELECT *, (b{i}{known}) / a{i}{i} AS w{i} FROM {source})")
        source = f"weight{i}"
    value = "my + " + " + ".join(f"w{i} * ({c} - m{i})" for i, c in enumerate(FEATURES))
    return f"""
parts AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY {hash_order("42")})
                      <= count(*) OVER () - ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM filled),
folded AS (SELECT *, ntile(3) OVER (ORDER BY {hash_order("43")}) - 1 AS fold FROM parts WHERE split = 'train'),
step0 AS (
  SELECT f, alpha, {", ".join([*entries, *right])}, avg(pct_after) AS my
  FROM folded JOIN (VALUES (0), (1), (2), (3)) AS t(f) ON fold <> f, (VALUES (0.1::DOUBLE), (1.0::DOUBLE), (10.0::DOUBLE)) AS s(alpha)
  GROUP BY f, alpha),{",".join(steps)},
rated AS (
  SELECT f, alpha, 1 - sum(pow(pct_after - ({value}), 2)) / (var_pop(pct_after) * count(*)) AS r2
  FROM folded JOIN {source} ON fold = f GROUP BY f, alpha),
grid AS (SELECT alpha, avg(r2) AS r2 FROM rated GROUP BY alpha),
best AS (SELECT w.* FROM {source} w JOIN (SELECT alpha FROM grid ORDER BY r2 DESC LIMIT 1) USING (alpha) WHERE f = 3),
predicted AS (
  SELECT policy_id, split, pct_after, CASE WHEN p < 0 THEN 0 ELSE p END AS reg_pred
  FROM (SELECT policy_id, split, pct_after, {value} AS p FROM parts, best))"""


RIDGE = _ridge_sql()


def _ridge(spark, sf_dir):
    def made():
        train = hash_folds(_train(_ridge_rows(spark, sf_dir)), 3, "policy_id", "43")
        return ridge_search(train, FEATURES, "pct_after", "fold")

    return _fitted(spark, sf_dir, "ridge", made)


@query(
    "ridge_grid",
    over(FILLED, RIDGE, select="SELECT alpha, round(r2, 8) AS r2, alpha = (SELECT alpha FROM best) AS best FROM grid"),
)
def ridge_grid(spark, sf_dir):
    search = _ridge(spark, sf_dir)
    rows = [(a, r2, a == search.model.alpha) for a, r2 in search.scores.items()]
    return rounded(spark.createDataFrame(rows, "alpha double, r2 double, best boolean"), 8, "r2")


@query(
    "ridge_grid_by_steps",
    over(FILLED, RIDGE, select="SELECT alpha, round(r2, 8) AS r2, alpha = (SELECT alpha FROM best) AS best FROM grid"),
)
def ridge_grid_by_steps(spark, sf_dir):
    """The same search by conjugate gradients over sparse rows."""
    train = hash_folds(_train(_ridge_rows(spark, sf_dir)), 3, "policy_id", "43")
    rows = stage(train.select("fold", "pct_after", sparse_row(FEATURES).alias("encoded")), "sparse")
    search = ridge_by_steps(rows, len(FEATURES), "pct_after", "fold")
    found = [(a, r2, a == search.model.alpha) for a, r2 in search.scores.items()]
    return rounded(spark.createDataFrame(found, "alpha double, r2 double, best boolean"), 8, "r2")


@query(
    "ridge_predictions",
    over(
        FILLED,
        RIDGE,
        select="""SELECT policy_id, split, round(pct_after, 6) AS pct_after, round(reg_pred, 6) AS reg_pred,
  round(pct_after - reg_pred, 6) AS residual FROM predicted""",
    ),
)
def ridge_predictions(spark, sf_dir):
    predicted = _ridge(spark, sf_dir).model.transform(_ridge_rows(spark, sf_dir))
    found = predicted.select(
        "policy_id", "split", "pct_after", "reg_pred", residual("pct_after", "reg_pred").alias("residual")
    )
    return rounded(found, 6, "pct_after", "reg_pred", "residual")


# Both models fused ----------------------------------------------------------------------


@query("fitted_kpis")
def fitted_kpis(spark, sf_dir):
    """Forest and ridge fitted on the same training rows, fused and rated on train, test and all rows."""
    rows, forest = _split_by_class(spark, sf_dir), _forest(spark, sf_dir)
    folds = hash_folds(_train(rows), 3, "policy_id", "43")
    ridge = ridge_search(folds, FEATURES, "pct_after", "fold").model
    predicted = ridge.transform(forest.transform(rows))
    return kpi_table(
        predicted, "pct_before", "pct_after", "reg_pred", "class_true", "class_pred", probabilities(), len(FEATURES)
    ).select("metric", "split", F.col("value"))


# The whole run -------------------------------------------------------------------------


RENEWAL_BOOK = BookSpec(
    key="policy_id",
    before="pct_before",
    after="pct_after",
    label="class_true",
    identifiers=("prior_policy_id", "party_id"),
    ratios={"ratio_premium": ("premium_after", "premium_before")},
    differences={"diff_insured": ("insured_after", "insured_before")},
    segment="premium_before",
    names=CLASSES,
)


def _whole_run(spark, sf_dir):
    def made():
        rows = labelled(renewals(spark, sf_dir), RENEWAL_BOOK)
        # The old and new value are no features, so their gaps are filled here.
        values = Imputer.fit(rows, [RENEWAL_BOOK.before, RENEWAL_BOOK.after], [])
        return run(values.transform(rows), RENEWAL_BOOK, trees=(20,))

    return _fitted(spark, sf_dir, "run", made)


@query("renewal_run")
def renewal_run(spark, sf_dir):
    """Impute, derive, reduce, encode, select, fit, score and fuse, over every renewal."""
    return _whole_run(spark, sf_dir).output.select(
        "policy_id", "split", "class_pred", "reg_pred", "fused_pred", "reg_direction", "fused_direction"
    )


@query("saved_run")
def saved_run(spark, sf_dir):
    """The run saved and loaded again, then applied to all renewals as a table of later rows."""
    folder = new_table_path(spark, "saved")
    Scorer.of(_whole_run(spark, sf_dir)).save(spark, folder)
    values = {c: F.col(c).cast("double") for c in (RENEWAL_BOOK.before, RENEWAL_BOOK.after)}
    later = renewals(spark, sf_dir).withColumns(values)
    return Scorer.load(spark, folder).transform(later).select(
        "policy_id", "class_pred", "reg_pred", "fused_pred", "reg_direction", "fused_direction"
    )
