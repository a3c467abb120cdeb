"""Impute, scale, reduce, encode."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwise.operators.classification import one_vs_rest
from driftwise.operators.sparse import LevelIndex, components_by_steps, sparse_row
from driftwise.operators.prep import Imputer, OneHot, PrincipalComponents, Standardizer, code_label, label_code
from driftwise.plans import twins
from driftwise.plans.bindings import CLASSES, probabilities, renewals, scored, table
from driftwise.plans.catalog import query
from driftwise.plans.fusion_queries import rounded
from driftwise.plans.twins import FILLED, LONG, RENEWALS, SCORED, over
from driftwise.session import stage, stage_once

FEATURES = ["pct_before", "premium_before", "premium_after", "insured_before", "insured_after", "score"]
GAPPY = list(twins.GAPPY)


@query(
    "median_impute",
    over(
        RENEWALS,
        "\nm AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in GAPPY) + " FROM renewals)",
        select="SELECT policy_id, " + ", ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}" for c in GAPPY) + " FROM renewals, m",
    ),
)
def median_impute(spark, sf_dir):
    df = stage(renewals(spark, sf_dir).select("policy_id", *GAPPY), "imputed")
    return rounded(Imputer.fit(df, GAPPY, []).transform(df), 6, *GAPPY)


# Orders without lines leave status and band missing here.
_GAPPY_TEXT = "CASE WHEN pct_after IS NULL THEN NULL ELSE {c} END AS {c}"


@query(
    "mode_impute",
    over(
        RENEWALS,
        f"\ng AS (SELECT policy_id, {_GAPPY_TEXT.format(c='status')}, {_GAPPY_TEXT.format(c='band')} FROM renewals)",
        select="SELECT policy_id, "
        + ", ".join(
            f"coalesce({c}, (SELECT {c} FROM g WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
            for c in ("status", "band")
        )
        + " FROM g",
    ),
)
def mode_impute(spark, sf_dir):
    known = F.col("pct_after").isNotNull()
    text = [F.when(known, F.col(c)).alias(c) for c in ("status", "band")]
    df = stage(renewals(spark, sf_dir).select("policy_id", *text), "imputed")
    return Imputer.fit(df, [], ["status", "band"]).transform(df)


@query(
    "standardize",
    over(
        RENEWALS,
        "\nm AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES) + " FROM renewals)",
        select="SELECT policy_id, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 5) AS {c}" for c in FEATURES) + " FROM renewals, m",
    ),
)
def standardize(spark, sf_dir):
    df = stage(renewals(spark, sf_dir).select("policy_id", *FEATURES), "scaled")
    return rounded(Standardizer.fit(df, FEATURES).transform(df), 5, *FEATURES)


def filled(spark, sf_dir):
    """Every renewal with its label and gaps filled by medians, written once per session."""

    def made():
        rows = stage(scored(spark, sf_dir).select("policy_id", "class_true", "pct_after", *FEATURES), "labelled")
        return Imputer.fit(rows, GAPPY, []).transform(rows)

    return stage_once(spark, ("filled", sf_dir), made)


def _vector(of: str, matrix: str, squarings: int = 24) -> str:
    """Leading eigenvector of the matrix in CTE ``matrix``: squared again and again and scaled by
    its trace, the matrix tends to the projection on it, even if the next one is close."""
    n = range(len(FEATURES))

    def c(i: int, j: int) -> str:
        return f"c{min(i, j)}{max(i, j)}"

    trace = " + ".join(c(i, i) for i in n)
    square = ", ".join(
        "(" + " + ".join(f"{c(i, k)} * {c(k, j)}" for k in n) + f") / (t * t) AS c{i}{j}" for i in n for j in n if i <= j
    )
    steps = [f"\n{of}_0 AS (SELECT * FROM {matrix})"] + [
        f"\n{of}_{s} AS (SELECT {square} FROM (SELECT *, {trace} AS t FROM {of}_{s - 1}))" for s in range(1, squarings + 1)
    ]
    image = ", ".join("(" + " + ".join(f"{c(i, j)} * {1 / (j + 1)!r}::DOUBLE" for j in n) + f") AS w{i}" for i in n)
    size = "sqrt(" + " + ".join(f"w{i} * w{i}" for i in n) + ")"
    value = " + ".join(f"v{i} * {c(i, j)} * v{j}" for i in n for j in n)
    largest = "greatest(" + ", ".join(f"abs(v{i})" for i in n) + ")"
    sign = "CASE " + " ".join(f"WHEN abs(v{i}) = {largest} THEN sign(v{i})" for i in n) + " END"
    return ",".join(steps) + f""",
{of}_v AS (SELECT {", ".join(f"w{i} / {size} AS v{i}" for i in n)} FROM (SELECT {image} FROM {of}_{squarings})),
{of} AS (SELECT {", ".join(f"v{i} * {sign} AS v{i}" for i in n)}, {value} AS size FROM {of}_v, {matrix})"""


_PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
PCA = (
    "\nmoments AS (SELECT "
    + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(FEATURES))
    + " FROM filled),\nc1 AS (SELECT "
    + ", ".join(f"corr({FEATURES[i]}, {FEATURES[j]}) AS c{i}{j}" for i, j in _PAIRS)
    + " FROM filled),"
    + _vector("first", "c1")
    + ",\nc2 AS (SELECT "
    + ", ".join(f"c{i}{j} - size * v{i} * v{j} AS c{i}{j}" for i, j in _PAIRS)
    + " FROM c1, first),"
    + _vector("second", "c2")
)


def _scores_sql(of: str) -> str:
    return "round(" + " + ".join(f"{of}.v{i} * ({c} - m{i}) / s{i}" for i, c in enumerate(FEATURES)) + ", 4)"


@query(
    "pca_components",
    over(
        FILLED,
        PCA,
        select=f"""SELECT policy_id, {_scores_sql("first")} AS pca_comp1, {_scores_sql("second")} AS pca_comp2
FROM filled, moments, first, second""",
    ),
)
def pca_components(spark, sf_dir):
    df = filled(spark, sf_dir)
    found = PrincipalComponents.fit(df, FEATURES, 2).transform(df).select("policy_id", "pca_comp1", "pca_comp2")
    return rounded(found, 4, "pca_comp1", "pca_comp2")


@query(
    "pca_by_steps",
    over(
        FILLED,
        PCA,
        select=f"""SELECT policy_id, {_scores_sql("first")} AS pca_comp1, {_scores_sql("second")} AS pca_comp2
FROM filled, moments, first, second""",
    ),
)
def pca_by_steps(spark, sf_dir):
    rows = stage(filled(spark, sf_dir).select("policy_id", sparse_row(FEATURES).alias("encoded")), "sparse")
    found = components_by_steps(rows, len(FEATURES), 2).transform(rows, "policy_id")
    return rounded(found, 4, "pca_comp1", "pca_comp2")


@query(
    "pca_variance",
    over(
        FILLED,
        PCA,
        select=f"""SELECT 1 AS component, round(size / {len(FEATURES)}, 6) AS explained FROM first
UNION ALL SELECT 2, round(size / {len(FEATURES)}, 6) FROM second""",
    ),
)
def pca_variance(spark, sf_dir):
    shares = PrincipalComponents.fit(filled(spark, sf_dir), FEATURES, 2).explained
    rows = spark.createDataFrame([(i + 1, v) for i, v in enumerate(shares)], "component int, explained double")
    return rounded(rows, 6, "explained")


_LEVELS = {
    "band": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "status": ["F", "O", "P"],
    "maker": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}


@query(
    "one_hot",
    over(
        RENEWALS,
        select="SELECT policy_id, "
        + ", ".join(f"({c} = '{v}') AS \"{c}_{v}\"" for c, vs in _LEVELS.items() for v in vs[1:])
        + " FROM renewals",
    ),
)
def one_hot(spark, sf_dir):
    df = stage(renewals(spark, sf_dir).select("policy_id", *_LEVELS), "encoded")
    return OneHot.fit(df, list(_LEVELS)).transform(df)


_CODED = ("l_partkey", "l_suppkey", "l_returnflag")


@query(
    "one_hot_sparse",
    "WITH given AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS v FROM lineitem" for c in _CODED)
    + """),
levels AS (SELECT DISTINCT c, v FROM given WHERE v IS NOT NULL),
others AS (SELECT c, v, concat(c, '=', v) AS name FROM levels WHERE v <> (SELECT min(v) FROM levels l WHERE l.c = levels.c)),
places AS (SELECT c, v, row_number() OVER (ORDER BY """
    + twins.hash_order("levels", "name")
    + """) - 1 AS place FROM others)
SELECT l_orderkey, l_linenumber, coalesce(array_to_string(list_sort([p0.place, p1.place, p2.place]), ','), '') AS places
FROM lineitem"""
    + "".join(f" LEFT JOIN places p{i} ON p{i}.c = '{c}' AND p{i}.v = CAST({c} AS VARCHAR)" for i, c in enumerate(_CODED)),
)
def one_hot_sparse(spark, sf_dir):
    """Parts, suppliers and flags of every line as places of one sparse row."""
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_CODED)
    found = LevelIndex.fit(df, list(_CODED)).transform(df)
    return found.select("l_orderkey", "l_linenumber", F.array_join("encoded.indices", ",").alias("places"))


@query(
    "label_codes",
    over(
        SCORED,
        select="""SELECT policy_id, CASE class_true WHEN 'down' THEN 0 WHEN 'keep' THEN 1 ELSE 2 END AS code, class_true AS decoded
FROM scored""",
    ),
)
def label_codes(spark, sf_dir):
    coded = scored(spark, sf_dir).select("policy_id", label_code("class_true", CLASSES.names()).alias("code"))
    return coded.withColumn("decoded", code_label("code", CLASSES.names()))


@query("one_vs_rest", over(SCORED, LONG, select="SELECT policy_id, class, is_positive, round(score, 6) AS score FROM ovr"))
def indicators(spark, sf_dir):
    return rounded(one_vs_rest(scored(spark, sf_dir), "class_true", probabilities(), ("policy_id",)), 6, "score")
