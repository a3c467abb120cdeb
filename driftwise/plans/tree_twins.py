"""SQL that grows the trees of ``operators.trees`` level by level, to check them in another engine.

``bins`` has (id, label, held_out, f, bin) for every row and feature, ``edges`` (f, i, edge); a
set of trees starts from rows (tree, id, label, times).
"""

from __future__ import annotations

from collections.abc import Sequence

from driftwise.plans.twins import uniform

COPIES = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253]


def bin_tables(features: Sequence[str], bins: int, source: str, train: str) -> str:
    """CTEs ``quantiles`` over the training rows, ``edges`` and ``bins``."""
    inner = ", ".join(f"quantile_cont({c}, {i / bins}) AS e_{c}_{i}" for c in features for i in range(1, bins))
    edges = " UNION ALL ".join(
        f"SELECT {f} AS f, {i - 1} AS i, e_{c}_{i} AS edge FROM quantiles" for f, c in enumerate(features) for i in range(1, bins)
    )
    rows = " UNION ALL ".join(
        f"SELECT policy_id AS id, class_true AS label, held_out, {f} AS f, "
        + " + ".join(f"CAST({c} > e_{c}_{i} AS INTEGER)" for i in range(1, bins))
        + f" AS bin FROM {source}, quantiles"
        for f, c in enumerate(features)
    )
    return f"""
quantiles AS MATERIALIZED (SELECT {inner} FROM {source} WHERE {train}),
edges AS MATERIALIZED ({edges}),
bins AS MATERIALIZED ({rows})"""


def _shares(weights: Sequence[str], counts: Sequence[str]) -> tuple[str, str]:
    weighted = [f"({w} * {n})" for w, n in zip(weights, counts)]
    total = " + ".join(weighted)
    return f"({total})", f"(({' + '.join(f'{x} * {x}' for x in weighted)}) / ({total}))"


def grown(
    name: str, start: str, depth: int, classes: Sequence[str], weights: Sequence[str] | None = None, allowed: str = "", weight_table: str = ""
) -> str:
    """CTEs of a set of trees: splits ``{name}s{level}``, places ``{name}n{depth}`` (the leaf of
    every row in every tree) and ``{name}nodes`` (counts of all nodes)."""
    weights = weights or ["1.0::DOUBLE"] * len(classes)
    k = range(len(classes))
    low, every = [f"low{c}" for c in k], [f"all{c}" for c in k]
    high = [f"({e} - {x})" for e, x in zip(every, low)]
    (total, whole), (_, left), (_, right) = _shares(weights, every), _shares(weights, low), _shares(weights, high)
    out = [f"{name}n0 AS MATERIALIZED (SELECT tree, id, label, times, 0 AS node FROM ({start}))"]
    for step in range(depth):
        counts = ", ".join(f"sum(CASE WHEN n.label = '{c}' THEN times ELSE 0 END) AS n{i}" for i, c in enumerate(classes))
        running = ", ".join(f"sum(n{c}) OVER (PARTITION BY tree, node, f ORDER BY bin) AS low{c}, sum(n{c}) OVER (PARTITION BY tree, node, f) AS all{c}" for c in k)
        out.append(
            f"""{name}s{step} AS MATERIALIZED (
  SELECT tree, node, f, bin, gain, {", ".join(low + every)} FROM (
    SELECT *, ({left} + {right} - {whole}) / {total} AS gain FROM (
      SELECT tree, node, f, bin, {running} FROM (
        SELECT tree, node, f, bin, {counts} FROM {name}n{step} AS n JOIN bins USING (id)
        WHERE times > 0 AND node >= {(1 << step) - 1} {allowed} GROUP BY tree, node, f, bin)){weight_table}
    WHERE {" + ".join(low)} < {" + ".join(every)})
  WHERE gain > 1e-7 QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f, bin) = 1)"""
        )
        out.append(
            f"""{name}n{step + 1} AS MATERIALIZED (
  SELECT n.tree, n.id, n.label, n.times,
         CASE WHEN s.f IS NULL THEN n.node ELSE 2 * n.node + 1 + CAST(b.bin > s.bin AS INTEGER) END AS node
  FROM {name}n{step} AS n LEFT JOIN {name}s{step} AS s ON s.tree = n.tree AND s.node = n.node
       LEFT JOIN bins AS b ON b.id = n.id AND b.f = s.f)"""
        )
    roots = ", ".join(f"sum(CASE WHEN label = '{c}' THEN times ELSE 0 END) AS n{i}" for i, c in enumerate(classes))
    children = " UNION ALL ".join(
        f"SELECT tree, 2 * node + 1, {', '.join(low)} FROM {name}s{s} UNION ALL SELECT tree, 2 * node + 2, {', '.join(high)} FROM {name}s{s}"
        for s in range(depth)
    )
    out.append(f"{name}nodes AS MATERIALIZED (SELECT tree, 0 AS node, {roots} FROM {name}n0 GROUP BY tree UNION ALL {children})")
    out.append(f"{name}splits AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM {name}s{s}' for s in range(depth))})")
    return ",\n".join(out)


def drawn(seed: int, trees: int, rows: str = "(SELECT DISTINCT id, label, held_out FROM bins)") -> str:
    """Rows of all trees with their bootstrap copies; held-out rows are placed but not counted."""
    chance = uniform(f"{seed}:' || tree || '", "id")
    times = " + ".join(f"CAST(u >= {b!r}::DOUBLE AS INTEGER)" for b in COPIES)
    return (
        f"SELECT tree, id, label, CASE WHEN held_out THEN 0 ELSE {times} END AS times "
        f"FROM (SELECT *, {chance} AS u FROM {rows}, (SELECT unnest(range({trees})) AS tree))"
    )


def features_drawn(seed: int, trees: int, depth: int, features: int, most: int) -> str:
    """CTE ``allowed`` (tree, node, f)."""
    return f"""allowed AS MATERIALIZED (
  SELECT tree, node, f FROM (SELECT unnest(range({trees})) AS tree), (SELECT unnest(range({(1 << depth) - 1})) AS node),
         (SELECT unnest(range({features})) AS f)
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY md5(concat('{seed}:', tree, ':', node, ':', f))) <= {most})"""
