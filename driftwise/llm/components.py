"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation with map-side combine and an equi-join; the edges of each
round are written to the shared folder, so no plan grows with the rounds. The rounds end
when the edges no longer change; then every edge points from a node to the smallest node
of its component. No component is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwise.session import stage


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()
    return row.n, int(row.h)


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. Edges point down."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between comparable nodes -> (node, root) of every node that has a link."""
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = stage(_small_star(_large_star(edges)), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.union(roots)


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after further links (a, b) between nodes, which may be new; written once.
    Only the components that the links connect are worked on."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    heads = components(ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    moved = heads.select(F.col("node").alias("root"), F.col("root").alias("head"))
    old = roots.join(moved, "root", "left").select("node", F.coalesce("head", "root").alias("root"))
    return stage(old.union(heads.join(roots, "node", "left_anti")), "roots")
