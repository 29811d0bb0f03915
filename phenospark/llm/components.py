"""Connected components by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """One row per node of ``edges`` (a, b: long): node, component, its smallest node.

    Each round points every node at its smallest neighbour, follows the pointers to their
    ends by doubling, and moves the edges there.  The smallest node of a component never
    moves, so it is what the component ends as.  A round at least halves the nodes that still
    have edges.  The minimum reduces map-side, both sides of each join are stored tables,
    which lets Spark split a hot node, and stored tables cut the lineage.
    """
    left = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = _ends(stored(
            both.groupBy("a").agg(F.min("b").alias("least")).select(
                F.col("a").alias("node"), F.least("a", "least").alias("component")
            ), "moves",
        ))
        moved = moves if labels is None else labels.join(
            moves.select(F.col("node").alias("component"), F.col("component").alias("next")),
            "component", "left",
        ).select("node", F.coalesce("next", "component").alias("component"))
        labels = stored(moved, "labels")
        ends = left
        for end in ("a", "b"):
            ends = ends.join(moves.select(F.col("node").alias(end), F.col("component").alias("c")), end).select(
                *[F.col("c").alias(end) if x == end else F.col(x) for x in ("a", "b")]
            )
        smaller = ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        left = stored(smaller.distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _ends(moves: DataFrame) -> DataFrame:
    """Pointers (node, component) replaced by where they lead in the end."""
    while True:
        second = moves.select(F.col("node").alias("component"), F.col("component").alias("next"))
        jumped = stored(moves.join(second, "component"), "moves")
        if jumped.where("next <> component").isEmpty():
            return moves
        moves = jumped.select("node", F.col("next").alias("component"))
