"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for the nodes of ``edges`` (a, b: long).

    Each round every node points to its smallest neighbour if that is smaller, pointers are
    followed twice further, and the edges are rewritten between what they point to. Trees of
    pointers collapse to their roots, so the edges shrink by a factor each round. Only
    minima by node are gathered, no neighbour lists; each round is written to the shared
    folder and read again, so a lost executor costs one round at most. Loops, repeated and
    reversed edges change nothing; null ends are left out.
    """
    found = None
    rest = materialise(_oriented(edges.select("a", "b")), "edges")
    while not rest.isEmpty():
        ends = rest.select(F.col("a").alias("node"), F.col("b").alias("other"))
        both = ends.unionByName(rest.select(F.col("b").alias("node"), F.col("a").alias("other")))
        nearest = both.groupBy("node").agg(F.min("other").alias("to"))
        points = materialise(nearest.select("node", F.least("node", "to").alias("to")), "points")
        for _ in range(2):
            onward = points.select(F.col("node").alias("to"), F.col("to").alias("onward"))
            points = points.join(onward, "to").select("node", F.col("onward").alias("to"))
        points = materialise(points, "points")
        first = points.select(F.col("node").alias("a"), F.col("to").alias("x"))
        second = points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = rest.join(first, "a").join(second, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        rest = materialise(_oriented(moved), "edges")
        if found is None:
            found = points.select("node", F.col("to").alias("component"))
        else:
            step = points.select(F.col("node").alias("component"), "to")
            found = found.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        found = materialise(found, "components")
    return rest.select(F.col("a").alias("node"), F.col("b").alias("component")) if found is None else found


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, the smaller end first, without loops."""
    return edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
