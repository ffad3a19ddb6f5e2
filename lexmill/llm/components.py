"""Connected components of a graph given as pairs of 64-bit numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import materialize


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(v, label) for every number in `edges` (a, b): the smallest number reachable from v.

    Each round points every vertex at the smallest one within two edges, follows the pointers to their
    ends and then joins what points at one vertex into it. Edges inside a joined vertex are dropped and
    parallel ones merged, so a round is left with half the vertices at most and only the edges between
    them. A hub costs one row per edge: the minimum is combined before its shuffle, and both sides of
    the joins are plain tables, so adaptive execution can split a hub.
    """
    edges = materialize(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = materialize(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("m")), "near")
        offers = both.join(near.select(F.col("v").alias("b"), "m"), "b").groupBy(F.col("a").alias("v")).agg(F.min("m").alias("offer"))
        ends = pointer_ends(near.join(offers, "v").select("v", F.least("m", "offer").alias("label")))
        if labels is None:
            labels = ends
        else:
            moved = ends.select(F.col("v").alias("label"), F.col("label").alias("end"))
            labels = materialize(labels.join(moved, "label", "left").select("v", F.coalesce("end", "label").alias("label")), "labels")
        edges = materialize(between(edges, ends).distinct(), "edges")
        if edges.isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def pointer_ends(pointers: DataFrame) -> DataFrame:
    """(v, label): where the pointers (v, label) end that start at v; each points at itself or at a smaller number."""
    pointers = materialize(pointers, "labels")
    while True:
        far = pointers.select(F.col("v").alias("label"), F.col("label").alias("far"))
        moved = pointers.join(far, "label").select("v", F.col("far").alias("label"), F.col("label").alias("was"))
        moved = materialize(moved, "labels")
        settled = moved.where("label != was").isEmpty()
        pointers = moved.select("v", "label")
        if settled:
            return pointers


def between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) as pairs of labels, the smaller one first; those within one component are left out."""
    found = pairs.join(labels.select(F.col("v").alias("a"), F.col("label").alias("x")), "a", "left")
    found = found.join(labels.select(F.col("v").alias("b"), F.col("label").alias("y")), "b", "left")
    found = found.select(F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y")).where("x != y")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def joined_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The components (v, label) after joining them by further `edges` (a, b); only edges between them are worked on."""
    more = connected_components(between(edges, labels))
    moved = more.select(F.col("v").alias("label"), F.col("label").alias("end"))
    old = labels.join(moved, "label", "left").select("v", F.coalesce("end", "label").alias("label"))
    return materialize(old.unionByName(more.join(labels, "v", "left_anti")), "labels")
