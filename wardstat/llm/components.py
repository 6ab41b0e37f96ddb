"""Connected components by alternating large and small stars, in DataFrame operations.

Each round is written to the shared folder, so lineage stays one round long. Minimums are aggregated before
the shuffle and stored before they are joined: a join of two plain shuffles is one that the adaptive planner can
split, and so a node that holds much of the table is no single task. A round is four short queries; what tells whether
it was the last is part of the first one's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.llm.common import stored
from wardstat.session import discard


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(edges: DataFrame) -> DataFrame:
    """(a, m, open): the least of each node and its neighbours, and whether the node keeps the edges from being stars: it
    hangs on two others, or hangs on one while a third hangs on it."""
    above = F.max(F.when(F.col("b") < F.col("a"), F.col("b")))
    found = _both(edges).groupBy("a").agg(F.min("b").alias("m"), above.alias("above"), F.max("b").alias("most"))
    hangs = F.col("above").isNotNull() & ((F.col("above") != F.col("m")) | (F.col("most") > F.col("a")))
    return found.select("a", F.least("a", "m").alias("m"), hangs.alias("open"))


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """An edge for each one of ``edges``."""
    found = _both(edges).where("b > a").join(least.select("a", "m"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stored(found, "edges")


def _small_star(edges: DataFrame) -> DataFrame:
    """At most as many edges as ``edges`` has; of repeated ones those to the least neighbour become one."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    found = stored(moved.union(least.select("a", F.col("m").alias("b"))), "edges")
    discard(least)
    return found


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node. Self-links and
    repeated links don't matter; no link at all gives an empty table."""
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = stored(edges, "edges")
    least = stored(_least(edges), "least")
    while not least.where("open").isEmpty():
        large = _large_star(edges, least)
        discard(edges, least)
        edges = _small_star(large)
        discard(large)
        least = stored(_least(edges), "least")
    discard(edges)
    # Of stars the least of a node and its neighbours is the smallest node of all.
    return least.select(F.col("a").alias("node"), F.col("m").alias("component"))


def with_links(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``parts`` (node, component), stored, after more links (a, b): as ``connected_components`` of all links.
    Only the components that they join are gone through, each as one node."""
    for side in "ab":
        part = parts.select(F.col("node").alias(side), F.col("component").alias(f"part_{side}"))
        links = links.join(part, side, "left").withColumn(f"part_{side}", F.coalesce(f"part_{side}", side))
    joined = stored(connected_components(links, "part_a", "part_b"), "joined")
    moved = parts.join(joined.select(F.col("node").alias("component"), F.col("component").alias("into")), "component", "left")
    found = moved.select("node", F.coalesce("into", "component").alias("component")).union(joined).distinct()
    found = stored(found, "parts")
    discard(joined)
    return found
