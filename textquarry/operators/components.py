"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.storage import forget, written


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Label each node of an undirected graph with its component's smallest node.

    Returns ``node, component`` for every node that occurs in an edge with two
    non-null ends (self-loops included).  Each round hangs a node's larger
    neighbours, then its smaller ones, on the smallest neighbour, until the
    edges are stars; the number of rounds grows with the logarithm of the
    number of nodes.  Ids may be numbers or strings.  A node with very many
    edges meets only partial aggregates and joins that adaptive execution can
    split; nothing is collected.  Every round's edges are written to the shared
    folder, so lineage stays short and a lost executor costs one stage.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
    nodes = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    now, before = nodes.where("a <> b"), None
    held = None
    while True:
        at = _state(now)
        if at == before or not at[0]:
            break
        before = at
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("m", "a").alias("m"))
        large = both.join(low, both.a == low.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(low, large.a == low.u).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        following = written(small.union(low.select("u", "m")).distinct(), "stars")
        if held is not None:
            forget(held)
        now = held = following
    members = nodes.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    stars = now.withColumnRenamed("a", "node")
    return members.join(stars, "node", "left").select("node", F.coalesce("b", "node").alias("component"))


def _state(edges: DataFrame) -> tuple:
    """The number of edges and two sums that change whenever the set changes."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.sum(h.bitwiseAND(F.lit((1 << 20) - 1)))).first())
