"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import BROADCAST_ROWS, materialize, partitions

#: Edges that a task takes where they are few, and tasks at least.
EDGES_OF_TASK, LEAST_TASKS = 20_000, 4


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _least_of_neighbours(edges: DataFrame, few: bool) -> DataFrame:
    """Edges (a, b, least): the least neighbour of ``a`` beside each of them.

    Minima of few edges are broadcast to them.  Of many they are taken by node and salt
    first and go back to the edges by node and salt, so the edges of a hub are never one
    group.
    """
    if few:
        return edges.join(F.broadcast(edges.groupBy("a").agg(F.min("b").alias("least"))), "a").select("a", "b", "least")
    salts = partitions(edges.sparkSession)
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int"))
    partial = salted.groupBy("a", "salt").agg(F.min("b").alias("low"))
    least = partial.groupBy("a").agg(F.min("low").alias("least"))
    return salted.join(partial.join(least, "a").select("a", "salt", "least"), ["a", "salt"]).select("a", "b", "least")


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _least_of_neighbours(both, few).where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    joined = _least_of_neighbours(edges, few)
    tied = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return tied.where("a > b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long edges -> (node, component), component the least node reachable.

    Only nodes with an edge to another node are returned.  Each round is joins on
    pre-aggregated minima and is written to the checkpoint folder; the number of
    rounds is logarithmic in the size of the largest component.  Every shuffle leaves files
    of each task, whatever its rows, so rounds over few edges shuffle as little as they can.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    pairs = materialize(pairs)
    mark = _fingerprint(pairs)
    while True:
        few = 2 * mark[0] <= BROADCAST_ROWS  # nodes of either star at most
        tasks = max(LEAST_TASKS, mark[0] // EDGES_OF_TASK) if few else partitions(pairs.sparkSession)
        pairs = materialize(_small_star(_large_star(pairs, few).coalesce(tasks), few).coalesce(tasks))
        if (now := _fingerprint(pairs)) == mark:
            break
        mark = now
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
