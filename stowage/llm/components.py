"""Connected components of a graph in a table, by alternating large-star and small-star steps.

Each step replaces a node's edges by edges to the smallest node it knows of: grouped minima and a join. The edge
table is written to the shared folder after each round, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.session import share


def _smallest(edges: DataFrame, of: str, other: str) -> DataFrame:
    """(of, least): the smaller of a node and its smallest neighbour; grouped on a hash too, so that the join
    that follows has exchanges of its own and AQE can split a node with very many edges."""
    return (
        edges.groupBy(F.xxhash64(of).alias("_h"), of).agg(F.least(F.min(other), F.first(of)).alias("least")).drop("_h")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        both.join(_smallest(both, "a", "b"), "a")
        .filter("b > a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a > b, so a node's smaller neighbours are its b."""
    least = _smallest(edges, "a", "b")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b")).filter("a <> b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, which has none itself: then these are the components."""
    several = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
    deeper = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    return several.isEmpty() and deeper.isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for each node on an edge, the smallest node it can reach. Edges may repeat and be loops."""
    now = share(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "edges"
    )
    while not _are_stars(now):
        now = share(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return share(now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots), "components")
