"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremetrics.session import stored


def _towards_smallest(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()


def _among_smaller(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected(links: DataFrame, rounds: int = 100) -> DataFrame:
    """id, label for every linked node: the smallest id of its component.

    Alternates two star operations until the links no longer change, which takes
    a number of rounds that grows with the logarithm of the longest path. Each
    round is written and read again, which cuts it off; sums over a node combine before the
    shuffle, and no neighbourhood is ever gathered. Loops and repeated links do no harm.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    )
    before = None
    for _ in range(rounds):
        state = edges.agg(F.count("*"), F.sum("b"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).union(
                edges.select("b", "b").distinct()
            )
        before = state
        edges = stored(_among_smaller(_towards_smallest(edges)))
    raise RuntimeError("components did not settle")
