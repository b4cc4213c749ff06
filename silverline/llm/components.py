"""Connected components by alternating star contractions.

A large star links every larger neighbour of a node to the smallest node it sees; a small
star does so for the smaller ones. Both only ever join a table of minima to the edges, so no
node's edges are gathered anywhere, and a hub's edges are split by adaptive execution. The
edges shrink to one star per component in a logarithmic number of rounds. Each round is
checkpointed, and only its row count and checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from silverline.sources.shared import durable


def _state(edges: DataFrame) -> tuple[int, int]:
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(mark).alias("sum")).first()
    return row["n"], row["sum"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(smallest, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger node to the smaller one."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    pulled = edges.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"),
                                                               F.col("m").alias("b"))
    own = smallest.select("a", F.col("m").alias("b"))
    return pulled.union(own).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): every linked node but the components' smallest, and that smallest."""
    edges = (links.filter("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = durable(edges)
    state = _state(edges)
    while True:
        edges = durable(_small_star(_large_star(edges)))
        last, state = state, _state(edges)
        if state == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
