"""Connected components of a link table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinlog.llm.common import cut


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on the node's least neighbour (or itself)."""
    both = edges.union(edges.select("v", "u"))
    least = _least_neighbour(both).withColumn("least", F.least("node", "least"))
    return both.where("v > u").join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the least of them; u > v in every row."""
    least = _least_neighbour(edges)
    moved = edges.join(least, F.col("u") == F.col("node")).where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select(F.col("node").alias("u"), F.col("least").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (a, b), long and not null, to rows (node, component): the least node reachable, for every node with a link
    to another one. Repeated links, links to itself and both directions are allowed.

    Every round is written to the shared folder, so the plan stays short and no round runs twice. Rounds end when one
    changes nothing, which takes about the logarithm of the longest chain.
    """
    edges = cut(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    )
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        seen = state
        edges = cut(_small_star(_large_star(edges)))
