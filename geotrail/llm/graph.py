"""Connected components of an edge table by alternating star contraction.

Large-star and small-star rounds (both are a minimum per node joined back on
the node) shrink every component to a star around its smallest node in a
logarithmic number of rounds. Each round is written to the shared folder, so
lineage stays short; the minimum combines map-side and the join side with the
many rows is split by adaptive execution, so a node with very many edges
never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrail.llm.common import materialize

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with a > b."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = near.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return out.where("a > b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs, any order, repeats allowed -> ``node, root`` (root: the smallest node reachable).

    Nodes without an edge don't appear. An empty edge table gives no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = materialize(edges, "cc-edges")
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        edges = materialize(_star(_star(edges, True), False), "cc-round")
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
