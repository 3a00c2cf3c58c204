"""Connected components of a link table, by Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the component's smallest node.

    Large stars and small stars alternate until nothing changes: each node's larger, then
    its smaller neighbours are hung onto the smallest one known. Each round is two
    aggregations with map-side combining and joins that adaptive execution splits at hot
    nodes; its result is written to the shared folder.
    """
    edges = stored(_oriented(links.select("a", "b")), "links")
    state = _state(edges)
    for _ in range(max_rounds):
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller; no loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.shiftright(F.xxhash64("a", "b"), 24)), F.sum(F.shiftright(F.xxhash64("b", "a"), 24))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _oriented(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(hung.unionAll(least.select("a", F.col("m").alias("b"))))
