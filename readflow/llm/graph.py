"""Connected components of large edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from readflow.session import materialize

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge to another; ``root`` is the smallest node of its component.

    ``edges`` has two bigint columns, ``a`` and ``b``; order, repeats and loops do not matter. Each
    round hangs every larger neighbour of a node on the node's smallest neighbour, then every node
    and its smaller neighbours on the smallest of those; paths shrink by a constant factor per
    round until all edges end at a root. Minima are taken per task before they are shuffled, and a
    node with very many neighbours only meets them in a join that Spark can split.
    """
    now = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialize(now, "edges")
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.filter(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = hung.groupBy("u").agg(F.min("v").alias("m"))
        pairs = hung.join(lowest, "u")
        moved = pairs.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number and hash sum of the edges: equal only if the edges are."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
