"""Connected components of a link table by alternating large and small stars, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardframe.llm.common import Stages


def components(edges: DataFrame, stages: Stages, name: str, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node that has a link; ``root`` is the smallest node it reaches.

    ``edges`` has two long columns ``a`` and ``b``; either order, repeats and loops are fine. Each
    round is two joins on the node, both with one row per key on one side, so a hub with many links
    is split by Spark's skew handling. The table never grows past the number of links. Rounds follow
    the logarithm of the longest chain; ``most_rounds`` is a guard that raises, never a cut-off.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stages.write(now, f"{name}-0")
    mark = _mark(now)
    for k in range(1, most_rounds + 1):
        now = stages.write(_small_star(_large_star(now)), f"{name}-{k}")
        stages.drop(f"{name}-{k - 1}")
        was, mark = mark, _mark(now)
        if was == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the node's smallest neighbour (or to the node)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return (
        moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )
