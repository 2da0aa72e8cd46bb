"""Connected components of a large edge list, by alternating large-star and small-star rounds.

Every round is two joins on a node's smallest neighbour, written to the checkpoint folder, so a lost
executor costs one round. The edges never leave the cluster; the number of rounds grows with the
logarithm of the longest path. Null ends and loops are dropped, repeated edges count once, and an
empty edge list has no components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import held


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.min("low").alias("least")).withColumn("least", F.least("node", "least"))
    moved = both.join(least, "node").where(F.col("low") > F.col("node"))
    return moved.select(F.col("low").alias("node"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("low").alias("least"))
    moved = edges.join(least, "node").where(F.col("low") > F.col("least"))
    down = moved.select(F.col("low").alias("node"), F.col("least").alias("low"))
    return down.unionByName(least.select("node", F.col("least").alias("low"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "low"))).first())


def components(edges: DataFrame, one: str, other: str) -> DataFrame:
    """Rows (node, root): each node of an edge with the smallest node that it reaches."""
    ends = edges.select(F.greatest(one, other).alias("node"), F.least(one, other).alias("low"), F.col(one).alias("a"), F.col(other).alias("b"))
    now = held(ends.where(F.col("a") != F.col("b")).select("node", "low").distinct())
    state = _state(now)
    while state[0]:
        now = held(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("low").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select("node", F.col("low").alias("root")).unionByName(roots)
