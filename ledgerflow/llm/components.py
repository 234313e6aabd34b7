"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("w"))
    others = edges.join(least, "u").where("v <> w").select(F.col("v").alias("u"), F.col("w").alias("v"))
    return others.unionByName(least.select("u", F.col("w").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that is not its component's smallest.

    edges: two columns of one ordered type; loops, repeats and nulls are
    ignored.  Each round contracts with two grouped minima and two
    many-to-one joins (which adaptive execution splits where a node is hot)
    and ends in a checkpoint.  Empty edges give an empty result.
    """
    e = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    e = checkpointed(e)
    state = _state(e)
    while state[0]:
        e = checkpointed(_small_star(_large_star(e)))
        if (now := _state(e)) == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
