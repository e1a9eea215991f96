"""Connected components by alternating stars, on DataFrames."""

from __future__ import annotations

from partflow.session import settle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state_of(pairs: DataFrame) -> tuple:
    """Two numbers that tell two sets of pairs apart."""
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (its smallest node) of every node that has an edge to another.

    A round links every larger neighbour of a node to its smallest one, then every smaller one; the pairs
    end as a star around the smallest node of each component after a number of rounds that grows with the
    logarithm of the nodes. Minima combine before the shuffle, and joins carry no group through one task.
    Every round is kept by checkpoint(). Loops, NULL ends, repeated and reversed edges do no harm.
    """
    pairs = settle(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = state_of(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = settle(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, state_of(pairs)
        if state == before:
            break
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
