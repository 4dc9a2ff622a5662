"""Connected components by alternating large-star and small-star steps, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from claimloom.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    ties = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
    tied = edges.join(least, "u").select(ties.alias("tie")).select("tie.u", "tie.v")
    return tied.filter("u != v").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, label: the smallest node of its component, for every node of ``edges`` (u, v).

    Nodes are numbers; a loop is no edge.  Each round is landed, so no plan grows and a
    lost executor repeats one round at most; the number of rounds grows with the
    logarithm of the longest path.  Only a count and a checksum reach the driver.
    """

    def landed(df: DataFrame, part: str) -> tuple[DataFrame, tuple]:
        seen = Observation()
        watched = df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
        table = scratch.land(watched, part)
        return table, (seen.get["n"], seen.get["x"])

    oriented = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    state, mark = landed(oriented, f"{name}-0")
    rounds = 0
    while mark[0]:
        rounds += 1
        after, now = landed(_small_star(_large_star(state)), f"{name}-{rounds}")
        scratch.drop(f"{name}-{rounds - 1}")
        state, before, mark = after, mark, now
        if before == now:
            break
    ends = state.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("label")).union(ends)
