"""Connected components of a distributed edge list by star contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import cut


def smallest_reachable(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (smallest node reachable) for every node of the edges (a, b); ids are longs.

    Alternating star rounds: each node ties its larger neighbours to its smallest one, then its smaller ones. A node of high degree
    only costs one row per neighbour and round. Ends when every node hangs on
    one top; the number of rounds follows the logarithm of the size.
    """
    # every edge from the larger to the smaller end
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        ends = state.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
            state.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        below, above = F.sum("below"), F.sum("above")
        if ends.groupBy("node").agg(below.alias("below"), above.alias("above")).where("below > 1 OR below > 0 AND above > 0").isEmpty():
            break  # every node is a top or hangs on one top
        both = state.select("u", "v").unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        # large stars: the larger neighbours of u go to the smallest of its surroundings
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small stars: what is below u, and u itself, go to the smallest below
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        state = cut(small.distinct())
    else:
        raise RuntimeError("components did not settle")
    tops = state.select("v").distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops.select(F.col("v").alias("node"), F.col("v").alias("component")))
