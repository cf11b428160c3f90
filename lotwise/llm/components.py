"""Connected components of a graph held as edge rows, by large-star / small-star rounds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; any order, repeats
    and loops allowed): root is the smallest node that it reaches.

    Each round links every node's larger neighbours to the smallest node of its
    neighbourhood (large star), then its smaller ones (small star); the edge set
    ends as one star a component after O(log^2 n) rounds at most. Neighbourhood
    minima are map-side aggregates, so a node with very many neighbours is no
    group in one task, and the joins that carry the minima back are plain joins
    that adaptive execution can split. Every round is checkpointed.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    e = materialise(e)
    last = None
    for _ in range(max_rounds):
        e = materialise(_small_star(materialise(_large_star(e))))
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state.n, state.h) == last:
            break
        last = (state.n, state.h)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(e.select("v", "v").distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    # the larger neighbours of a node x are the u of the rows with v = x
    return e.join(low.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).where("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = materialise(e.groupBy("u").agg(F.min("v").alias("m")))
    return e.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")) \
        .where("u != v").distinct()
