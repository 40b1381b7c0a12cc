"""Connected components of an undirected graph of numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store


def connected(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): root is the least node of the component.

    In each round every node moves to the least of itself and its neighbours, and the edges
    move along, so stars are done in one round and long paths halve. Rounds are stored:
    a lost executor costs the round at most. Aggregates are partial and joins are by node,
    so a node with very many edges is split by adaptive execution.
    """
    edges, seen = store(_clean(edges), n=F.count(F.lit(1)))
    done = None
    while seen["n"]:
        both = edges.union(edges.select("b", "a"))
        moved, _ = store(
            both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to"))
        )
        if done is None:
            done = moved.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            step = moved.withColumnRenamed("a", "root")
            done = done.join(step, "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
            done, _ = store(done)
        one = moved.select("a", F.col("to").alias("x"))
        two = moved.select(F.col("a").alias("b"), F.col("to").alias("y"))
        contracted = edges.join(one, "a").join(two, "b").select(
            F.col("x").alias("a"), F.col("y").alias("b")
        )
        edges, seen = store(_clean(contracted), n=F.count(F.lit(1)))
    if done is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return done


def _clean(edges: DataFrame) -> DataFrame:
    pair = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair.distinct()
