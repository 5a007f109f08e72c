"""Connected components of an edge table, by alternating large-star and small-star rounds on Spark.

A node with very many neighbours - the smallest of a large component, in the end - is a hot key of the rounds' joins:
its rows are salted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collabstats.llm.common import materialize
from collabstats.operators.skew import skewed_join


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    met = skewed_join(both.where("b > a"), smallest, "a", "inner", salt_cols=["b"])
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = skewed_join(down, smallest, "a", "inner", salt_cols=["b"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(smallest.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of every node with an edge; ``edges`` has longs ``a`` and ``b``.

    Each round ends in a table in the shared folder; only one sum and one count come to the driver.
    """
    current = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    for _ in range(rounds):
        current = materialize(_small_star(_large_star(current)), name)
        after = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == tuple(after):
            break
        state = tuple(after)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    member = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return member.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def smallest_of(members: DataFrame, value: str, name: str) -> DataFrame:
    """``members`` (with ``root``) and the smallest ``value`` of each root as ``name``; a large root is salted."""
    salt = next(c for c in members.columns if c != "root")
    return skewed_join(members, members.groupBy("root").agg(F.min(value).alias(name)), "root", "inner", salt_cols=[salt])
