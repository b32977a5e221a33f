"""Connected components by alternating stars: every round is joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.sources.staging import stage


def _oriented(edges: DataFrame) -> DataFrame:
    """``u > v``, each edge once."""
    turned = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return turned.filter("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    linked = both.join(least, both["u"] == least["c"]).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
    linked = edges.join(least, edges["u"] == least["c"])
    to_least = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_least.union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return row[0], int(row[1])


def components(edges: DataFrame, *, most_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)`` but the roots; a root is its component's least node.

    Large stars hang a node's greater neighbours on its least one, small stars
    the lesser ones; both keep components and end in stars after a number of
    rounds that grows with the logarithm of the longest path. Each round is
    written, so a lost executor repeats one round at most.
    """
    now = stage(_oriented(edges), "stars")
    state = _state(now)
    for _ in range(most_rounds):
        now = stage(_oriented(_small_star(_oriented(_large_star(now)))), "stars")
        last, state = state, _state(now)
        if state == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("components did not settle")
