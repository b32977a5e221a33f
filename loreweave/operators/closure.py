"""Ancestors in trees given as rows of key and parent, in rounds that grow with the logarithm of the depth.

Every node points at its parent. In each round it points twice as far, and what the
node it points at has reached so far is added to what it has reached itself. Nodes
that still point at something when all of them could have been passed are on a cycle,
or lead to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.sources.staging import stage

#: Every round joins tables as long as the tree, or nearly; none of them is sent through the driver.
JOIN = "merge"


def _jumps(nodes: DataFrame) -> DataFrame:
    """``key, up`` of nodes whose parent is a node; other parents end the path."""
    known = nodes.select(F.col("key").alias("up"))
    linked = nodes.filter("parent_key is not null").select("key", F.col("parent_key").alias("up"))
    return linked.join(known.hint(JOIN), "up", "left_semi").select("key", "up")


def _twice(jumps: DataFrame) -> DataFrame:
    on = jumps.select(F.col("key").alias("up"), F.col("up").alias("far"))
    return jumps.join(on.hint(JOIN), "up").select("key", F.col("far").alias("up"))


def cycles(nodes: DataFrame) -> DataFrame:
    """``key, cycle``: nodes of ``key, parent_key`` that never come to a root, and the least key of the cycle they come to.

    ``key`` is unique and not null. Nodes without a cycle above them are not listed.
    """
    jumps = stage(_jumps(nodes), "jumps")
    step, far, reached, most = jumps, 1, jumps.count(), nodes.count()
    # ``least`` is the least key within ``far`` steps from a node on.
    least = jumps.select("key", F.least("key", "up").alias("least"))
    while reached and far <= most:
        behind = least.select(F.col("key").alias("up"), F.col("least").alias("behind"))
        least = stage(step.join(least.hint(JOIN), "key").join(behind.hint(JOIN), "up").select("key", F.least("least", "behind").alias("least")), "least")
        step = stage(_twice(step), "jumps")
        far, reached = far * 2, step.count()
    # A jump over all nodes ends on the cycle; from there on, everything is on it.
    on = least.select(F.col("key").alias("up"), F.col("least").alias("cycle"))
    return step.join(on.hint(JOIN), "up").select("key", "cycle")


def ancestors(nodes: DataFrame) -> DataFrame:
    """``key, ancestor, distance`` of nodes of ``key, parent_key``; nodes are not their own ancestors.

    Nodes that lead to a cycle have no rows; ``cycles`` names them.
    """
    bad = stage(cycles(nodes), "cycles")
    jumps = stage(_jumps(nodes).join(bad.select("key").hint(JOIN), "key", "left_anti"), "jumps")
    found, far = jumps.select("key", F.col("up").alias("ancestor"), F.lit(1).alias("distance")), 1
    while not jumps.isEmpty():
        beyond = found.select(F.col("key").alias("up"), "ancestor", (F.col("distance") + far).alias("distance"))
        found = stage(found.unionByName(jumps.join(beyond.hint(JOIN), "up").select("key", "ancestor", "distance")), "ancestors")
        jumps, far = stage(_twice(jumps), "jumps"), far * 2
    return found


def collected(nodes: DataFrame, values: DataFrame) -> DataFrame:
    """``key, node, distance, value``: the values (``key, value``) of each node and of all below it."""
    up = ancestors(nodes).select(F.col("key").alias("node"), F.col("ancestor").alias("key"), "distance")
    own = nodes.select(F.col("key").alias("node"), "key", F.lit(0).alias("distance"))
    return own.unionByName(up).join(values.withColumnRenamed("key", "node"), "node").select("key", "node", "distance", "value")
