"""Ancestors, cycles and collected values against plain walks."""

import random

from pyspark.sql import functions as F

from loreweave.operators.closure import ancestors, collected, cycles


def walk(parent):
    up, lost = [], {}
    for k in parent:
        path, at = [], k
        while parent.get(at) is not None and parent[at] in parent and parent[at] not in path:
            at = parent[at]
            path.append(at)
        nxt = parent.get(at)
        if nxt is not None and nxt in parent:
            lost[k] = min(path[path.index(nxt):] if nxt in path else path)
        else:
            up += [(k, a, d + 1) for d, a in enumerate(path)]
    return sorted(up), lost


def check(spark, parent):
    nodes = spark.createDataFrame(list(parent.items()), "key string, parent_key string")
    up, lost = walk(parent)
    assert sorted(map(tuple, ancestors(nodes).collect())) == up
    assert dict(map(tuple, cycles(nodes).collect())) == lost
    return nodes


def test_trees_chains_and_cycles(spark):
    rng = random.Random(1)
    tree = {f"n{k}": f"n{rng.randrange(k)}" if k else None for k in range(40)}
    chain = {f"c{k}": f"c{k - 1}" if k else None for k in range(21)}
    ring = {f"r{k}": f"r{(k + 1) % 5}" for k in range(5)} | {"into": "r3", "far": "into", "self": "self", "below": "self"}
    nodes = check(spark, tree | chain | ring | {"lost": "no such node", "alone": None})
    values = spark.createDataFrame([("c3", "x"), ("c20", "y"), ("c20", "y"), ("r1", "z")], "key string, value string")
    got = {r.key: 0 for r in collected(nodes, values).collect()}
    assert set(got) == {f"c{k}" for k in range(21)} | {"r1"}
    assert collected(nodes, values).filter("key = 'c3'").count() == 3


def test_small(spark):
    check(spark, {})
    check(spark, {"a": None})
    check(spark, {"a": "b", "b": "a"})
    check(spark, {"a": "b", "b": None, "c": "zz"})


def test_no_table_goes_through_the_driver(spark, monkeypatch):
    """Tables of a round are joined where they are, however small their files look."""
    from loreweave.operators import closure

    plans, write = [], closure.stage

    def stage(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(closure, "stage", stage)
    nodes = spark.range(40).select(F.col("id").cast("string").alias("key"), F.expr("if(id > 0, cast(id - 1 as string), null)").alias("parent_key"))
    assert closure.ancestors(nodes).count() == 40 * 39 // 2
    assert plans and not any("BroadcastExchange" in p for p in plans)
