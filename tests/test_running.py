"""Counts from changes against a recount, and sketches against exact numbers."""

import random

import pytest
from pyspark.sql import functions as F

from loreweave.operators.running import RunningCounts, estimated_changes, key_sketch, vanished_keys

SCHEMA = "id long, source string, face int, hash string"


@pytest.mark.parametrize("max_runs", [2, 16])
def test_counts_after_runs(spark, tmp_path, max_runs):
    rng = random.Random(3)
    tests = {"faces": F.col("face") > 0, "without_hash": F.coalesce("hash", F.lit("")) == ""}
    state = RunningCounts(spark, str(tmp_path / "s"), ["source"], tests, ["hash", "face"], max_runs=max_runs)
    with pytest.raises(ValueError):
        state.counts()
    now: dict[int, tuple] = {}
    for _ in range(6):
        gone = rng.sample(sorted(now), len(now) // 4)
        fresh = {rng.randrange(200): (rng.choice(["a", "b", None]), rng.randrange(3), rng.choice(["x", "y", "", None])) for _ in range(40)}
        going = {i: now[i] for i in now if i in gone or i in fresh}
        now = {**{i: r for i, r in now.items() if i not in gone}, **fresh}
        state.apply(*[spark.createDataFrame([(i, *r) for i, r in part.items()], SCHEMA) for part in (fresh, going)])
        table = spark.createDataFrame([(i, *r) for i, r in now.items()], SCHEMA)
        want = table.groupBy("source").agg(
            F.count("*").alias("n"), *[F.count_if(t).alias(k) for k, t in tests.items()],
            F.countDistinct("hash").alias("distinct_hash"), F.countDistinct("face").alias("distinct_face"),
        )
        got = RunningCounts(spark, str(tmp_path / "s"), ["source"], tests, ["hash", "face"]).counts()
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_run_without_a_log_row_is_not_seen(spark, tmp_path):
    state = RunningCounts(spark, str(tmp_path / "s"), ["source"])
    row = spark.createDataFrame([(1, "a", 0, "x")], SCHEMA)
    state.apply(row, row.limit(0))
    broken = row.withColumn("source", F.raise_error(F.lit("no")))
    with pytest.raises(Exception):
        state.apply(broken, row.limit(0))
    assert [tuple(r) for r in state.counts().collect()] == [("a", 1)]


def test_sketches(spark):
    old, new = spark.range(0, 60_000), spark.range(6_000, 80_000)
    a, b = key_sketch(old, ["id"]), key_sketch(new, ["id"])
    r = estimated_changes(a, b).first()
    for got, want, larger in ((r.old_keys, 60_000, 60_000), (r.new_keys, 74_000, 74_000), (r.vanished, 6_000, 60_000), (r.added, 20_000, 74_000)):
        assert abs(got - want) <= 4 * want * (larger / want) ** 0.5 / 2**7
    assert vanished_keys(old, new, ["id"], a, b).count() == 6_000
    few, more = spark.range(100), spark.range(120)
    sketches = [key_sketch(x, ["id"]) for x in (few, more)]
    same = vanished_keys(few, more, ["id"], *sketches)
    assert same.count() == 0 and "Join" not in same._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.id for r in vanished_keys(more, few, ["id"], *sketches[::-1]).collect()) == list(range(100, 120))
