"""Tables in hash buckets: contents, plans, and what a run writes."""

import re

import pytest
from pyspark.sql import functions as F

from loreweave.sources.buckets import BucketTable

LAYOUT = "a string, b int, content_hash string, more string, updated_at string"


def table(spark, path, **more):
    layout = spark.createDataFrame([], LAYOUT).schema
    return BucketTable(spark, str(path), layout, ["a", "b"], 8, **more)


def rows(spark, items, stamp):
    return spark.createDataFrame([(f"k{i}", i % 3, h, f"{h}{stamp}", stamp) for i, h in items.items()], LAYOUT)


def contents(t):
    return {r.a: (r.content_hash, r.updated_at, r.more) for r in t.rows().collect()}


def merged(now, new, stamp, delete_stale):
    out = dict(now) if not delete_stale else {k: v for k, v in now.items() if int(k[1:]) in new}
    for i, h in new.items():
        if f"k{i}" not in now or now[f"k{i}"][0] != h:
            out[f"k{i}"] = (h, stamp, f"{h}{stamp}")
    return out


RUNS = [
    {i: "x" for i in range(60)}, {i: "x" for i in range(60)}, {**{i: "x" for i in range(60)}, 3: "y"},
    {i: "x" for i in range(5, 60)}, {**{i: "z" for i in range(40)}, 900: "n"}, {900: "n"}, {}, {1: "a"},
]


@pytest.mark.parametrize("max_versions", [2, 16])
@pytest.mark.parametrize("delete_stale", [True, False])
def test_runs(spark, tmp_path, max_versions, delete_stale):
    t, want = table(spark, tmp_path / "t", max_versions=max_versions), {}
    for n, new in enumerate(RUNS):
        counts = t.sync(rows(spark, new, f"r{n}"), delete_stale=delete_stale)
        gone = [k for k in want if int(k[1:]) not in new]
        assert counts["inserted"] == sum(f"k{i}" not in want for i in new)
        assert counts["deleted"] == (len(gone) if delete_stale else 0)
        want = merged(want, new, f"r{n}", delete_stale)
        assert contents(t) == want
        assert sorted(b for own in t.current().values() for b in own) == sorted({b for own in t.current().values() for b in own})
    assert t.log().count() == len(RUNS)
    # Another session object finds the same table.
    assert contents(table(spark, tmp_path / "t")) == want


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_rows_are_not_shuffled(spark, tmp_path, no_broadcast):
    t = table(spark, tmp_path / "t", max_share=1.0)
    t.sync(rows(spark, {i: "x" for i in range(200)}, "r0"))
    t.sync(rows(spark, {**{i: "x" for i in range(200)}, 7: "y"}, "r1"))
    assert len(t.current()) == 2
    incoming = t._incoming(rows(spark, {i: "x" for i in range(190)}, "r2"))
    for df in (t.classes(incoming, "content_hash"), t._merged(incoming, list(range(8)), "content_hash", True)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("SortMergeJoin", plan)) >= 2
        assert "Exchange" not in plan.replace("LocalTableScan", "")
        assert plan.count("Bucketed: true") >= 4


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    base = {i: "x" for i in range(200)}
    t.sync(rows(spark, base, "r0"))
    t.sync(rows(spark, {**base, 11: "y"}, "r1"))
    own = spark.createDataFrame([("k11", 11 % 3)], "a string, b int").select(t.bucket()).first()[0]
    assert t.current()[2] == [own]
    written = spark.read.parquet(str(tmp_path / "t" / "v=2"))
    assert {r[0] for r in written.select("_bucket").distinct().collect()} == {own}
    before = t.log().count()
    t.sync(rows(spark, {**base, 11: "y"}, "r2"))
    assert not (tmp_path / "t" / "v=3").exists() and t.log().count() == before + 1


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.sync(rows(spark, {1: "x"}, "r0"))
    want = contents(t)
    broken = rows(spark, {2: "x"}, "r1").withColumn("more", F.raise_error(F.lit("no")))
    with pytest.raises(Exception):
        t.sync(broken)
    assert contents(t) == want
    t.sync(rows(spark, {1: "x", 2: "x"}, "r2"))
    assert set(contents(t)) == {"k1", "k2"}
