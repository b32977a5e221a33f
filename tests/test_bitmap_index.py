"""Array and map filters by bitmaps against plain filters."""

import pytest

from loreweave.operators.bitmap_index import BitmapIndex

SCHEMA = "id long, colors array<string>, legal map<string,string>, at int"


@pytest.fixture(scope="module")
def rows():
    out = [(k, [c for i, c in enumerate("WUBRG") if k >> i & 1], {"modern": "Legal" if k % 3 else "Banned", "old": None}, 1) for k in range(400)]
    return [*out, (1000, None, None, 2), (1001, [None, "W"], {}, 3), (1002, ["W", "W"], {"modern": "Legal"}, 4), (1002, ["W", "W"], {"modern": "Legal"}, 4)]


def has(row, way):
    arrays = {"colors": row[1] or [], "legal": [f"{k}={v}" for k, v in (row[2] or {}).items() if v is not None]}
    return all(v in arrays[c] for c, values in way.items() for v in values)


@pytest.mark.parametrize("ways", [
    [{"colors": ["W", "G"]}], [{"colors": ["W", "W"], "legal": ["modern=Legal"]}], [{"colors": ["U"]}, {"legal": ["modern=Banned"]}],
    [{"colors": ["none"]}], [{"colors": ["W", "none"]}, {"colors": ["B", "R", "G", "W", "U"]}], [{"legal": ["old=null"]}],
])
def test_filters(spark, rows, tmp_path, ways):
    index = BitmapIndex(spark, str(tmp_path / "i"))
    index.write(spark.createDataFrame(rows, SCHEMA).repartition(5), ["colors", "legal"])
    want = sorted(r[0] for r in rows if any(has(r, w) for w in ways))
    got = index.rows(*ways)
    assert got.columns == ["id", "colors", "legal", "at"]
    assert sorted(r.id for r in got.collect()) == want and index.count(*ways) == len(want)


def test_only_buckets_with_matches_are_read(spark, tmp_path):
    index = BitmapIndex(spark, str(tmp_path / "i"))
    n = 100_000  # four buckets of 32,768 numbers
    table = spark.range(n, numPartitions=3).selectExpr("id", "array(cast(id div 40000 as string)) as v")
    index.write(table, ["v"])
    found = index.rows({"v": ["2"]})
    assert found.count() == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(bucket" in plan or "EqualTo(bucket" in plan
    assert index.numbers({"v": ["2"]}).select("bucket").distinct().count() <= 2
    assert index.rows({"v": ["9"]}).count() == 0
    with pytest.raises(ValueError):
        index.numbers({"v": []})


def test_empty(spark, tmp_path):
    index = BitmapIndex(spark, str(tmp_path / "i"))
    index.write(spark.createDataFrame([], SCHEMA), ["colors"])
    assert index.rows({"colors": ["W"]}).count() == 0
