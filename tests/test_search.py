import numpy as np
import pytest
from pyspark.sql import functions as F

from loreweave.operators import ann
from loreweave.operators import checks as K
from loreweave.operators import search as S
from loreweave.operators.embedding import hashing_backend
from loreweave.plans.retrieval import fan_out, search_texts

VEC = "id string, embedding array<float>"
QRY = "query_id int, query_vector array<float>"


def exact(vectors, queries, k):
    """Brute force with ties by id and undefined similarities last."""
    out = {}
    for q, qv in queries:
        scored = []
        for i, v in vectors:
            if v is None:
                continue
            a, b = np.float32(v).astype(float), np.float32(qv).astype(float)
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            s = round(float((a * b).sum() / norm), 12) if norm else None
            scored.append((s is None, -(s or 0), i, s))
        out[q] = [(i, s if s is None else pytest.approx(s, abs=1e-9)) for _, _, i, s in sorted(scored)[:k]]
    return out


def collect(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.similarity))
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8)).round(3)
    vectors = [(f"v{i:04d}", [float(x) for x in base[i]]) for i in range(300)]
    vectors += [(f"w{i:04d}", vectors[5][1]) for i in range(150)]  # a third are copies of one
    vectors += [("zero", [0.0] * 8), ("none", None)]
    queries = [(i, [float(x) for x in base[i]]) for i in (5, 6, 7, 40)] + [(99, [0.0] * 8)]
    return vectors, queries


@pytest.mark.parametrize("floats", [10_000, 16])
def test_batch_against_brute_force(spark, data, floats):
    vectors, queries = data
    df, q = spark.createDataFrame(vectors, VEC).repartition(3), spark.createDataFrame(queries, QRY)
    hits = S.similar_batch(df, q, 7, block_floats=floats)
    assert collect(hits) == exact(vectors, queries, 7)


def test_k_larger_than_table(spark, data):
    vectors, queries = data
    df, q = spark.createDataFrame(vectors, VEC), spark.createDataFrame(queries, QRY)
    assert collect(S.similar_batch(df, q, 1000)) == exact(vectors, queries, 1000)


def test_no_queries(spark, data):
    df = spark.createDataFrame(data[0], VEC)
    assert S.similar_batch(df, spark.createDataFrame([], QRY), 3).count() == 0


def test_cells(spark, data):
    vectors, queries = data
    df = spark.createDataFrame(vectors, VEC).withColumn("cell", F.pmod(F.hash("id"), F.lit(3)))
    q = spark.createDataFrame(queries, QRY).withColumn("cell", F.explode(F.array(F.lit(0), F.lit(2))))
    inside = {r.id for r in df.filter("cell <> 1").collect()}
    want = exact([v for v in vectors if v[0] in inside], queries, 4)
    for floats in (10_000, 16):
        hits = S.similar_batch(df, q, 4, cell="cell", block_floats=floats).drop("rank")
        merged = S.top_k(hits, ["query_id"], 4, F.desc_nulls_last("similarity"), F.col("id"))
        got = {k: [h for h in v] for k, v in collect(merged).items()}
        assert got == want


def test_single(spark, data):
    vectors, queries = data
    df = spark.createDataFrame(vectors, VEC)
    want = exact(vectors, queries, 5)
    for q, qv in queries:
        rows = S.similar(df, qv, 5).collect()
        assert [(r.id, r.similarity) for r in rows] == want[q]


def cards(spark, names):
    rows = [(i, 0, n) for i, n in names.items()]
    return spark.createDataFrame(rows, "scryfall_oracle_id string, face_index int, name string")


def test_orphans_use_no_place(spark):
    rows = [("a:0", "card_text", 0, "best", [1.0, 0.0]), ("b:0", "card_text", 0, "next", [1.0, 0.1]),
            ("c:0", "rules", 0, "rule", [1.0, 0.0])]
    vec = spark.createDataFrame(rows, "id string, source string, chunk_index int, chunk_text string, embedding array<float>")
    known = cards(spark, {"b": "Bee"})
    hit = S.vector_search(vec, known, [1.0, 0.0], "card_text", 1).collect()
    assert [(r.id, r.name, r.chunk_text) for r in hit] == [("b:0", "Bee", "next")]
    assert S.vector_search(vec, None, [1.0, 0.0], "rules", 3).first().id == "c:0"
    with pytest.raises(ValueError):
        S.vector_search(vec, known, [1.0, 0.0], "nothing")
    assert {r.id for r in S.known_vectors(vec, known).collect()} == {"b:0"}


def test_lists(spark, data, tmp_path):
    vectors, queries = data
    queries = [q for q in queries if q[0] != 99]
    df, q = spark.createDataFrame(vectors, VEC), spark.createDataFrame(queries, QRY)
    centroids = ann.train_lists(df, lists=8, max_iter=5)
    assigned = ann.assign_lists(df, centroids)
    assert assigned.count() == len(vectors) - 1
    ann.write_lists(assigned, str(tmp_path / "lists"))
    stored = spark.read.parquet(str(tmp_path / "lists"))
    want = exact(vectors, queries, 5)
    assert collect(ann.search_lists(stored, centroids, q, 5, nprobe=8)) == want
    some = collect(ann.search_lists(stored, centroids, q, 5, nprobe=3))
    found = sum(len({w for w, _ in want[i]} & {w for w, _ in some[i]}) for i in want)
    assert found >= 0.6 * 5 * len(want)


def test_phrases(spark):
    df = spark.createDataFrame([("Draw a Card",), ("draw two cards",), (None,), ("100%",)], "t string")
    phrases = ["DRAW", "a_card", "w%c", "zz", "100\\%", "\\_", "d.a", "%", "00%%"]
    got = {r.phrase: r.n for r in S.phrase_counts(df, "t", spark.createDataFrame([(p,) for p in phrases], "phrase string")).collect()}
    want = {p: df.filter(F.col("t").ilike(f"%{p}%")).count() for p in phrases}
    assert got == want and got["DRAW"] == 2 and got["a_card"] == 1 and got["100\\%"] == 1 and got["d.a"] == 0


def test_filters(spark):
    df = spark.createDataFrame([(["a", "b"], {"m": "Legal"}), ([], {"m": "Banned"}), (None, None)], "x array<string>, l map<string,string>")
    rows = df.select(S.has_all(F.col("x"), ["a", "b"]).alias("a"), S.has_any(F.col("x"), ["b", "z"]).alias("o"),
                     S.is_legal(F.col("l"), "m").alias("l")).collect()
    assert [(r.a, r.o, r.l) for r in rows] == [(True, True, True), (False, False, False), (None, None, False)]


def test_checks(spark):
    df = spark.createDataFrame([("a", 0, "h"), ("a", 1, ""), ("b", 0, None), ("b", 0, "h")], "r string, i int, h string")
    row = K.foundation(df, "r", "i", "h", min_rows=3).first()
    assert row.asDict() == {"total_rows": 4, "distinct_records": 2, "extra_faces": 1, "missing_hash": 2,
                            "duplicate_keys": 1, "ok": False}
    good = df.filter("h = 'h'")
    assert K.foundation(good, "r", "i", "h", min_rows=1).first().ok
    v = spark.createDataFrame([(True, False), (False, False), (None, True)], "ok boolean, none boolean").select(
        K.verdict(F.col("ok"), F.col("none")).alias("verdict"))
    assert K.verdict_totals(v).first().asDict() == {"passed": 1, "failed": 1, "skipped": 1, "total": 3, "ok": False}


def test_search_texts_and_fan_out(spark):
    model = hashing_backend(256)
    docs = spark.createDataFrame([("a:0", "destroy target creature"), ("b:0", "draw a card"), ("c:0", "destroy all creatures")],
                                 "id string, text string")
    vectors = model.embed(docs, "text").select("id", "embedding")
    queries = spark.createDataFrame([(1, "draw a card"), (2, "destroy target creature")], "query_id int, text string")
    hits = {r.query_id: r.id for r in search_texts(queries, vectors, model, 1).collect()}
    assert hits == {1: "b:0", 2: "a:0"}
    tax = spark.createDataFrame(
        [("kill", [0], ["Removal"], []), ("kill.one", [0, 0], ["spot"], ["destroy target creature"]),
         ("kill.all", [0, 1], ["wipe"], ["destroy all creatures"])],
        "key string, dfs_ord array<int>, aliases array<string>, oracle_hints array<string>")
    terms = spark.createDataFrame([("removal",), ("WIPE",), ("other",)], "term string")
    found = {}
    for r in fan_out(terms, tax, vectors, model, 2).orderBy("term", "rank").collect():
        found.setdefault(r.term, []).append((r.id, round(r.similarity, 6)))
    assert [i for i, _ in found["removal"]] == ["a:0", "c:0"] and found["WIPE"][0] == ("c:0", 1.0)
    assert all(s == 1.0 for _, s in found["removal"]) and "other" not in found


def test_ties_cost_little(spark):
    """Equal and zero vectors are cut to k per block before they meet the queries."""
    rng = np.random.default_rng(2)
    equal, zero = [1.0] * 16, [0.0] * 16
    rows = [(f"e{i:05d}", equal) for i in range(4000)] + [(f"z{i:05d}", zero) for i in range(4000)]
    queries = [(i, [float(x) for x in rng.normal(size=16).round(3)]) for i in range(800)] + [(900, zero)]
    hits = S.similar_batch(spark.createDataFrame(rows, VEC), spark.createDataFrame(queries, QRY), 3)
    got = collect(hits)
    assert len(got) == 801
    assert all([i for i, _ in got[q]] == ["e00000", "e00001", "e00002"] for q in got)


def test_widths_are_checked(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0, 1.0])], VEC)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], QRY)
    with pytest.raises(Exception, match="width"):
        S.similar_batch(vectors, queries, 1).collect()


def test_texts_stay_where_they_are(spark):
    """A few search strings are sent to the texts; texts that hold the same one do not come to one task."""
    from loreweave.operators.matching import ROWS, occurrences

    rows = spark.range(3 * ROWS).select("id", F.when(F.col("id") != 5, F.lit("a common word")).alias("t"))
    needles = spark.createDataFrame([("common", 1), ("common", 2), ("none", 3), ("", 4)], "a string, k int")
    found = occurrences(rows, "t", needles, "a")
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.groupBy("k").count().orderBy("k").collect() == [(1, 3 * ROWS - 1), (2, 3 * ROWS - 1)]


def test_lists_are_searched_without_python_rows(spark, monkeypatch):
    """Neither centroids nor an empty start are lists of rows, which take Python workers of their own."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((60, 4)))]
    vectors = spark.createDataFrame(rows, "id int, embedding array<float>")
    queries = spark.createDataFrame(rows[:3], "query_id int, query_vector array<float>")
    centroids = rng.standard_normal((5, 4))
    seen, plain = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *args, **named: seen.append(data) or plain(self, data, *args, **named))
    assert [tuple(r) for r in ann.centroid_table(spark, centroids).collect()] == [(i, [float(x) for x in c.astype("float32")]) for i, c in enumerate(centroids)]
    found = ann.search_lists(ann.assign_lists(vectors, centroids), centroids, queries, 2, nprobe=5)
    assert {(r.query_id, r.id) for r in found.filter("rank = 1").collect()} == {(0, 0), (1, 1), (2, 2)}
    assert not [data for data in seen if isinstance(data, list)]
