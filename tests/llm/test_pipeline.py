"""The pipeline's stages on a small corpus with planted cases."""

import numpy as np
import pytest

import corpus_pipeline as cp
from loreweave.llm import simhash

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"
SHARED = "This very sentence stands in a good many of the documents here."


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    words = ["the", "of", "and", "house", "river", "green", "stone", "walks", "under", "bright", "cold", "quiet"]

    def prose(n):
        return " ".join(words[i] + str(i) * 0 for i in rng.integers(0, len(words), n)) + "."

    rows = [(i, prose(120), "en", f"s{i % 3}") for i in range(40)]
    rows[5] = (5, rows[4][1], "en", "s2")  # an exact copy
    near = rows[7][1].split()
    rows[8] = (8, " ".join([*near[:60], "other", *near[61:]]), "en", "s1")
    rows += [(100, None, "en", "s0"), (101, "12 34 !", "en", None), (102, "", None, "s0")]
    rows += [(200 + i, prose(80) + "\n" + SHARED, "en", "s0") for i in range(6)]
    rows += [rows[0]]  # a repeated row
    return spark.createDataFrame([(*r, len(r[1] or ""), "x") for r in rows], COLUMNS)


def reachable(near, i):
    seen, new = set(), {i}
    while new:
        seen |= new
        new = {k for j in new for k in near[j]} - seen
    return seen


def test_near_duplicates_by_id_and_text(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (7, "a b c d"), (7, "a b c d"), (7, "k l m n o"), (3, "a b c d")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in rows], COLUMNS)
    kept = cp.near_duplicate_stage(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text) for r in kept.collect()))
    assert got == [(0, "q r s t u"), (3, "a b c d"), (7, "k l m n o")]


def test_stages(spark, corpus):
    docs, sizes = corpus, {}
    for name, fn in cp.STAGES[:-1]:
        docs = fn(spark, docs, "").cache()
        assert docs.columns == corpus.columns, name
        sizes[name] = docs.count()
        if name == "language":
            assert {100, 101, 102}.isdisjoint(r.doc_id for r in docs.collect()) and sizes[name] == 47
        if name == "lines":
            texts = {r.doc_id: r.text for r in docs.collect()}
            left = [r.doc_id for r in docs.collect() if SHARED in r.text]
            assert left == [205] and sizes[name] == 47
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "near_duplicates":
            kept = {r.doc_id: r.text for r in docs.collect()}
            assert len(kept) == sizes[name] and 4 in kept and 5 not in kept
            fps = {i: simhash.fingerprint(t) for i, t in texts.items()}
            near = {i: {j for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2} for i in fps}
            assert sorted(kept) == [i for i in sorted(fps) if min(reachable(near, i)) == i]
        if name == "mixing":
            times = docs.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
            assert times <= 3
    pieces = cp.STAGES[-1][1](spark, docs, "").collect()
    whole = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in pieces} == whole
    assert sum(r.length for r in pieces if r.start == 0) <= sum(r.doc_tokens for r in pieces if r.start == 0)


def test_empty_table(spark, corpus):
    docs = corpus.limit(0)
    for _, fn in cp.STAGES:
        docs = fn(spark, docs, "")
    assert docs.count() == 0
