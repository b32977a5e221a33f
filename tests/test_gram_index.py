"""Phrase search by posting lists against a scan."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.operators import gram_index
from loreweave.operators.gram_index import GramIndex, cover, deltas, grams, undelta

TEXTS = [
    (1, "Draw a card, then draw two cards."), (2, "draw"), (3, None), (4, ""), (5, "ab"), (6, "aaaaaa"), (7, "É日𝒳é draws"),
    (8, "card"), (9, "s.draw two"), (10, "x\ny draw\n"), (11, "w " * 3000 + "the end"),
]
PHRASES = ["draw", "DRAW TWO", "card", "aaa", "aaaa", "aaaaaaa", "é日𝒳É", "two cards", "the end", "w w w w", "\ny d", "absent", "s.d", "raw"]


def want(rows, phrases):
    return {p: sorted(i for i, t in rows if t is not None and p.lower() in t.lower()) for p in phrases}


def got(index, phrases):
    out = {p: [] for p in phrases}
    for r in index.find(phrases).collect():
        out[r.phrase].append(r.id)
    return {p: sorted(ids) for p, ids in out.items()}


def test_lists():
    places = np.array([0, 3, 4, 900, 70_000])
    assert undelta(deltas(places)).tolist() == places.tolist()
    for phrase in ("abc", "abcd", "abcdefgh", "aaaaaaa"):
        touched = {p + k for p, _ in cover(phrase) for k in range(3)}
        assert touched == set(range(len(phrase)))
    assert len(grams(np.arange(2))) == 0 and cover("ab") == []


@pytest.mark.parametrize("block", [gram_index.BLOCK, 40])
def test_against_a_scan(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(gram_index, "BLOCK", block)
    index = GramIndex(spark, str(tmp_path / "i"))
    index.add(spark.createDataFrame(TEXTS, "id long, text string").repartition(3))
    assert got(index, PHRASES) == want(TEXTS, PHRASES)
    counts = {r.phrase: r.n for r in index.counts(PHRASES).collect()}
    assert counts == {p: len(ids) for p, ids in want(TEXTS, PHRASES).items()}
    with pytest.raises(ValueError):
        index.find(["ab"])


def test_segments_follow_the_table(spark, tmp_path):
    index, now = GramIndex(spark, str(tmp_path / "i")), {}
    steps = [
        (dict(TEXTS), []), ({2: "no more", 20: "a new card"}, [1, 8]), ({}, [20]), ({1: "draw again", 20: "card"}, []),
    ]
    for rows, gone in steps:
        ids = spark.createDataFrame([(i,) for i in gone], "id long")
        index.add(spark.createDataFrame(list(rows.items()), "id long, text string"), ids)
        now = {**{i: t for i, t in now.items() if i not in gone}, **rows}
        assert got(GramIndex(spark, str(tmp_path / "i")), PHRASES) == want(list(now.items()), PHRASES)


def test_only_the_lists_in_question_are_read(spark, tmp_path):
    index = GramIndex(spark, str(tmp_path / "i"), T.StringType(), files=6)
    index.add(spark.createDataFrame([(f"t{k}", f"some words and number {k}") for k in range(300)], "id string, text string"))
    found = index.find(["number 29"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan or "PushedFilters: [IsNotNull(gram), In(gram" in plan
    assert "text:string" not in plan
    assert sorted(r.id for r in found.collect()) == sorted(["t29", *[f"t29{k}" for k in range(10)]])
    assert index.counts(["number 29"]).filter(F.col("n") == 11).count() == 1


def test_files_of_lists_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(gram_index, "FILE", 20_000)
    index = GramIndex(spark, str(tmp_path / "i"), files=2)
    rows = spark.range(3000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    index.add(rows)
    assert len(list((tmp_path / "i/segment=1/postings").glob("part-*.parquet"))) > 8
    want = {r.id for r in rows.collect() if "abc" in r.text}
    assert {r.id for r in index.find(["ABC"]).collect()} == want
