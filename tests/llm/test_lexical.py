"""Ranked search against a plain scan."""

import math
import re
from collections import Counter, defaultdict

import numpy as np

from loreweave.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def terms(text):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return TERM.findall((text or "").translate(upper))


def brute(docs, items, most):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        words, found = set(terms(text)), []
        for i, b in bags:
            m = 50 + 50 * b.total() * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * b[w] // (1000 * b[w] + 20 * m))
                for w in words if w in b
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:most])]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id bigint, text string, rank int, item_id int")
    return d, spark.createDataFrame([(*x, "a") for x in items], "item_id bigint, text string, doc_id string")


def run(spark, docs, items, most=50):
    d, i = tables(spark, docs, items)
    got = lexical.search(d.repartition(5), "doc_id", "text", i, "item_id", "text", most)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def corpus(n=160):
    rng = np.random.default_rng(3)
    words = ["the", "of", "River", "stone", "été", "x9", "k-l", "日本", "a_b", "Zoë"] + [f"w{k}" for k in range(60)]
    p = 1 / np.arange(1, len(words) + 1)
    texts = [", ".join(rng.choice(words, rng.integers(1, 60), p=p / p.sum())) for _ in range(n)]
    docs = [(int(i), t) for i, t in zip(rng.permutation(n) * 3, texts, strict=True)]
    docs += [(1000 + i, docs[4][1]) for i in range(40)] + [(5, docs[4][1].upper()), (None, docs[4][1])]
    items = [(k, " ".join(rng.choice(words, 6))) for k in range(12)] + [(3, "stone w7")]
    return docs, items


def test_against_a_scan(spark):
    docs, items = corpus()
    for most in (1, 7, 50):
        assert run(spark, docs, items, most) == brute(docs, items, most)


def test_blocks_and_small_pieces(spark, monkeypatch):
    docs, items = corpus(60)
    want = brute(docs, items, 5)
    monkeypatch.setattr(lexical, "ITEMS", 4)
    monkeypatch.setattr(lexical, "PAIRS", 50)
    assert run(spark, docs, items, 5) == want
    monkeypatch.setattr(lexical, "WORDS", 9)
    assert run(spark, docs, items, 5) == want


def test_copies_fill_the_list_by_id(spark):
    docs = [(k, "alpha beta") for k in range(100, 0, -1)] + [(0, "alpha gamma"), (200, "delta")]
    got = run(spark, docs, [(1, "beta")])
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 51))
    assert got == brute(docs, [(1, "beta")], 50)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "one two"), (3, " .-; "), (4, "One one " * 30_000), (4, "two"), (4, "two"), (9, "é" * 3000)]
    items = [(1, None), (2, ""), (None, "one"), (3, "TWO two"), (3, "é"), (4, "absent"), (5, "é" * 3000)]
    assert run(spark, docs, items) == brute(docs, items, 50)
    assert run(spark, [], items) == run(spark, docs, []) == run(spark, [(1, None)], items) == []


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one"), ("a", "one"), ("c", "two")], "d string, t string")
    items = spark.createDataFrame([("q", "one")], "i string, t string")
    got = lexical.search(docs, "d", "t", items, "i", "t").orderBy("rank").collect()
    assert [(r.item_id, r.doc_id) for r in got] == [("q", "a"), ("q", "b")]


def test_sums_beyond_the_digits_of_a_double():
    postings = lexical.Postings([0], [list(range(400_000))], np.full(400_000, 27_000, np.int64))
    bag = np.column_stack([np.arange(400_000), np.full(400_000, 10**6)]).astype("<u4").tobytes()
    (_, got), = lexical.scores(postings, [bag], np.array([51]))
    assert got[0, 0] == 400_000 * 27_000 * (10**15 // (10**9 + 20 * 51))
