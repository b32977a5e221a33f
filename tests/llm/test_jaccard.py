"""The n-gram Jaccard join against all pairs."""

from collections import defaultdict

import numpy as np
import pytest

from loreweave.llm import jaccard

ODD = [(1, None), (2, ""), (None, "one two"), (3, " \t\n "), (3, " \t\n "), (4, "w " * 30_000), (5, "é" * 3_000), (6, "One TWO"), (7, "Two one")]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, b"x", 1) for i, t in rows], "doc_id bigint, text string, key binary, n int").repartition(3)


def shingles(text):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = (text or "").translate(upper).encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    c = len(a & b)
    return bool(a) and bool(b) and 100 * c >= 80 * (len(a) + len(b) - c)


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)].append(doc_id)
    name = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((i, len(sets[k]), name[root(k)]) for k, (i, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    got = jaccard.join(docs(spark, rows), "doc_id", "text")
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.fixture
def small(monkeypatch):
    for name, size in (("MEMBERS", 4), ("QUERIES", 3), ("COLUMNS", 7), ("BLOCK", 300), ("SHARD", 500), ("SENT", 0)):
        monkeypatch.setattr(jaccard, name, size)


def corpus(seed=0):
    """Families of near copies at all distances, a common passage, and texts of their own."""
    rng = np.random.default_rng(seed)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for f in range(8):
        base = [f"b{f}x{k}" for k in range(int(rng.integers(6, 120)))]
        for _ in range(12):
            words = list(base)
            for _ in range(int(rng.integers(0, 2 + len(words) // 20))):
                at = int(rng.integers(0, len(words)))
                words[at : at + 1] = [[], [f"n{rng.integers(0, 40)}"], [words[at], "twice"]][int(rng.integers(0, 3))]
            if rng.random() < 0.3:
                words += passage
            rows.append(" ".join(words))
    rows += [" ".join([*passage, *[f"o{d}x{k}" for k in range(int(rng.integers(0, 60)))]]) for d in range(40)]
    rows += rows[:10] + [rows[3].upper()] * 5
    order = rng.permutation(len(rows))
    return [(int(i), rows[k]) for i, k in zip(rng.permutation(len(rows)) + 50, order, strict=True)]


def test_against_all_pairs(spark):
    rows = corpus() + ODD
    assert run(spark, rows) == brute(rows)


def test_small_parts_and_blocks(spark, small):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)


def test_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_exactly_at_the_similarity(spark):
    pairs, rows = {}, []

    def put(words, other):
        words, other = ([f"p{len(pairs)}{w}" for w in x] for x in (words, other))
        a, b = " ".join(words), " ".join(other)
        i = 2 * len(pairs)
        pairs[i] = alike(shingles(a), shingles(b))
        rows.extend([(i, a), (i + 1, b)])
        c = len(shingles(a) & shingles(b))
        return c / (len(shingles(a)) + len(shingles(b)) - c)

    seen = []
    for n in (4, 5, 8, 12, 16, 20, 24, 40, 80, 160, 320, 400):
        for _ in range(4 if n < 30 else 2):
            words = [f"w{k}" for k in range(n + 4)]
            seen.append(put(words, [*words, *[f"x{k}" for k in range(n // 4)]]))
            seen.append(put(words, [*words, *[f"x{k}" for k in range(n // 4 + 1)]]))
            seen.append(put(words, [*words[: n + 4 - n // 6], *[f"y{k}" for k in range(n // 6)]]))
    got = {r[0]: r[2] for r in run(spark, rows)}
    assert {i: got[i] == got[i + 1] for i in pairs} == pairs
    assert 0.8 in seen and any(0.6 < j < 0.8 for j in seen)


def test_chains_through_texts_of_unlike_ends(spark, small):
    words = [f"w{k}" for k in range(104)]
    rows = [(k, " ".join([*words[: 104 - k], *[f"v{k}x{x}" for x in range(k)]])) for k in range(0, 48, 4)]
    rows += [(100 + k, " ".join(words[k:])) for k in range(0, 60, 3)]
    assert run(spark, rows) == brute(rows)


def test_texts_just_below_the_similarity_are_not_compared(spark, monkeypatch):
    base = [f"w{k}" for k in range(100)]
    rows = [(d, " ".join([*base, *[f"o{d}x{k}" for k in range(22)]])) for d in range(120)]
    seen = []
    monkeypatch.setattr(jaccard, "_met", lambda *a, met=jaccard._met: seen.append(met(*a)) or seen[-1])
    assert run(spark, rows) == brute(rows)
    assert not seen or seen[0].count() == 0


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (None, " ")]) == [(1, 0, 1), (None, 0, None)]
    assert run(spark, [(None, "a b"), (None, "a b"), (3, "c")]) == [(3, 1, 3), (None, 1, None), (None, 1, None)]
