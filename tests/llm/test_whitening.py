"""Whitening against a plain eigendecomposition."""

import numpy as np
import pytest

from loreweave.llm import whitening

COLUMNS = "vec_id bigint, v array<double>, n int, x string"


def table(spark, rows, columns=COLUMNS):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x") for i, v in rows], columns)


def brute(rows, most=4):
    """Components, eigenvalues and sums of the distinct whole vectors."""
    x = np.unique(np.floor(256 * np.array([v for _, v in rows], float)).astype(np.int64), axis=0)
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    lam, axes = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, lam[::-1][:most], axes[:, ::-1][:, :most], lam.sum()


def check(got, rows):
    n, sums, lam, axes, trace = brute(rows)
    found = {}
    for r in got:
        found.setdefault(r.vec_id, {})[r.component] = r
    for i, v in rows:
        x = np.floor(256 * np.array(v, float)).astype(np.int64)
        for k in range(len(lam)):
            r = found[i][k + 1]
            assert r.n == n and r.deviation == int(((n * x - sums) ** 2).sum())
            assert r.explained == pytest.approx(lam[k] / trace, rel=1e-9)
            want = (x - sums / n) @ axes[:, k] / np.sqrt(lam[k])
            assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-7, abs=1e-8)
            assert r.identity_error < 1e-9
    signs = np.array([[np.sign(found[i][k + 1].whitened * ((np.floor(256 * np.array(v, float)) - sums / n) @ axes[:, k]))
                       for k in range(len(lam))] for i, v in rows])
    assert all(len(set(col[col != 0])) <= 1 for col in signs.T)


def test_rank_one_updates():
    rng = np.random.default_rng(0)
    for d in (1, 2, 7, 32):
        lam, axes, want = np.zeros(d), np.eye(d), np.zeros((d, d))
        for k in range(120):
            v = np.floor(rng.standard_normal(d) * 30)
            if k % 5 == 0:
                v[d // 2 :] = 0
            if k % 7 == 0:
                v = np.floor(want[0] / 900) if k % 2 else np.zeros(d)
            lam, axes = whitening.rank_one(lam, axes, v)
            want += np.outer(v, v)
            assert (np.diff(lam) >= 0).all()
        assert np.abs(axes.T @ axes - np.eye(d)).max() < 1e-11
        assert np.abs(axes @ np.diag(lam) @ axes.T - want).max() < 1e-11 * np.abs(want).max()


def test_spectra_combine_to_the_whole():
    rng = np.random.default_rng(1)
    x = np.floor(rng.standard_normal((900, 9)) * np.arange(1, 10) * 20 + 500).astype(np.int64)
    parts = [whitening.Spectrum.empty(9) for _ in range(4)]
    for part, rows in zip(parts, np.split(x, [1, 300, 310]), strict=True):
        part.add(rows)
    first = whitening.Spectrum.empty(9)
    for part in parts:
        first.merge(whitening.Spectrum.unpack(part.pack(), 9))
    assert first.n == 900 and (first.sums == x.sum(axis=0)).all()
    want = np.linalg.eigvalsh(np.cov(x.T, bias=True))
    assert first.lam / 900 == pytest.approx(want, rel=1e-9)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 16)
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(2)
    values = rng.standard_normal((300, 6)) * [1, 2, 3, 4, 5, 6]
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # copies count once
    check(whitening.whiten(table(spark, rows).repartition(7), "vec_id", "v").collect(), rows)


def test_given_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    check(whitening.whiten(vectors, "vec_id", "embedding").collect(), rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -0.25]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [-1.0, 2.0]), (4, [3.0, 1.0])]
    odd = [(5, None), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0]), (10, []), (11, [1.0, 2.0, 3.0])]
    got = whitening.whiten(table(spark, good + odd), "vec_id", "v").collect()
    assert sorted(r.vec_id or 0 for r in got) == [0, 0, 1, 1, 2, 2, 2, 2, 4, 4]
    assert {r.n for r in got} == {4} and {r.component for r in got} == {1, 2}
    for rows in ([], odd[:2], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(10, [])]):
        assert whitening.whiten(table(spark, rows), "vec_id", "v").count() == 0
    flat = [(i, [float(i), 2.0 * i, 7.0]) for i in range(5)]  # one axis only
    assert {r.component for r in whitening.whiten(table(spark, flat), "vec_id", "v").collect()} == {1}
    far = whitening.whiten(table(spark, [(1, [1e15, 0.0]), (2, [0.0, 1.0]), (3, [5.0, 2.0])]), "vec_id", "v").collect()
    assert {r.deviation for r in far if r.vec_id == 1} == {None}
