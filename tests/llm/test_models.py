"""Language model, language ID, line dedup, SimHash, nearest neighbours and packing against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from loreweave.llm import components, gru, hashing_index, language, linedup, lm, packing, simhash

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (None, "one two"), (3, " \t\n "), (3, " \t\n "), (4, "w " * 30_000), (5, "é" * 3_000)]


def docs(spark, rows, extra="row string, n bigint"):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], f"doc_id bigint, text string, {extra}")


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# Language model


def test_lm_base_and_gain(spark, corpus):
    got = {r.doc_id: r for r in lm.score(corpus, "doc_id", "text").collect()}
    texts = {r.doc_id: [*(r.text or "").encode().lower().split(), lm.END] for r in corpus.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, ws in texts.items() if not out[i] for w in ws)
    total = sum(counts.values())
    for i, ws in texts.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[i], len(ws), total)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        base = sum(np.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws)
        assert r.base_score == pytest.approx(base)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_tokens():
    import pyarrow as pa

    texts = [None, "", " a  B\tc\x0bÉ\x1cé\n", "a", " ", "x" * 9]
    words, tokens, ends = lm.tokens_of(pa.array(["skipped", *texts]).slice(1))
    got = [[words[int(t)].as_py() for t in part] for part in np.split(tokens, ends[:-1])]
    assert got == [[*(t or "").encode().lower().split(), lm.END] for t in texts]


def test_lm_is_the_same_for_every_partitioning(spark, monkeypatch):
    """Equal scores from one and from many partitions, in shares, with rare words and hot rows in play."""
    for name, size in (("SHARE", 4_000), ("EQUAL", 30), ("STREAM", 20_000), ("DICTIONARY", 300), ("SCORED", 30_000)):
        monkeypatch.setattr(lm, name, size)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(80).collect()]
    rows += [(None, None)] * 60 + [(5000, "one and the same row")] * 10
    table = docs(spark, rows)
    found = []
    for parts in (1, 5):
        got = lm.score(table.repartition(parts), "doc_id", "text").collect()
        found.append(sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 3)) for r in got))
    assert found[0] == found[1]
    counts = Counter(w for i, t in rows for w in [*(t or "").encode().lower().split(), lm.END] if zlib.crc32(str(i).encode()) % 7 != 2 or i is None)
    assert all(k == sum(counts[w] > 0 for w in [*(t or "").encode().lower().split(), lm.END])
               for (i, _, k, _, _), (_, t) in zip(found[0], sorted(rows, key=lambda r: (r[0] or -1)), strict=True) if i > 0 and i < 5000)


def test_lm_odd_rows(spark):
    got = lm.score(docs(spark, ODD), "doc_id", "text").collect()
    assert len(got) == 7 and all(np.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    same = [r for r in got if r.doc_id == 3]
    assert same[0].score == pytest.approx(same[1].score)
    assert lm.score(docs(spark, []), "doc_id", "text").count() == 0


def test_gru_probabilities_sum_to_one():
    shape = gru.Shape(70)
    p = gru.initial(shape, np.ones(70), np.ones(gru.TAILS))
    states = np.random.default_rng(0).standard_normal((1, shape.hidden)).astype(np.float32)
    all_ids = np.arange(shape.start)
    total = np.exp(gru.log_probabilities(p, shape, np.repeat(states.T, len(all_ids), 1), all_ids)).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_gru_gradient_by_finite_differences():
    rng = np.random.default_rng(3)
    shape = gru.Shape(40)
    p = {k: v + 0.2 * rng.standard_normal(v.shape) for k, v in gru.initial(shape, np.ones(40), np.ones(gru.TAILS)).items()}
    p["word_bias"][-1, 40 % gru.PER_CLASS :] = -1e9
    p = {k: v.astype(np.float32) for k, v in p.items()}
    inputs, targets = rng.integers(0, 72, (6, 5)), rng.integers(0, 72, (6, 5))
    inputs[2, 3] = targets[1, 3] = shape.start
    h = rng.standard_normal((shape.hidden, 5)).astype(np.float32) * 0.3
    found = {}

    class Stepless(gru.Trainer):
        def step(self, k, at, g):
            full = np.zeros(p[k].shape)
            full[at] = g
            found[k] = full

    Stepless(p, shape).window(inputs, targets, h)

    def loss(q):
        states, _ = gru._states(q, inputs, h, shape.start)
        ids = targets.ravel()
        real = ids != shape.start
        return -gru.log_probabilities(q, shape, states[:, real], ids[real]).astype(float).sum() / real.sum()

    for k in p:
        for _ in range(6):
            at = tuple(int(rng.integers(0, n)) for n in p[k].shape)
            if k == "word_bias" and p[k][at] < -1e8:
                continue
            up, down = ({**p, k: p[k].copy()} for _ in range(2))
            up[k][at] += 1e-2
            down[k][at] -= 1e-2
            assert found[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-2, abs=2e-4), (k, at)


def test_gru_gradient():
    """The loss falls along the step that a window takes."""
    rng = np.random.default_rng(1)
    shape = gru.Shape(40)
    ids = np.tile(rng.integers(0, 40, 12), 400).astype(np.int32)
    trainer = gru.Trainer(gru.initial(shape, np.ones(40), np.ones(gru.TAILS)), shape)
    before = gru.score_documents(trainer.p, shape, [ids])[0]
    for _ in range(20):
        trainer.stream(np.concatenate([[shape.start], ids]).astype(np.int32), 8, 16)
    assert gru.score_documents(trainer.p, shape, [ids])[0] > 0.5 * before


def test_gru_state_runs_through_windows_and_not_across_documents():
    shape = gru.Shape(40)
    p = gru.initial(shape, np.ones(40), np.ones(gru.TAILS))
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 40, n).astype(np.int32) for n in (1, 200, 3, 77, 0)]
    together = gru.score_documents(p, shape, texts)
    alone = [gru.score_documents(p, shape, [t])[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-4)
    states, _ = gru._states(p, np.concatenate([[shape.start], texts[1][:-1]])[:, None], np.zeros((shape.hidden, 1), np.float32), shape.start)
    assert together[1] == pytest.approx(gru.log_probabilities(p, shape, states, texts[1]).sum(), rel=1e-4)


def test_gru_scores_few_lanes_in_long_windows(monkeypatch):
    """A single long document is not scored in as many windows as it has steps of training."""
    shape, calls = gru.Shape(40), []
    p = gru.initial(shape, np.ones(40), np.ones(gru.TAILS))
    plain = gru.log_probabilities
    monkeypatch.setattr(gru, "log_probabilities", lambda *args: calls.append(1) or plain(*args))
    gru.score_documents(p, shape, [np.arange(4096, dtype=np.int32) % 40])
    assert len(calls) == 1


@pytest.mark.parametrize("times", [1, 1000])
def test_gru_probabilities_of_small_and_of_large_weights(times):
    """Large weights need the shift before ``exp`` that small ones go without."""
    rng = np.random.default_rng(4)
    shape = gru.Shape(70)
    p = gru.initial(shape, rng.integers(1, 90, 70), np.ones(gru.TAILS))
    p |= {k: p[k] * np.float32(times) for k in ("classes", "words")}
    ids = rng.integers(0, shape.start, 5000)
    states = np.tanh(rng.standard_normal((shape.hidden, 5000))).astype(np.float32)

    def softmax(weights, bias, at, some):
        logits = weights.T.astype(float) @ some + bias[:, None]
        logits -= logits.max(axis=0)
        return logits[at, np.arange(len(at))] - np.log(np.exp(logits).sum(axis=0))

    classes = gru._class_of(ids, shape)
    wanted = softmax(p["classes"], p["class_bias"], classes, states)
    for k in range(shape.blocks):
        mine = np.flatnonzero(classes == k)
        wanted[mine] += softmax(p["words"][k], p["word_bias"][k], ids[mine] - k * gru.PER_CLASS, states[:, mine])
    assert np.allclose(gru.log_probabilities(p, shape, states, ids), wanted, rtol=1e-4, atol=1e-4)


def test_gru_makes_weights_ready_once(monkeypatch):
    """Scoring brings the outputs' weights into shape once, not for each window and block."""
    shape, calls = gru.Shape(70), []
    p = gru.initial(shape, np.ones(70), np.ones(gru.TAILS))
    plain = gru._weights
    monkeypatch.setattr(gru, "_weights", lambda *args: calls.append(1) or plain(*args))
    gru.score_documents(p, shape, [np.arange(50_000, dtype=np.int32) % 70])
    assert len(calls) == 2


def test_lm_shares_go_to_a_task_each(spark, monkeypatch):
    """No task trains two shares, one behind the other, while another has none."""
    monkeypatch.setattr(lm, "SHARE", 100)
    rows = spark.range(2000).select(F.xxhash64("id").alias("hash"), F.col("id").cast("string").alias("text"))
    got = lm._shares(rows, 4000).groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("share").alias("n")).collect()
    assert len(got) == 40 and all(r.n == 1 for r in got)


def test_lm_ids_of_words(spark):
    """Frequent words have ids of their own, by count and then by name; all others that of their ending."""
    words = [f"w{i % (i // 7 + 1)}" for i in range(20_000)] + [f"x{i}" for i in range(1500)]
    v = lm.vocabulary(lm.count_words(docs(spark, list(enumerate(words))), "text"))
    counts = Counter(w.encode() for w in words) + Counter({lm.END: len(words)})
    order = sorted(counts, key=lambda w: (-counts[w], w))
    assert v.words.to_pylist() == order and (v.tokens, v.types) == (2 * len(words), len(counts))
    assert v.shape.head == 1024 < len(order) and v.head_counts.tolist() == [counts[w] for w in order[:1024]]
    assert np.allclose(v.log_count, [*(np.log10(counts[w] + 1) for w in order), 0])
    names = [*order[1020:1030], b"unseen", lm.END, b""]
    place = lm._places(pa.array(names, pa.binary()), v.words)
    assert place.tolist() == [order.index(w) if w in order else -1 for w in names]
    wanted = [order.index(w) if w in order[:1024] else 1024 + lm.tail_class(w) for w in names]
    for known in (None, place):
        assert lm._ids(v, pa.array(names, pa.binary()), known).tolist() == wanted
    tails = Counter(lm.tail_class(w) for w in order[1024:])
    assert v.tail_types.tolist() == [tails[k] for k in range(gru.TAILS)]


def test_lm_tail_classes():
    words = [b"", b"a", b"\xff", b"ab", b"", b"word", "ü".encode(), b"\n"]
    for some in (words, [], [b""]):
        got = lm.tail_classes(pa.array([b"skipped", *some], pa.binary()).slice(1))
        assert got.tolist() == [lm.tail_class(w) for w in some]


# Language ID


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "▁a", "ab", "aba"]
    lattice = language.Lattice(pieces)
    p = np.array([0.1, 0.2, 0.15, 0.05, 0.3, 0.1, 0.0, 0.1])

    def brute(word):
        if not word:
            return 1.0
        total = 0.0
        for k in range(1, len(word) + 1):
            i = pieces.index(word[:k]) if word[:k] in pieces else (lattice.unknown if k == 1 else None)
            if i is not None:
                total += p[i] * brute(word[k:])
        return total

    for word in ("▁aba", "▁abx", "▁b"):
        assert language.forward(lattice.index([word]), p)[0, -1] == pytest.approx(brute(word))
    models = language.Models(["x"], pieces, np.log(np.delete(p, lattice.absent))[:, None], np.zeros(1))
    scorer = language.Scorer(models)
    assert scorer.long_word("▁abx")[0] == pytest.approx(np.log(brute("▁abx")))


def test_long_words_are_fitted_like_short_ones():
    rng = np.random.default_rng(8)
    pieces = ["▁", "▁a", "a", "b", "ab", "aba", "bb"]
    lattice = language.Lattice(pieces)
    p = np.array([0.1, 0.2, 0.15, 0.05, 0.3, 0.1, 0.1, 0.0, 0.1])
    words = ["▁" + "".join(rng.choice(list("abx"), n)) for n in (30, 17, 17, 4, 1)]
    counts = np.array([1.0, 2, 3, 4, 5])
    want = np.zeros(len(p))
    for w, n in zip(words, counts, strict=True):
        index = lattice.index([w])
        front, back = language.forward(index, p)[0], language._backward(index, p)[0]
        for end in range(1, len(w) + 1):
            for k in range(1, min(end, lattice.longest) + 1):
                i = index[0, end - 1, k - 1]
                want[i] += n * front[end - k] * p[i] * back[end] / front[-1]
    assert language._expected_long(lattice, words, counts, p) == pytest.approx(want)
    far = language._expected_long(lattice, ["▁" + "abx" * 5_000], np.ones(1), p)
    assert np.isfinite(far).all() and far[lattice.unknown] == pytest.approx(5_000)


def test_languages_without_spaces_are_told_apart():
    rng = np.random.default_rng(9)
    pieces = ["▁", *"abcd", "ab", "ba", "cd", "dc"]

    def line(letters):
        return "".join(rng.choice(list(letters), 80))

    fitted = [language.fit(["▁" + line(x) for _ in range(40)], np.ones(40, np.int64), pieces) for x in ("aaab", "cccd")]
    scorer = language.Scorer(language.Models(["x", "y"], pieces, np.array(fitted).T, np.log([0.5, 0.5])))
    best, score = scorer([line("aaab"), line("cccd")])
    assert best == [0, 1] and min(score) > 0.99


def test_all_pieces_of_the_vocabulary_are_used():
    pieces = language.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert "translation" in pieces and "▁information" in pieces and len(pieces) > 31_700


def test_signs_for_numbers_are_no_letters():
    assert not any(map(language.has_letter, (None, "", "½ ² ① 12 _ 三"[:-1], "٣ ... !")))
    assert all(map(language.has_letter, ("½ a", "三", "ß", "12é")))


def test_long_lines_are_fitted_in_runs(monkeypatch):
    rng = np.random.default_rng(10)
    pieces = ["▁", *"ab", "ab", "ba", "aab"]
    line = "▁" + "".join(rng.choice(list("ab"), 6000))
    whole = language.fit([line, "▁ab"], np.array([1, 2]), pieces)
    monkeypatch.setattr(language, "RUN", 512)
    assert language.fit([line, "▁ab"], np.array([1, 2]), pieces) == pytest.approx(whole, abs=0.05)


def test_languages_beyond_the_bound_teach_nothing(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGS", 2)
    rows = [(i, w, x, 1) for i, (w, x) in enumerate([("aaa", "x")] * 9 + [("bbb", "y")] * 8 + [("ccc", "z")])]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    models = language.fit_models(table, "text", "lang", F.xxhash64("doc_id"), ["▁", "a", "b", "c"])
    assert models.langs == ["x", "y"]


def test_language_query_against_a_plain_forward_pass(spark, corpus):
    path = public_tokenizers.path("piece_bpe_32k.model")
    order = F.xxhash64(F.col("doc_id").cast("string"))
    models = language.fit_models(corpus, "text", "lang", order, language.load_pieces(path))
    lattice = language.Lattice(models.pieces)
    p = np.exp(models.log_p)
    for r in language.predict(corpus.limit(15).select("doc_id", "text"), "text", models).collect():
        total = models.log_prior.copy()
        for word in language.words_of(r.row.text[:400]):
            alpha = [np.ones(len(models.langs))]
            for end in range(1, len(word) + 1):
                ways = [p[-1] * alpha[end - 1]] if word[end - 1] not in lattice.ids else []
                ways += [p[lattice.ids[word[at:end]]] * alpha[at] for at in range(end) if word[at:end] in lattice.ids]
                alpha.append(sum(ways))
            total += np.log(alpha[-1])
        scorer = language.Scorer(models)
        best, score = scorer([r.row.text[:400]])
        assert best[0] == int(total.argmax())
        assert score[0] == pytest.approx(1 / np.exp(total - total.max()).sum(), rel=1e-6)


def test_language_held_out_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(table, "doc_id", "text", "lang", public_tokenizers.path("piece_bpe_32k.model"))
    got = got.select("row.doc_id", "held_out", "lang_pred", "score").join(table, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) > 0.98 * len(held)


def test_language_odd_rows(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(i, t, "en" if i != 5 else None, 1) for i, t in [*ODD, (7, "12 ?"), (8, "ein wort")]]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    got = {r.row.doc_id: r for r in language.identify(table, "doc_id", "text", "lang", path).collect()}
    assert {got[i].lang_pred for i in (1, 2, 3, 7)} == {"und"} and got[1].score == 0
    assert got[5].lang_pred == got[8].lang_pred == "en"
    assert language.identify(table.limit(0), "doc_id", "text", "lang", path).count() == 0
    unlabelled = table.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled, "doc_id", "text", "lang", path).collect()} == {"und"}


# Line dedup


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 20_000).astype(np.uint64))
    table = linedup.PerfectHash.build(keys)
    assert sorted(table.index(keys)) == list(range(len(keys)))
    assert linedup.PerfectHash.build(keys[:0]).index(keys[:5]).tolist() == [-1] * 5


def test_lines(spark):
    long = "A line that many of the documents share, word for word."
    rows = [(i, f"  {long.upper()}\t\nown {i}" if i % 2 else f"own {i}\n{long}") for i in range(8)]
    rows += [(8, long + "\n" + long), (9, "short\nshort"), *((20 + i, "short") for i in range(6))]
    got = {r.row.doc_id: r for r in linedup.dedup_lines(docs(spark, rows), "doc_id", "text").collect()}
    assert [got[i].n_dropped for i in range(9)] == [1] * 8 + [0]
    assert got[1].kept_text == "own 1" and got[0].kept_text == "own 0" and got[8].n_lines == 2
    assert got[9].n_dropped == got[25].n_dropped == 0
    few = linedup.dedup_lines(docs(spark, rows[:4]), "doc_id", "text").collect()
    assert {r.n_dropped for r in few} == {0}


def test_lines_odd_rows(spark):
    long = "x" * 39 + "é"
    rows = [*ODD, *[(None, long)] * 3, *[(9, long)] * 3, *((10 + i, long) for i in range(3))]
    got = linedup.dedup_lines(docs(spark, rows), "doc_id", "text").collect()
    assert len(got) == len(rows)
    # Four ids and the null rows are five documents; the largest keeps the line.
    assert sorted((r.row.doc_id or -1, r.n_dropped) for r in got if r.row.text == long) == [
        (-1, 1)] * 3 + [(9, 1)] * 3 + [(10, 1), (11, 1), (12, 0)]
    assert {r.n_lines for r in got if r.row.doc_id in (1, 2)} == {1}
    assert linedup.dedup_lines(docs(spark, []), "doc_id", "text").count() == 0


# SimHash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(ids, near):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in near:
        parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[root(i)].append(ids[i])
    return {i: min((x for x in g if x is not None), default=None) for g in groups.values() for i in g}


def test_simhash_against_brute_force(spark, corpus):
    got = simhash.near_duplicates(corpus, "doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in corpus.collect()}
    fps = [brute_fingerprint(texts[r.doc_id]) for r in got]
    assert [r.fp & (2**64 - 1) for r in got] == fps
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    want = brute_components([r.doc_id for r in got], near)
    assert {r.doc_id: r.component_id for r in got} == want


def test_simhash_links_random_codes(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63, 60)
    fps = np.unique(np.concatenate([base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (20, 2))]))
    table = spark.createDataFrame([(int(x),) for x in fps], "fp bigint")
    for parts in (2, 4, 8):
        roots = dict(map(tuple, components.components(simhash.links(table, 2, parts)).collect()))
        codes = fps.view(np.uint64)
        near = np.argwhere(np.bitwise_count(codes[:, None] ^ codes) <= 2)
        want = brute_components(fps.tolist(), near.tolist())
        assert {x: roots.get(x, x) for x in fps.tolist()} == want


def test_simhash_odd_rows(spark):
    got = simhash.near_duplicates(docs(spark, ODD), "doc_id", "text").collect()
    assert len(got) == 7
    by = {r.doc_id: r for r in got}
    assert by[1].fp == by[2].fp == 0 and by[3].component_id == 1
    assert simhash.near_duplicates(docs(spark, []), "doc_id", "text").count() == 0
    one = simhash.near_duplicates(docs(spark, [(None, "a b c d")]), "doc_id", "text").collect()
    assert one[0].component_id is None


def test_simhash_links_across_chunks_of_a_tile(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 4)
    rng = np.random.default_rng(11)
    base = rng.integers(-(2**63), 2**63, 12)
    fps = np.unique(np.concatenate([base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (15, 2))]))
    table = spark.createDataFrame([(int(x),) for x in fps], "fp bigint")
    roots = dict(map(tuple, components.components(simhash.links(table, 2, 2)).collect()))
    codes = fps.view(np.uint64)
    near = np.argwhere(np.bitwise_count(codes[:, None] ^ codes) <= 2)
    want = brute_components(fps.tolist(), near.tolist())
    assert {x: roots.get(x, x) for x in fps.tolist()} == want


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1500)]
    edges = spark.createDataFrame(path + star, "u bigint, v bigint")
    got = dict(map(tuple, components.components(edges).collect()))
    assert set(got.values()) == {0, 1000} and len(got) == 200 + 499


# Nearest neighbours


def test_index_finds_every_code_in_the_radius():
    rng = np.random.default_rng(7)
    codes = rng.integers(0, 256, (500, 8)).astype(np.uint8)
    index = hashing_index.Index(codes)
    for radius in (0, 5, 17, 24, 29, 64):
        for code in codes[:20]:
            want = np.flatnonzero(np.bitwise_count(codes ^ code).sum(axis=1) <= radius)
            assert index.within(code, radius).tolist() == want.tolist()


def test_neighbours_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = defaultdict(list)
    for r in hashing_index.nearest(table, "vec_id", "embedding", F.col("vec_id") % 50 == 0, 5).orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    rows = table.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in ids[ids % 50 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -2
        top = np.lexsort((ids, -s))[:5]
        hits += len({v for v, _ in got[q]} & set(ids[top].tolist()))
        score = dict(zip(ids.tolist(), s, strict=True))
        assert all(v == pytest.approx(score[i]) for i, v in got[q])
        assert [v for _, v in got[q]] == sorted((v for _, v in got[q]), reverse=True)
    assert hits >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_neighbours_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [3.0, 0.0]), (50, [1.0, 0.0, 0.0]), (9, []), (None, [1.0, 0.0]),
    ]
    table = spark.createDataFrame([(*r, "q", 1) for r in rows], "vec_id bigint, v array<double>, query_id string, rank int")
    got = hashing_index.nearest(table, "vec_id", "v", F.col("vec_id") % 50 == 0, 3)
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in got.collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 8, 1.0), (0, 3, None, 1.0)]
    assert hashing_index.nearest(table.limit(0), "vec_id", "v", F.col("vec_id") % 50 == 0, 3).count() == 0


# Packing


@pytest.mark.parametrize("kept", [packing.MOST_PARTS, 40])
def test_packing_round_trip(spark, corpus, monkeypatch, kept):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "MOST_PARTS", kept)
    monkeypatch.setattr(packing, "SLICE", 7)
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = [(r.doc_id, r.text) for r in corpus.limit(60).collect()]
    rows += [(999, " a \x1c b\x0bC\x0cd,\r\n\te.. ÀÉ!? x,y 1.5\u00a0z "), (1000, "it's <|endoftext|>x y ́a\n\tÉÀ Σς"), *[(2000 + i, t) for i, (_, t) in enumerate(ODD)]]
    pieces = defaultdict(list)
    got = packing.pack(docs(spark, rows), "doc_id", "text", path).collect()
    for r in got:
        pieces[r.doc_id].append(r)
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0
        assert len(r.ids) == 4 * r.length
    assert len({r.sequence_id for r in got}) == len(got)
    for i, text in rows:
        want = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        parts = sorted(pieces[i], key=lambda r: r.start)
        assert b"".join(r.ids for r in parts) == want
        assert {r.doc_tokens for r in parts} == {len(want) // 4}
    assert packing.pack(docs(spark, []), "doc_id", "text", path).count() == 0


def test_lengths():
    assert packing.lengths(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1] and packing.lengths(1, 4096) == [1]
