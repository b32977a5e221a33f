"""Language-model scoring of whole documents.

Words are counted over all training documents. The most frequent words get their
own outputs in the recurrent model of ``gru``; all others share tail classes,
inside which their counts decide, so every word has a probability and unseen
words have one count. Training starts from the unigram model: a first model is
trained in one task on ``WARM_TOKENS`` tokens, then one model goes on from it over
each share of the training documents, and the weights are averaged by tokens.
That pass covers all training documents; weights have a fixed size. A hash of id
and text deals documents into shares of about ``SHARE`` tokens and orders them, so
the result does not depend on how the table is partitioned. Rows that occur more
than ``EQUAL`` times are spread over all shares; the first model sees each row once.

Scoring is one pass over all documents. Counts of frequent words travel with the
model (``DICTIONARY`` words at most); rarer words leave the pass as counts per
document and meet the word counts in a join.

Defined cases: a null text is empty and consists of the end token; a null id is
in training; equal rows get equal scores; without training documents every token
is unseen; no rows give none. Texts of any length are scored in whole, the state
runs from the first token to the end. Columns are taken by the given names only.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DoubleType, LongType, StructField, StructType,
)

from loreweave.llm import gru
from loreweave.llm.batches import runs
from loreweave.llm.text import held_out
from loreweave.operators.ranking import keep_first
from loreweave.sources.staging import stage

#: Tokens of the first model, and words whose counts travel with the model.
WARM_TOKENS = 400_000
DICTIONARY = 400_000
#: Characters scored together: the longest document sets the number of steps, so
#: more documents beside it cost little.
SCORED = 8_000_000
#: Tokens per share of the training documents, bytes trained on at a time, and equal
#: rows that stay in one share.
SHARE, STREAM, EQUAL = 1_500_000, 4_000_000, 10_000
#: Pieces that weights are averaged in.
SLOTS = 64
END = b"\n"


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words, with A-Z lower-cased, the texts' tokens as places among them, and where each text ends.

    The last word is the end, which no word can equal; each text has it once.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = split.flatten().dictionary_encode()
    names, place = coded.dictionary, coded.indices.to_numpy()
    real = np.append(pc.binary_length(names).to_numpy() > 0, True)[place]  # white space at an end leaves an empty word
    upto = np.concatenate([[0], np.cumsum(real, dtype=np.int32)])[split.offsets.to_numpy()]
    ends = upto[1:] + np.arange(1, len(texts) + 1)
    tokens = _with_marks(place[real], ends - 1, len(names), np.int64)
    return pa.concat_arrays([names.cast(pa.binary()), pa.array([END], pa.binary())]), tokens, ends


def _with_marks(values: np.ndarray, at: np.ndarray, mark: int, kind: type) -> np.ndarray:
    """``values`` with ``mark`` put in, at the places ``at`` of the result."""
    out, own = np.full(len(values) + len(at), mark, kind), np.ones(len(values) + len(at), bool)
    own[at] = False
    out[own] = values
    return out


def tail_class(word: bytes) -> int:
    """Tail words are classed by their ending."""
    return zlib.crc32(word[-2:]) % gru.TAILS


@functools.cache
def _classes_of_endings() -> tuple[np.ndarray, np.ndarray]:
    """``tail_class`` of each last byte, for words of one byte, and of each pair of last bytes."""
    one = [tail_class(bytes([b])) for b in range(256)]
    return np.array(one, np.int32), np.array([tail_class(bytes(pair)) for pair in itertools.product(range(256), repeat=2)], np.int32)


def tail_classes(words: pa.Array) -> np.ndarray:
    """``tail_class`` of each of some binary words."""
    one, two = _classes_of_endings()
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    sizes, out = np.diff(ends), np.full(len(words), tail_class(b""), np.int32)
    if data:
        data = np.frombuffer(data, np.uint8)
        for least, of in ((1, one), (2, two)):
            some = np.flatnonzero(sizes >= least)
            last = data[ends[1:][some] - 1]
            out[some] = of[last if least == 1 else data[ends[1:][some] - 2].astype(np.int32) * 256 + last]
    return out


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """``word, tail, n`` over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in runs(batch.column(0)):
                words, tokens, _ = tokens_of(texts)
                counts = np.bincount(tokens, minlength=len(words))
                words, counts = words.take(pa.array(np.flatnonzero(counts))), counts[counts > 0]
                tails = pa.array(tail_classes(words))
                yield pa.RecordBatch.from_arrays([words, tails, pa.array(counts)], ["word", "tail", "n"])

    counted = docs.select(text_col).mapInArrow(run, "word binary, tail int, n bigint")
    return counted.groupBy("word", "tail").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What a task knows of the words: names and counts of frequent ones, totals of the rest."""

    shape: gru.Shape
    words: pa.Array  # by count
    log_count: np.ndarray  # log10(count + 1), by place
    tokens: int
    types: int
    tail_tokens: np.ndarray
    tail_types: np.ndarray
    head_counts: np.ndarray


def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """The place of each word, -1 for none."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy()


def _ids(v: Vocabulary, words: pa.Array, place: np.ndarray | None = None) -> np.ndarray:
    """The token id of each word; ``place`` is its place in the dictionary, if known."""
    if place is None:
        place = _places(words, v.words.slice(0, v.shape.head))
    return np.where((place >= 0) & (place < v.shape.head), place, v.shape.head + tail_classes(words))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, and the words above the count that at most ``DICTIONARY`` words reach.

    The count is read off a histogram with sixteen bars per power of two.
    """
    bar = F.floor(F.log2("n") * 16)
    bars = sorted(((r["bar"], r["k"]) for r in counts.groupBy(bar.alias("bar")).agg(F.count("*").alias("k")).collect()),
                  reverse=True)
    least, used = None, 0
    for at, k in bars:
        if used + k > DICTIONARY:
            break
        least, used = at, used + k
    frequent = counts.filter(F.lit(False) if least is None else bar >= least).select("word", "n").toArrow()
    frequent = frequent.sort_by([("n", "descending"), ("word", "ascending")])
    words, often = frequent["word"].cast(pa.binary()).combine_chunks(), frequent["n"].to_numpy()
    if not len(words):
        words, often = pa.array([END], pa.binary()), np.zeros(1, np.int64)
    totals = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    tail_tokens, tail_types = np.zeros(gru.TAILS), np.zeros(gru.TAILS)
    for r in totals:
        tail_tokens[r["tail"]], tail_types[r["tail"]] = r["n"], r["k"]
    tokens, types = int(tail_tokens.sum()), int(tail_types.sum())
    shape = gru.Shape(min(gru.HEAD, len(words)))
    head, tails = often[: shape.head], tail_classes(words.slice(0, shape.head))
    tail_tokens -= np.bincount(tails, head, gru.TAILS)
    tail_types -= np.bincount(tails, head > 0, gru.TAILS)
    return Vocabulary(
        shape, words, np.log10(np.append(often, 0) + 1.0), tokens, types, tail_tokens, tail_types, head.astype(float)
    )


def _train(docs: DataFrame, vocab, model, most: int | None = None) -> DataFrame:
    """``share, slot, weight, values``: the weights that each share ends with, times its tokens.

    ``docs`` has ``share, text`` with a share's rows behind each other.
    """

    def result(trainer: gru.Trainer, seen: int, share: int) -> pa.RecordBatch:
        values = np.array_split(gru.flat(trainer.p) * np.float32(seen), SLOTS)
        return pa.RecordBatch.from_arrays(
            [pa.array([share] * SLOTS, pa.int64()), pa.array(range(SLOTS), pa.int32()), pa.array([float(seen)] * SLOTS),
             pa.array([x.astype("<f4").tobytes() for x in values], pa.binary())],
            ["share", "slot", "weight", "values"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, start = vocab.value, model.value
        shape = (32, 16) if most else (gru.LANES, gru.WINDOW)
        trainer, seen, share, held, size = None, 0, None, [], 0

        def learn() -> None:
            nonlocal seen, held, size
            if held and not (most and seen >= most):
                words, tokens, ends = tokens_of(pa.concat_arrays(held))
                starts = np.concatenate([[0], ends[:-1]]) + np.arange(len(ends))
                stream = _with_marks(_ids(v, words)[tokens], starts, v.shape.start, np.int32)
                seen += len(stream)
                trainer.stream(stream, *shape)
            held, size = [], 0

        for batch in batches:
            shares = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shares)) + 1).tolist(), len(shares)]
            for a, b in itertools.pairwise(cuts):
                if a == b:
                    continue
                if shares[a] != share:
                    if trainer:
                        learn()
                        yield result(trainer, seen, share)
                    trainer, seen, share = gru.Trainer(start, v.shape), 0, int(shares[a])
                # Texts are streamed in runs of a fixed size, however they arrive.
                texts = batch.column(1).slice(a, b - a)
                upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64) + 1)
                at = 0
                while at < len(texts):
                    before = upto[at - 1] if at else 0
                    end = min(int(np.searchsorted(upto, before + STREAM - size)) + 1, len(texts))
                    held.append(texts.slice(at, end - at))
                    size += int(upto[end - 1] - before)
                    at = end
                    if size >= STREAM:
                        learn()
        if trainer:
            learn()
            yield result(trainer, seen, share)

    return docs.select("share", "text").mapInArrow(run, "share long, slot int, weight double, values binary")


def _averaged(parts: DataFrame, like: gru.Params) -> gru.Params:
    """Sums each slot where it lies, batch by batch, and gathers one row per slot."""
    out = "slot int, weight double, values binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                values = np.frombuffer(row["values"], "<f4").astype(np.float64)
                total = sums.setdefault(row["slot"], [0.0, np.zeros_like(values)])
                total[0] += row["weight"]
                total[1] += values
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([w for w, _ in sums.values()]),
                 pa.array([x.tobytes() for _, x in sums.values()], pa.binary())],
                ["slot", "weight", "values"],
            )

    dealt = parts.repartition("slot").sortWithinPartitions("slot", "share").select("slot", "weight", "values")
    rows = sorted(dealt.mapInArrow(run, out).collect(), key=lambda r: r["slot"])
    if not rows:
        return like
    return gru.unflat(np.concatenate([np.frombuffer(r["values"], "<f8") / r["weight"] for r in rows]), like)


def _shares(docs: DataFrame, tokens: int) -> DataFrame:
    """``share, text`` of ``hash, text``, each share in the order of the hash."""
    shares = -(-max(1, tokens) // SHARE)
    equal = docs.groupBy(F.col("hash").alias("same")).agg(F.count("*").alias("n")).filter(F.col("n") > EQUAL)
    equal = stage(equal, "equal")
    dealt = docs.withColumn("share", F.pmod("hash", F.lit(shares)))
    if not equal.isEmpty():
        same = F.col("hash") == F.col("same")
        one = keep_first(docs.join(equal, same).drop("same"), ["hash"], F.col("text"))
        one = one.withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint"))))
        times = F.expr(f"cast(n div {shares} + if(share < n % {shares}, 1, 0) as int)")
        one = one.withColumn("copy", F.explode(F.array_repeat(F.lit(0), times))).drop("n", "copy")
        dealt = dealt.join(equal, same, "left_anti").unionByName(one)
    return dealt.repartitionById(shares, F.col("share").cast("int")).sortWithinPartitions("share", "hash")


def train(docs: DataFrame, vocab, tokens: int) -> gru.Params:
    """The model of all ``doc_id, text``; ``vocab`` is a broadcast vocabulary."""
    sc, v = docs.sparkSession.sparkContext, vocab.value
    docs = docs.select(F.xxhash64("doc_id", "text").alias("hash"), "text")
    first = gru.initial(v.shape, v.head_counts, v.tail_tokens)
    part = min(1.0, 2 * WARM_TOKENS / max(1, tokens))
    some = docs.filter(F.pmod("hash", F.lit(1_000_003)) < int(part * 1_000_003) + 1)
    some = keep_first(some, ["hash"], F.col("text")).withColumn("share", F.lit(0).cast("bigint"))
    some = some.repartition(1).sortWithinPartitions("hash")
    warm = _averaged(_train(some, vocab, sc.broadcast(first), WARM_TOKENS), first)
    return _averaged(_train(_shares(docs, tokens), vocab, sc.broadcast(warm)), warm)


def score(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = held_out(F.col("doc_id"), 7, 2)
    training = docs.filter(~out)
    counts = stage(count_words(training, "text"), "words")
    v = vocabulary(counts)
    vocab = sc.broadcast(v)
    model = sc.broadcast(train(training, vocab, v.tokens))
    passed = _score(docs.select("doc_id", "text", out.alias("held_out")), vocab, model)
    passed = stage(passed.withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = passed.select("row", F.inline("rare")).join(counts.select("word", F.col("n").alias("c")), "word")
    found = rare.groupBy("row").agg(
        F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more")
    )
    more = F.coalesce("more", F.lit(0.0))
    return passed.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        (F.col("counts") + more - F.col("n_tokens") * float(np.log10(v.tokens + v.types + 1))).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )


def _score(docs: DataFrame, vocab, model) -> DataFrame:
    """What one pass can tell, and each document's words that are not in the dictionary."""
    word = StructType([StructField("word", BinaryType()), StructField("n", LongType())])
    out = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("held_out", BooleanType()),
        StructField("n_tokens", LongType()), StructField("known", LongType()), StructField("counts", DoubleType()),
        StructField("model", DoubleType()), StructField("rare", ArrayType(word)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, p = vocab.value, model.value
        # By token id: the share of one count in a tail class; frequent words need none.
        one = np.zeros(v.shape.start + 1)
        one[v.shape.head : v.shape.start] = -np.log10(v.tail_tokens + v.tail_types + 1)
        for batch in batches:
            at = 0
            for texts in runs(batch.column(1), SCORED):
                words, tokens, ends = tokens_of(texts)
                place = _places(words, v.words)
                ids = _ids(v, words, place)
                logs = v.log_count[place]
                inside = one[ids] + np.where(ids >= v.shape.head, logs, 0)
                starts = np.concatenate([[0], ends[:-1]])
                # Words outside the dictionary, by text.
                away = np.flatnonzero(place[tokens] < 0)
                owner = np.searchsorted(ends, away, "right")
                keys, often = np.unique(owner * len(words) + tokens[away], return_counts=True)
                rare = words.take(pa.array(keys % len(words)))
                listed = np.searchsorted(keys, np.arange(len(ends) + 1) * len(words)).astype(np.int32)
                rare = pa.StructArray.from_arrays([rare, pa.array(often, pa.int64())], ["word", "n"])
                found = gru.score_documents(p, v.shape, np.split(ids[tokens], ends[:-1])) / np.log(10)
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(np.diff(ends, prepend=0)),
                     pa.array(np.add.reduceat((logs > 0)[tokens], starts, dtype=np.int64)),
                     pa.array(np.add.reduceat(logs[tokens], starts)),
                     pa.array(found + np.add.reduceat(inside[tokens], starts)),
                     pa.ListArray.from_arrays(pa.array(listed), rare)],
                    ["doc_id", "held_out", "n_tokens", "known", "counts", "model", "rare"],
                )

    return docs.mapInArrow(run, out)
