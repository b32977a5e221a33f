"""Ranked lexical search with bag deduplication: the best documents for each item of a query table.

Documents are cut down to the words of the items. What is left of a document is a
bag, its counts of these words, and a number ``m`` that stands for its length.
Documents with the same bag and the same ``m`` have the same score for every item,
so they form a class: found by a hash, told apart by the bag itself. Classes are
scored once; each task adds the parts of the words that items and classes share,
block by block, and answers with the best classes per item. Only classes that can
reach the result are expanded into their documents, by ascending id.

Items are sent in blocks of bounded size to all documents, which stay where they
are; word counts cover all documents.

Defined cases: a null text has no words; documents without words count for nothing;
items without words get no rows, nor do words that no document has; rows of equal
id are documents (or items) of their own; a null document id ranks last among equal
scores; the same item id twice gives two lists; no rows give none. Only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from loreweave.llm.batches import slices
from loreweave.operators.ranking import top_k
from loreweave.sources.staging import stage

#: Items and different words per block of items; one item may have more words.
ITEMS, WORDS = 1_024, 200_000
#: Pairs of a class's word and an item that has it, handled at a time.
PAIRS = 2_000_000

#: Letters, digits and all bytes above 0x7F make words; A-Z are lower-cased.
_TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


def bags(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """``doc_id, n, bag``: all words counted, and pairs of word number and count in the order of the numbers.

    ``vocabulary`` is a broadcast dictionary from word to number.
    """
    out = StructType([
        StructField("doc_id", docs.schema[id_col].dataType), StructField("n", LongType()), StructField("bag", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(vocabulary.value)
        size = len(places) + 1
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                words = [words_of(t) for t in texts]
                n = np.array([len(w) for w in words], np.int64)
                found = np.fromiter((places[w] for each in words for w in each), np.int64, n.sum())
                owner = np.repeat(np.arange(len(texts)), n)
                keys, counts = np.unique((owner * size + found)[found >= 0], return_counts=True)
                pairs = np.column_stack([keys % size, counts]).astype("<u4")
                ends = np.searchsorted(keys, np.arange(len(texts) + 1) * size).astype(np.int32) * 8
                bag = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(pairs.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(n), bag], out.names)
                at += len(texts)

    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(run, out)


def _frequencies(classes: DataFrame, size: int) -> np.ndarray:
    """In how many documents each word stands, from ``bag, docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            docs = batch.column(1).to_numpy()
            for bag, n in zip(batch.column(0).to_pylist(), docs, strict=True):
                total[np.frombuffer(bag, "<u4")[::2]] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["word", "df"])

    found = classes.select("bag", "docs").mapInArrow(run, "word bigint, df bigint").groupBy("word").agg(F.sum("df").alias("df"))
    df = np.zeros(size, np.int64)
    for r in found.collect():
        df[r["word"]] = r["df"]
    return df


class Postings:
    """The items that each word stands in, and the words' weights; items go by their place in the block."""

    def __init__(self, numbers: list[int], items: list[list[int]], weights: np.ndarray) -> None:
        words = np.concatenate([np.array(i, np.int64) for i in items])
        owner = np.repeat(np.arange(len(items)), [len(i) for i in items])
        self.items = owner[np.argsort(words, kind="stable")]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(words, minlength=len(weights)))])
        self.weights, self.n, self.numbers = weights, len(items), np.array(numbers, np.int64)


def scores(postings: Postings, bags: list[bytes], m: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """First class and ``[class, item]`` scores of runs of classes; all sums are of whole numbers."""
    sizes = np.array([len(b) // 8 for b in bags], np.int64)
    pairs = np.frombuffer(b"".join(bags), "<u4").reshape(-1, 2).astype(np.int64)
    word, tf = pairs[:, 0], pairs[:, 1]
    times = postings.starts[word + 1] - postings.starts[word]
    part = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes)) * postings.weights[word]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    work = np.concatenate([[0], np.cumsum(times)])[ends]
    first = 0
    while first < len(bags):
        last = max(first + 1, int(np.searchsorted(work, work[first] + PAIRS, "right")) - 1)
        last = min(last, first + max(1, PAIRS // postings.n))
        here = slice(ends[first], ends[last])
        each = np.repeat(np.arange(ends[last] - ends[first]), times[here])
        offset = np.arange(len(each)) - np.repeat(np.cumsum(times[here]) - times[here], times[here])
        item = postings.items[postings.starts[word[here]][each] + offset]
        owner = np.repeat(np.arange(last - first), sizes[first:last])[each]
        cell, value = owner * postings.n + item, part[here][each]
        # Two sums of doubles that are exact, from the upper and the lower bits.
        size = (last - first) * postings.n
        high = np.bincount(cell, value >> 26, size).astype(np.int64)
        low = np.bincount(cell, value & ((1 << 26) - 1), size).astype(np.int64)
        yield first, ((high << 26) + low).reshape(-1, postings.n)
        first = last


def _best(found: list[pa.Table], most: int) -> pa.Table:
    """The first rows of each item by score and first id."""
    rows = pa.concat_tables(found)
    keys = [("item", "ascending"), ("score", "descending"), ("first", "ascending")]
    rows = rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_end"))
    item = rows["item"].to_numpy()
    return rows.filter(pa.array(np.arange(len(item)) - np.searchsorted(item, item) < most))


def _ranked(classes: DataFrame, postings, most: int) -> DataFrame:
    """``item, class, score, first, docs`` of the best classes of each task."""
    out = StructType([
        StructField("item", LongType()), StructField("class", LongType()), StructField("score", LongType()),
        StructField("first", classes.schema["first"].dataType), StructField("docs", LongType()),
    ])
    kept = classes.select("class", "first", "docs", "bag", "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = postings.value
        floor, held, pending = np.ones(p.n, np.int64), None, []
        for batch in batches:
            for start, score in scores(p, batch.column(3).to_pylist(), batch.column(4).to_numpy()):
                row, item = np.nonzero(score >= floor)
                at = pa.array(start + row)
                pending.append(pa.table({
                    "item": item, "class": batch.column(0).take(at), "score": score[row, item],
                    "first": batch.column(1).take(at), "docs": batch.column(2).take(at),
                }))
                if sum(map(len, pending)) > 20 * most * p.n:
                    held, pending = _best([*([held] if held else []), *pending], most), []
                    items, counts = np.unique(held["item"].to_numpy(), return_counts=True)
                    full = counts >= most
                    floor[items[full]] = held["score"].to_numpy()[np.cumsum(counts)[full] - 1]
        if held or pending:
            last = _best([*([held] if held else []), *pending], most)
            named = last.set_column(0, "item", pa.array(p.numbers[last["item"].to_numpy()]))
            yield from named.combine_chunks().to_batches()

    return kept.mapInArrow(run, out)


def _block(docs: DataFrame, id_col: str, text_col: str, items: list[tuple[int, list[bytes]]], most: int) -> DataFrame | None:
    """``item, rank, doc_id, score`` for items given as number and words."""
    sc = docs.sparkSession.sparkContext
    number = {w: i for i, w in enumerate(sorted({w for _, words in items for w in words}))}
    vocabulary = sc.broadcast(number)
    rows = stage(bags(docs, id_col, text_col, vocabulary).filter("n > 0"), "bags")
    total = rows.agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    if not total["docs"]:
        return None
    wide = "decimal(38,0)"
    m = 50 + F.expr(f"(cast(50 * n as {wide}) * cast({total['docs']} as {wide})) div cast({total['words']} as {wide})")
    rows = rows.filter(F.octet_length("bag") > 0).withColumn("m", m.cast("bigint"))
    rows = rows.withColumn("hash", F.xxhash64("bag", "m"))
    classes = rows.groupBy("hash", "bag", "m").agg(F.min("doc_id").alias("first"), F.count("*").alias("docs"))
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    df = _frequencies(classes, len(number))
    n = total["docs"]
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(k) + 1))) if k else 0 for k in df], np.int64)
    listed = [[number[w] for w in words] for _, words in items]
    postings = sc.broadcast(Postings([i for i, _ in items], listed, weights))
    order = [F.col("score").desc(), F.col("first").asc_nulls_last(), F.col("class")]
    ranked = top_k(_ranked(classes, postings, most), ["item"], most, *order).drop("rank")
    # Classes behind enough documents of higher scores cannot be in the result.
    higher = Window.partitionBy("item").orderBy(F.col("score").desc()).rangeBetween(Window.unboundedPreceding, -1)
    ahead = F.sum(F.least("docs", F.lit(most))).over(higher)
    ranked = stage(ranked.withColumn("ahead", F.coalesce(ahead, F.lit(0))).filter(F.col("ahead") < most), "ranked")
    wanted = classes.join(ranked.select("class").distinct(), "class", "left_semi")
    wanted = wanted.select("class", *[F.col(c).alias("of_" + c) for c in ("hash", "bag", "m")])
    same = (F.col("hash") == F.col("of_hash")) & (F.col("bag") == F.col("of_bag")) & (F.col("m") == F.col("of_m"))
    members = top_k(rows.join(wanted, same).select("class", "doc_id"), ["class"], most, F.col("doc_id").asc_nulls_last())
    listed = ranked.select("item", "class", "score").join(members.drop("rank"), "class").drop("class")
    listed = top_k(listed, ["item"], most, F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = stage(listed.select("item", "rank", "doc_id", "score"), "found")
    for sent in (vocabulary, postings):
        sent.unpersist()
    return found


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items with their different words, in blocks, one block at a time on the driver."""
    part, words = [], set()
    for r in items.toLocalIterator():
        own = sorted(set(words_of(r["text"] and r["text"].encode())))
        if part and (len(part) >= ITEMS or len(words) + len(own) > WORDS):
            yield part
            part, words = [], set()
        if own:
            part.append((r["item"], own))
            words.update(own)
    if part:
        yield part


def search(
    docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, item_text_col: str, most: int = 50
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``most`` best documents with a score above 0 for each item."""
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    asked = stage(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    out = StructType([
        StructField("item", LongType()), StructField("rank", IntegerType()),
        StructField("doc_id", docs.schema[id_col].dataType), StructField("score", LongType()),
    ])
    found = docs.sparkSession.createDataFrame([], out)
    for block in _blocks(asked.select("item", "text")):
        part = _block(docs, id_col, text_col, block, most)
        if part is not None:
            found = found.unionByName(part)
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
