"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has a bit for each bit that over half of the text's shingle hashes
have set. Different fingerprints are dealt into tiles by the bit counts of their
parts. Two fingerprints within the radius have bit counts that differ by no more
than the radius, summed over the parts, so all other pairs of tiles are skipped;
tiles that remain are compared whole with exclusive-or and bit counts. A pair of
tiles gives the links of a spanning forest and not every pair, so a large group
costs no more links than members. Components join the forests.

With four parts about one pair of tiles in sixty remains; raise ``parts`` to 8 for
over a billion fingerprints.

Defined cases: a null text or one without words has fingerprint zero and links
like any other; a text of fewer words than a shingle is one shingle; equal rows
share a fingerprint; a null id never is a component's name unless all its ids
are null; no rows give none. Only the id and the text are read, so other columns
may have any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loreweave.llm.components import components
from loreweave.sources.staging import stage

TILE = 1024
BITS = 64


def fingerprint(text: str | None, size: int = 3, seed: int = 42, block: int = 1 << 15) -> int:
    """The signed 64-bit fingerprint of a text."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < size:
        words, size = [b" ".join(words)], 1
    n = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, block):
        part = words[at : at + min(block, n - at) + size - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False))
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, fp`` of every row."""
    out = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, out)


def _part_counts(fp: Column, parts: int) -> list[Column]:
    width = BITS // parts
    mask = (1 << width) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit(mask))) for k in range(parts)]


def _tile_key(counts: list[Column], width: int) -> Column:
    """The parts' bit counts as one number."""
    key = F.lit(0).cast("bigint")
    for c in counts:
        key = key * (width + 1) + c
    return key


def _steps(parts: int, radius: int, width: int) -> list[int]:
    """Differences of keys of tiles to compare, each pair of tiles from one side only."""
    found = set()
    for at in itertools.combinations_with_replacement(range(parts), radius):
        for signs in itertools.product((-1, 0, 1), repeat=radius):
            step = [0] * parts
            for k, s in zip(at, signs, strict=True):
                step[k] += s
            found.add(tuple(step))
    half = [s for s in found if s >= (0,) * parts]
    return sorted(sum(x * (width + 1) ** (parts - 1 - k) for k, x in enumerate(s)) for s in half)


def links(classes: DataFrame, radius: int = 2, parts: int = 4) -> DataFrame:
    """``u, v``: links between different fingerprints that connect all within ``radius`` bits.

    ``classes`` has each fingerprint once as ``fp``.
    """
    width = BITS // parts
    keyed = classes.select("fp", _tile_key(_part_counts(F.col("fp"), parts), width).alias("key"))
    chunks = keyed.groupBy("key").agg(F.ceil(F.count("*") / TILE).alias("chunks")).withColumnRenamed("key", "k")
    dealt = keyed.join(chunks, keyed["key"] == chunks["k"]).withColumn("chunk", F.pmod(F.xxhash64("fp"), "chunks"))
    tiles = stage(dealt.groupBy("key", "chunk").agg(F.collect_list("fp").alias("fps")), "tiles")
    # Pairs of tiles are found by their names; arrays travel by name and chunk, so the
    # commonest bit counts are dealt over as many tasks as they have chunks.
    steps = F.array(*[F.lit(s) for s in _steps(parts, radius, width)])
    one = tiles.select("key", "chunk", F.explode(F.transform(steps, lambda s: F.col("key") + s)).alias("key2"))
    two = tiles.select(F.col("key").alias("k2"), F.col("chunk").alias("chunk2"))
    pairs = one.join(two, F.col("key2") == F.col("k2")).filter("key < key2 or chunk <= chunk2").drop("k2")
    right = tiles.select(*[F.col(c).alias(c + "2") for c in ("key", "chunk", "fps")])
    pairs = pairs.join(tiles, ["key", "chunk"]).join(right, ["key2", "chunk2"]).select("fps", "fps2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                _forest(batch.column(0)[i].values.to_numpy(), batch.column(1)[i].values.to_numpy(), radius)
                for i in range(batch.num_rows)
            ]
            u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return pairs.mapInArrow(compare, "u bigint, v bigint")


def _forest(a: np.ndarray, b: np.ndarray, radius: int, rows: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links from the first member of each group of linked fingerprints to its others.

    Some rows are compared at a time and their links cut down to a spanning
    forest at once, so memory does not grow with the number of links.
    """
    members, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    u = v = np.zeros(0, np.int64)
    for at in range(0, len(a), rows):
        far = np.bitwise_count(a[at : at + rows].view(np.uint64)[:, None] ^ b.view(np.uint64))
        i, j = np.nonzero(far <= radius)
        if len(i):
            u, v = _spanning(np.concatenate([u, left[at + i]]), np.concatenate([v, right[j]]), len(members))
    return members[u], members[v]


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, radius: int = 2, parts: int = 4) -> DataFrame:
    """``doc_id, fp, component_id``: the component is named by its least id."""
    rows = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, radius, parts))
    return _named(rows, classes, roots)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _spanning(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each group's first member to its others, for links between n members."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            moved = np.flatnonzero(label != np.arange(n))
            return label[moved], moved
        label = new


def _named(rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with the least id of their fingerprint's component."""
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "r")
    named = rooted.join(names, rooted["root"] == names["r"]).select(F.col("fp").alias("f"), "component_id")
    named = stage(named.distinct(), "names")
    return rows.join(named, rows["fp"] == named["f"]).select("doc_id", "fp", "component_id")
