"""Line dedup: repeated lines are looked up in a sharded minimal perfect hash.

Lines are named by 128-bit hashes of their keys. Hashes found in enough
documents go into shards of bounded size; each shard has a minimal perfect hash
(levels of bits, a key stands where it is alone) that indexes compact arrays: a
64-bit fingerprint, the number of documents and the largest document. The
documents' line hashes are sent to the shards in pieces of bounded size and
probe the arrays; line texts never move, and no line is joined with a line.

Defined cases: a null or empty text is one empty line; rows with the same id are
one document; rows with a null id are together one document that is smaller than
all others; a document that loses all lines keeps an empty text; a line that
repeats within one document counts once. A table without rows gives none. The
input's columns come back in one struct, so they may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loreweave.sources.staging import stage

#: Hashes per shard and probes per task, which bound the memory of a task.
SHARD_KEYS = 1 << 15
PROBES = 1 << 18
#: Every shard is probed by this many tasks at least, so that a line found in a
#: large part of the documents meets no single one.
LEAST_PIECES = 64
#: Bits per key left at a level.
GAMMA = 1.5


def line_key(line: bytes, least: int) -> bytes | None:
    """The key of a line, or none if it has fewer than ``least`` code points."""
    key = line.strip().lower()
    if len(key) < least or (not key.isascii() and len(key.decode()) < least):
        return None
    return key


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys.

    At each level a key has one place; keys alone at their place stay, the others
    go on. A key's index is the number of places taken before its own.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(keys):
            if len(sizes) == 64:
                raise ValueError("equal keys cannot be told apart")
            size = (max(64, int(GAMMA * len(keys))) + 7) // 8 * 8
            at = cls.place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate([*levels, np.zeros(0, np.uint8)]))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, and some index or -1 for other keys."""
        found = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + self.place(keys[left], level, size)
            byte, bit = self.bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit & 1).astype(bool)
            below = byte[hit] & ((np.uint8(1) << bit[hit]) - np.uint8(1))
            found[left[hit]] = self.rank[at[hit] >> 3] + np.bitwise_count(below)
            left, start = left[~hit], start + size
        return found


def line_hashes(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """``doc, hi, lo``: the 128-bit hash of each different line key of a document."""
    out = "doc bigint, hi bigint, lo bigint"

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            row, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                keys = {k for k in (line_key(x, least) for x in (text or "").encode().split(b"\n")) if k}
                row.extend([i] * len(keys))
                found.extend(map(xxhash.xxh3_128_digest, keys))
            pair = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            ids = batch.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["doc", "hi", "lo"]
            )

    return docs.select(F.col(id_col).cast("bigint").alias("doc"), text_col).mapInArrow(hashes, out).distinct()


def build_shards(repeated: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard from ``hi, lo, n, last``; a shard holds about ``SHARD_KEYS`` hashes."""
    out = "shard bigint, sizes binary, bits binary, prints binary, counts binary, lasts binary"

    def build(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        hi = part["hi"].to_numpy().view(np.uint64)
        table = PerfectHash.build(hi)
        order = np.argsort(table.index(hi))
        arrays = [
            table.sizes, table.bits, part["lo"].to_numpy()[order],
            part["n"].to_numpy().astype(np.int32)[order], part["last"].to_numpy()[order],
        ]
        values = [pa.array([part["shard"][0].as_py()], pa.int64()), *[pa.array([a.tobytes()]) for a in arrays]]
        return pa.Table.from_arrays(values, ["shard", "sizes", "bits", "prints", "counts", "lasts"])

    return repeated.withColumn("shard", F.pmod("lo", F.lit(shards))).groupBy("shard").applyInArrow(build, out)


def _probe(lines: pa.Table, shard: pa.Table) -> pa.Table:
    if not shard.num_rows or not lines.num_rows:
        return lines.slice(0, 0).select(["doc", "hi", "lo"])
    kinds = {"sizes": np.int64, "bits": np.uint8, "prints": np.int64, "counts": np.int32, "lasts": np.int64}
    a = {k: np.frombuffer(shard[k][0].as_py(), v) for k, v in kinds.items()}
    lines = lines.combine_chunks()
    at = PerfectHash(a["sizes"], a["bits"]).index(lines["hi"].to_numpy().view(np.uint64))
    known = (at >= 0) & (a["prints"][at] == lines["lo"].to_numpy())
    doc = lines["doc"]
    largest = np.asarray(doc.fill_null(0)) == a["lasts"][at]
    dropped = known & ~(largest & np.asarray(doc.is_valid()))
    return lines.filter(pa.array(dropped)).select(["doc", "hi", "lo"])


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, *, least: int = 40, copies: int = 5) -> DataFrame:
    """``doc, dropped``: the hashes of the lines that each document loses."""
    lines = stage(line_hashes(docs, id_col, text_col, least), "lines")
    counts = lines.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("doc").alias("last"))
    repeated = stage(counts.filter(F.col("n") >= copies), "repeated")
    shards = max(1, -(-repeated.count() // SHARD_KEYS))
    arrays = stage(build_shards(repeated, shards), "shards")
    probes = lines.withColumn("shard", F.pmod("lo", F.lit(shards)))
    most = probes.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    pieces = max(LEAST_PIECES, -(-most // PROBES))
    probes = probes.withColumn("piece", F.pmod(F.xxhash64("doc", "hi"), F.lit(pieces)))
    each = arrays.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(pieces - 1).cast("bigint"))))
    hits = probes.groupBy("shard", "piece").cogroup(each.groupBy("shard", "piece")).applyInArrow(
        _probe, "doc bigint, hi bigint, lo bigint"
    )
    return hits.groupBy("doc").agg(F.collect_list(F.struct("hi", "lo")).alias("dropped"))


def dedup_lines(docs: DataFrame, id_col: str, text_col: str, *, least: int = 40, copies: int = 5) -> DataFrame:
    """``row, kept_text, n_lines, n_dropped``; ``row`` is the input row.

    A key of at least ``least`` code points found in ``copies`` documents or more
    loses all its lines except those of the largest document that holds it.
    """
    found = dropped_lines(docs, id_col, text_col, least=least, copies=copies)
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("doc", F.col(f"row.{id_col}").cast("bigint"))
    found = found.withColumnRenamed("doc", "found_doc")
    joined = rows.join(found, F.col("doc").eqNullSafe(F.col("found_doc")), "left")
    joined = joined.select("row", F.col(f"row.{text_col}").alias("text"), "dropped")
    out = StructType([
        joined.schema["row"], StructField("kept_text", StringType()),
        StructField("n_lines", LongType()), StructField("n_dropped", LongType()),
    ])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            texts, totals, gone = [], [], []
            for text, dropped in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = text or ""
                n = text.count("\n") + 1
                lost = 0
                if dropped:
                    bad = {np.array([d["hi"], d["lo"]], "<i8").tobytes() for d in dropped}
                    lines = text.encode().split(b"\n")
                    keys = (line_key(x, least) for x in lines)
                    keep = [x for x, k in zip(lines, keys, strict=True) if not k or xxhash.xxh3_128_digest(k) not in bad]
                    lost = n - len(keep)
                    text = b"\n".join(keep).decode()
                texts.append(text)
                totals.append(n)
                gone.append(lost)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64())],
                ["row", "kept_text", "n_lines", "n_dropped"],
            )

    return joined.mapInArrow(apply, out)
