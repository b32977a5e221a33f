"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes are signs of the vectors under rotations fitted to a sample: principal axes,
turned so that the signs lose least. Each block of vectors holds its codes cut
into substrings of one byte, and one index per substring from a byte's value to
the vectors that have it. If two codes differ in at most r bits, some substring
differs in at most r / m bits (m substrings), so probing all values that near in
each index finds every code within the radius; these are compared whole, and those
within the radius are ranked by cosine in double precision.

The radius is the one that holds ``CERTAIN`` of the true neighbours inside the
sample. Neighbours in the whole table are nearer than those in a sample, so the
whole table's recall is not lower. Queries with fewer than k codes within it are
asked again with a radius that takes every code.

Queries are sent in blocks of bounded size to all vectors, which stay where they
are; every task answers with k candidates per query and block.

Defined cases: vectors that are null, zero or hold a null or a value that is not
finite take no part; vectors of different lengths are not compared; ties go to
the smaller id; rows with the same id are candidates of their own, and rows with a
query's own id are none; fewer candidates than k give fewer rows; no rows give none. Only the id and
the vector are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave.operators.ranking import keep_first, top_k
from loreweave.sources.staging import stage

#: Vectors that the codes and the radius are fitted on, and bits per code.
SAMPLE = 4_096
BITS = 256
CERTAIN = 0.98
#: Queries per pass and vectors per block, which bound the memory of a task.
QUERIES = 2_048
BLOCK = 8_192

_POP = np.bitwise_count(np.arange(256, dtype=np.uint8))
_FAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))


@dataclass
class Coder:
    mean: np.ndarray
    planes: np.ndarray  # [dimension, bits]
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One byte per substring."""
        return np.packbits((unit(vectors) - self.mean) @ self.planes > 0, axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ between each two codes."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for k in range(a.shape[1]):
        out += _FAR[a[:, k][:, None], b[:, k]]
    return out


def fit(sample: np.ndarray, k: int, bits: int = BITS, rounds: int = 20, seed: int = 7) -> Coder:
    """Rotations of the sample's principal axes, as many as give ``bits`` signs, and the radius."""
    x = unit(sample)
    mean = x.mean(axis=0)
    x = x - mean
    rng = np.random.default_rng(seed)
    _, axes = np.linalg.eigh(x.T @ x)
    planes = []
    while sum(p.shape[1] for p in planes) < bits:
        turn, _ = np.linalg.qr(rng.standard_normal(axes.shape))
        for _ in range(rounds):
            y = x @ axes
            u, _, vt = np.linalg.svd(y.T @ np.where(y @ turn > 0, 1.0, -1.0))
            turn = u @ vt
        planes.append(axes @ turn)
    coder = Coder(mean, np.concatenate(planes, axis=1)[:, :bits], bits)
    asked = sample[:: max(1, len(sample) // 256)]
    near = unit(asked) @ unit(sample).T
    near[np.arange(len(asked)), np.arange(0, len(sample), max(1, len(sample) // 256))[: len(asked)]] = -2
    best = np.argsort(-near, axis=1)[:, :k][:, : max(1, len(sample) - 1)]
    far = np.take_along_axis(distances(coder.codes(asked), coder.codes(sample)), best, axis=1)
    coder.radius = int(np.quantile(far, CERTAIN, method="higher"))
    return coder


class Index:
    """A block of codes with an index per substring: rows in the order of its byte, and where each value starts."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.rows = np.argsort(codes, axis=0, kind="stable").T.astype(np.int32)
        ordered = np.take_along_axis(codes, self.rows.T, axis=0)
        self.starts = [np.searchsorted(ordered[:, k], np.arange(257)) for k in range(codes.shape[1])]
        self.near: dict[tuple[int, int, int], np.ndarray] = {}

    def probe(self, part: int, value: int, far: int) -> np.ndarray:
        """Rows whose byte ``part`` differs from ``value`` in at most ``far`` bits."""
        key = (part, value, far)
        if key not in self.near:
            starts, rows = self.starts[part], self.rows[part]
            self.near[key] = np.concatenate([rows[starts[x] : starts[x + 1]] for x in np.flatnonzero(_FAR[value] <= far)])
        return self.near[key]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes are within ``radius`` bits of ``code``.

        A radius of a * m + b bits over m substrings needs the first b + 1 to be
        probed to a bits and the others to a - 1: otherwise the bits would add up
        to more than the radius.
        """
        parts = self.codes.shape[1]
        hit = np.zeros(len(self.codes), bool)
        for k, value in enumerate(code.tolist()):
            far = radius // parts - (k > radius % parts)
            if far >= 8:
                hit[:] = True
                break
            if far >= 0:
                hit[self.probe(k, value, far)] = True
        found = np.flatnonzero(hit)
        return found[_POP[self.codes[found] ^ code].sum(axis=1, dtype=np.int32) <= radius]


def usable(vector: Column) -> Column:
    """The vector in double precision, or null if it takes no part."""
    values = vector.cast("array<double>")
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine & F.exists(values, lambda x: x != 0), values)


def nearest(
    vectors: DataFrame, id_col: str, vector_col: str, asked: Column, k: int, *, bits: int = BITS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each row that ``asked`` holds for."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), usable(F.col(vector_col)).alias("vector"), asked.alias("asked")
    ).filter("vector is not null")
    found = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for width in sorted(r[0] for r in rows.select(F.size("vector")).distinct().collect()):
        same = rows.filter(F.size("vector") == width)
        sample = same.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
        coder = fit(np.array([r["vector"] for r in sample]), k, bits)
        queries = keep_first(same.filter("asked and vec_id is not null"), ["vec_id"], F.col("vector"))
        queries = stage(queries.select("vec_id", "vector"), "queries")
        first = stage(_ask(same, queries, coder, coder.radius, k), "nearest")
        full = first.filter(F.col("rank") == k).select(F.col("query_id").alias("full_id"))
        short = queries.join(full, F.col("vec_id") == F.col("full_id"), "left_anti")
        short = stage(short, "short")
        again = _ask(same, short, coder, bits, k)
        kept = first.join(short.select(F.col("vec_id").alias("short_id")), F.col("query_id") == F.col("short_id"), "left_anti")
        found = found.unionByName(kept).unionByName(again)
    return found


def _ask(vectors: DataFrame, queries: DataFrame, coder: Coder, radius: int, k: int) -> DataFrame:
    """Sends ``queries`` to all ``vectors`` in blocks and merges the answers."""
    spark = vectors.sparkSession
    blocks = -(-queries.count() // QUERIES)
    out = "query_id bigint, vec_id bigint, score double"
    answers = spark.createDataFrame([], out)
    for b in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()
        if block:
            ids, values = [r["vec_id"] for r in block], np.array([r["vector"] for r in block])
            shared = spark.sparkContext.broadcast((np.array(ids, np.int64), values, coder.codes(values), coder))
            answers = answers.union(vectors.select("vec_id", "vector").mapInArrow(_search(shared, radius, k), out))
    ranked = top_k(answers, ["query_id"], k, F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(shared, radius: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, codes, coder = shared.value
        norms = np.sqrt((queries * queries).sum(axis=1))
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)
        last = np.iinfo(np.int64).max  # stands for a null id, which ranks last
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
                own = part.column(0).fill_null(last).to_numpy()
                sizes = np.sqrt((x * x).sum(axis=1))
                index = Index(coder.codes(x))
                for i, code in enumerate(codes):
                    found = index.within(code, radius)
                    found = found[own[found] != ids[i]]
                    if len(found):
                        score = (x[found] * queries[i]).sum(axis=1) / (sizes[found] * norms[i])
                        score = np.concatenate([best[i][0], score])
                        names = np.concatenate([best[i][1], own[found]])
                        top = np.lexsort((names, -score))[:k]
                        best[i] = (score[top], names[top])
        if best:
            names = np.concatenate([b[1] for b in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, [len(b[1]) for b in best])), pa.array(names, mask=names == last),
                 pa.array(np.concatenate([b[0] for b in best]))],
                ["query_id", "vec_id", "score"],
            )

    return run
