"""Phrase search by a stored index of character triples, without reading the texts.

Texts are put end to end in blocks. For each triple of characters a block has a
posting list: the places where it stands, rising and stored as differences. A phrase
is covered by some of its triples; it stands where all of their lists, shifted by the
triples' places in the phrase, have a place in common, so the lists alone give the
exact answer. Files are sorted by triple, and only those with a triple in question
are read.

The index follows a table by segments: a segment adds texts and takes ids out of the
segments before it. The log row of a segment is written last and makes it visible.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.sources.streams import listed

#: Characters per block: the places of a posting list stay below it, but for one longer text.
BLOCK = 4_000_000
SIZE = 3
#: Written bytes of posting lists that one task sorts into one file.
FILE = 64 << 20
_BITS = 21
_POSTINGS = "block long, gram long, places binary"
_LOG = T.StructType([T.StructField("segment", T.IntegerType())])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def grams(codes: np.ndarray) -> np.ndarray:
    """The triple that begins at each character, as one number; fewer characters give none."""
    if len(codes) < SIZE:
        return np.zeros(0, np.int64)
    return codes[:-2] << (2 * _BITS) | codes[1:-1] << _BITS | codes[2:]


def cover(phrase: str) -> list[tuple[int, int]]:
    """Place in the phrase and triple: as few as touch every character."""
    found = grams(_codes(phrase))
    places = sorted({*range(0, len(found), SIZE), len(found) - 1}) if len(found) else []
    return [(p, int(found[p])) for p in places]


def deltas(places: np.ndarray) -> bytes:
    return np.diff(places, prepend=0).astype("<u4").tobytes()


def undelta(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u4"), dtype=np.int64)


class GramIndex:
    """An index below ``root`` over rows of ``id, text``; case is ignored. A segment has ``files`` files at least."""

    def __init__(self, spark: SparkSession, root: str, id_type: T.DataType = T.LongType(), *, files: int | None = None) -> None:
        self.spark, self.root, self.id_type = spark, root.rstrip("/"), id_type
        self.files = files or max(8, spark.sparkContext.defaultParallelism)
        spark.createDataFrame([], _LOG).write.mode("ignore").parquet(f"{self.root}/log")

    def segments(self) -> list[int]:
        return sorted(r[0] for r in self.spark.read.schema(_LOG).parquet(f"{self.root}/log").collect())

    # -- writing -------------------------------------------------------------

    def add(self, rows: DataFrame, gone: DataFrame | None = None) -> int:
        """A segment with the texts of ``rows`` (``id, text``); ids of ``gone`` and of ``rows`` leave the older ones."""
        segment = max(self.segments(), default=0) + 1
        path = f"{self.root}/segment={segment}"
        rows = rows.select("id", F.lower("text").alias("text")).filter("text is not null")
        out = T.StructType([
            T.StructField("block", T.LongType()), T.StructField("gram", T.LongType()), T.StructField("places", T.BinaryType()),
            T.StructField("ids", T.ArrayType(self.id_type)), T.StructField("starts", T.BinaryType()),
        ])
        id_array, block_size = pa.list_(_arrow(self.id_type)), BLOCK

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, held, ids, size = TaskContext.get().partitionId() << 32, [], [], 0

            def block() -> Iterator[pa.RecordBatch]:
                # A character that no text has stands between two texts.
                parts = [x for codes in held for x in (codes, np.zeros(1, np.int64))]
                found = grams(np.concatenate(parts))
                order = np.argsort(found, kind="stable")
                names, first = np.unique(found[order], return_index=True)
                places = [deltas(p) for p in np.split(order, first[1:])] if len(names) else []
                starts = np.cumsum([0, *[len(c) + 1 for c in held[:-1]]])
                n = len(names)
                for at in range(0, n, 50_000):
                    m = min(50_000, n - at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * m, pa.int64()), pa.array(names[at : at + m]), pa.array(places[at : at + m], pa.binary()),
                         pa.nulls(m, id_array), pa.nulls(m, pa.binary())], out.names,
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                     pa.array([ids], id_array), pa.array([starts.astype("<i8").tobytes()], pa.binary())], out.names,
                )

            for batch in batches:
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    codes = _codes(text.as_py())
                    if held and size + len(codes) > block_size:
                        yield from block()
                        number, held, ids, size = number + 1, [], [], 0
                    held.append(codes)
                    ids.append(i)
                    size += len(codes) + 1
            if held:
                yield from block()

        made = f"{path}/made"
        rows.mapInArrow(run, out).write.mode("overwrite").parquet(made)
        made = self.spark.read.schema(out).parquet(made)
        postings = made.filter("gram is not null").select("block", "gram", "places")
        written = listed(self.spark, f"{path}/made").agg(F.sum("length")).first()[0] or 0
        files = max(self.files, -(-written // FILE))
        postings.repartitionByRange(files, "gram", "block").sortWithinPartitions("gram", "block").write.mode("overwrite").parquet(f"{path}/postings")
        made.filter("gram is null").select("block", "ids", "starts").write.mode("overwrite").parquet(f"{path}/texts")
        leaving = rows.select("id") if gone is None else gone.select("id").unionByName(rows.select("id"))
        leaving.distinct().write.mode("overwrite").parquet(f"{path}/gone")
        self.spark.createDataFrame([(segment,)], _LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return segment

    # -- reading -------------------------------------------------------------

    def find(self, phrases: Sequence[str]) -> DataFrame:
        """``phrase, id``: the texts that hold each phrase, in any case; phrases have three characters at least."""
        short = [p for p in phrases if len(p) < SIZE]
        if short:
            raise ValueError(f"phrases of fewer than {SIZE} characters: {short}")
        asked = self.spark.createDataFrame(
            [(p, place, gram, len(cover(low))) for p in dict.fromkeys(phrases) for low in [_lower(self.spark, p)] for place, gram in cover(low)],
            "phrase string, place long, gram long, lists int",
        )
        wanted = sorted({r["gram"] for r in asked.collect()})
        out_type = T.StructType([T.StructField("phrase", T.StringType()), T.StructField("id", self.id_type)])
        out, id_type = self.spark.createDataFrame([], out_type), _arrow(self.id_type)

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            found = []
            if left.num_rows and right.num_rows:
                ids, starts = right["ids"].to_pylist()[0], np.frombuffer(right["starts"].to_pylist()[0], "<i8")
                by_phrase: dict[str, list] = {}
                for r in left.to_pylist():
                    by_phrase.setdefault(r["phrase"], []).append(r)
                for phrase, lists in by_phrase.items():
                    if len(lists) < lists[0]["lists"]:
                        continue
                    places = None
                    for r in sorted(lists, key=lambda r: len(r["places"])):
                        here = undelta(r["places"]) - r["place"]
                        places = here if places is None else np.intersect1d(places, here, assume_unique=True)
                    for k in np.unique(np.searchsorted(starts, places, "right") - 1).tolist():
                        found.append((phrase, ids[k]))
            return pa.table({"phrase": pa.array([p for p, _ in found], pa.string()), "id": pa.array([i for _, i in found], id_type)})

        segments = self.segments()
        for at, segment in enumerate(segments):
            path = f"{self.root}/segment={segment}"
            lists = self.spark.read.schema(_POSTINGS).parquet(f"{path}/postings").filter(F.col("gram").isin(wanted))
            lists = lists.join(F.broadcast(asked), "gram").select("block", "phrase", "place", "lists", "places")
            texts = self.spark.read.parquet(f"{path}/texts").select("block", "ids", "starts")
            hits = lists.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(meet, out_type)
            if later := segments[at + 1 :]:
                gone = self.spark.read.parquet(*[f"{self.root}/segment={s}/gone" for s in later]).select("id").distinct()
                hits = hits.join(gone, "id", "left_anti").select("phrase", "id")
            out = out.unionByName(hits)
        return out

    def counts(self, phrases: Sequence[str]) -> DataFrame:
        """``phrase, n`` for every phrase."""
        asked = self.spark.createDataFrame([(p,) for p in dict.fromkeys(phrases)], "phrase string")
        found = self.find(phrases).groupBy("phrase").agg(F.count("*").alias("n"))
        return asked.join(found, "phrase", "left").select("phrase", F.coalesce("n", F.lit(0)).alias("n"))


def _lower(spark: SparkSession, phrase: str) -> str:
    """As Spark lowers the texts."""
    return spark.createDataFrame([(phrase,)], "p string").select(F.lower("p")).first()[0]


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
