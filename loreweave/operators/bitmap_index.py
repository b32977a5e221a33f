"""Filters on arrays and maps by bitmaps: one per value, combined before any row is read.

Rows get numbers; a bitmap says for a value, and for a bucket of numbers, which rows
have it. A filter reads the bitmaps of its values only, combines them bucket by
bucket, and then reads the buckets of rows that are left.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.sources.staging import stage

#: Buckets whose numbers are sent to the scan of the rows; beyond it they are joined.
SENT = 1_000


def entries(column: Column, kind: str) -> Column:
    """What a column is found by: an array's values, or a map's entries as ``key=value``."""
    if kind == "map":
        return F.transform(F.map_entries(column), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))
    return F.transform(column, lambda v: v.cast("string"))


class BitmapIndex:
    """Rows and their bitmaps below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, rows: DataFrame, columns: Sequence[str]) -> None:
        """Writes the rows, numbered, and the bitmaps of array and map columns."""
        numbered = rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"))
        # Numbers without gaps, so that buckets are full: places in a task behind the tasks before it.
        staged = f"{self.root}/given"
        numbered.withColumn("task", F.spark_partition_id()).write.mode("overwrite").parquet(staged)
        given = self.spark.read.parquet(staged)
        sizes = given.groupBy("task").agg(F.count("*").alias("n"), F.min("at").alias("least")).orderBy("task").collect()
        starts, before = [], 1  # the bitmap functions count from 1
        for r in sizes:
            starts.append((r["task"], before - r["least"]))
            before += r["n"]
        shift = F.broadcast(self.spark.createDataFrame(starts, "t int, shift long"))
        placed = given.join(shift, F.col("task") == F.col("t")).withColumn("at", F.col("at") + F.col("shift"))
        placed = placed.select("row", "at", F.expr("bitmap_bucket_number(at)").alias("bucket"))
        placed.repartitionByRange(max(1, -(-before // 1_000_000)), "at").sortWithinPartitions("at").write.mode("overwrite").parquet(f"{self.root}/rows")
        kinds = dict(rows.dtypes)
        values = None
        for c in columns:
            kind = "map" if kinds[c].startswith("map") else "array"
            some = placed.select(F.lit(c).alias("column"), "at", "bucket", F.explode(F.array_distinct(entries(F.col(f"row.`{c}`"), kind))).alias("value"))
            values = some if values is None else values.unionByName(some)
        bitmaps = values.filter("value is not null").groupBy("column", "value", "bucket").agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bitmap")
        )
        bitmaps.repartitionByRange("column", "value", "bucket").sortWithinPartitions("column", "value").write.mode("overwrite").parquet(f"{self.root}/bitmaps")

    def numbers(self, *ways: Mapping[str, Sequence[str]]) -> DataFrame:
        """``bucket, at`` of rows that have, for one of the ``ways`` at least, all its values in all its columns."""
        stored = self.spark.read.parquet(f"{self.root}/bitmaps")
        out = None
        for way in ways:
            pairs = [(c, v) for c, values in way.items() for v in dict.fromkeys(values)]
            if not pairs:
                raise ValueError("a way without values")
            test = F.lit(False)
            for c in way:
                test = test | ((F.col("column") == c) & F.col("value").isin([v for x, v in pairs if x == c]))
            both = stored.filter(test).groupBy("bucket").agg(F.expr("bitmap_and_agg(bitmap)").alias("bitmap"), F.count("*").alias("k"))
            both = both.filter(F.col("k") == len(pairs)).select("bucket", "bitmap")
            out = both if out is None else out.unionByName(both)
        any_way = out.groupBy("bucket").agg(F.expr("bitmap_or_agg(bitmap)").alias("bitmap"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for bucket, bitmap in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    bits = np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))
                    at = bits + (bucket - 1) * 8 * len(bitmap) + 1
                    yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(at), pa.int64()), pa.array(at, pa.int64())], ["bucket", "at"])

        return any_way.mapInArrow(run, "bucket long, at long")

    def count(self, *ways: Mapping[str, Sequence[str]]) -> int:
        return self.numbers(*ways).count()

    def rows(self, *ways: Mapping[str, Sequence[str]]) -> DataFrame:
        """The rows themselves; only the buckets that have some are read."""
        found = stage(self.numbers(*ways), "numbers")
        stored = self.spark.read.parquet(f"{self.root}/rows")
        buckets = [r[0] for r in found.select("bucket").distinct().limit(SENT + 1).collect()]
        if len(buckets) <= SENT:
            stored = stored.filter(F.col("bucket").isin(buckets))
        return stored.join(found.select("at"), "at", "left_semi").select("row.*")
