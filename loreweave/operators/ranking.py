"""Numbering and first-of-group, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row per key in the given order.

    Spark cuts each map task down to one row per key before the shuffle, so a
    key that holds a large part of the table costs no more than the others.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_k(df: DataFrame, keys: Sequence[str], k: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def number_rows(
    df: DataFrame, keys: Sequence[str], pos: str, out: str, *, span: int = 1_000_000
) -> DataFrame:
    """0-based position of each row within its key, in the order of ``pos``.

    ``pos`` is an integer that is unique within a key. A key is cut into ranges
    of ``span`` positions which are numbered apart from each other; the ranges'
    start numbers come from a count per range. No task ever sorts more than
    one range, however large the key is.
    """
    df = df.withColumn("_range", F.expr(f"`{pos}` div {span}"))
    split = [*keys, "_range"]
    local = df.withColumn(
        "_n", F.row_number().over(Window.partitionBy(*split).orderBy(pos)) - 1
    )
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        df.groupBy(*split)
        .agg(F.count("*").alias("_size"))
        .withColumn("_start", F.sum("_size").over(before))
        .filter("_start > 0")
        .drop("_size")
    )
    return (
        local.join(starts, split, "left")
        .withColumn(out, (F.col("_n") + F.coalesce("_start", F.lit(0))).cast("int"))
        .drop("_range", "_n", "_start")
    )
