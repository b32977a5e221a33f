"""Integrity, coverage and verdict reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def foundation(df: DataFrame, record: str, index: str, hash_col: str, *, min_rows: int = 30000) -> DataFrame:
    """One row: rows, distinct records, further faces, missing hashes, repeated keys, verdict.

    Rows are first counted per key, so a repeated key costs one counter.
    """
    missing = F.col(hash_col).isNull() | (F.col(hash_col) == "")
    per_key = df.groupBy(record, index).agg(
        F.count("*").alias("n"), F.count_if(missing).alias("missing")
    )
    per_record = per_key.groupBy(record).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col(index) > 0, F.col("n")).otherwise(0)).alias("extra"),
        F.sum("missing").alias("missing"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )
    total = per_record.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(record).alias("distinct_records"),
        F.coalesce(F.sum("extra"), F.lit(0)).alias("extra_faces"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_hash"),
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("duplicate_keys"),
    )
    ok = (F.col("total_rows") > min_rows) & (F.col("missing_hash") == 0) & (F.col("duplicate_keys") == 0)
    return total.withColumn("ok", ok)


def source_counts(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("n")).orderBy(source)


def coverage(counts: DataFrame, expected: DataFrame, source: str = "source") -> DataFrame:
    """Expected minima against counts; a source that is missing counts 0."""
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return expected.join(counts, source, "left").select(
        source, n.alias("n"), "min_count", (n >= F.col("min_count")).alias("ok")
    )


def last_success(log: DataFrame, run_id: str = "id", status: str = "status", value: str = "success") -> DataFrame:
    """The latest successful run."""
    return log.filter(F.col(status) == value).orderBy(F.desc(run_id)).limit(1)


def successes(log: DataFrame, status: str = "status", value: str = "success") -> DataFrame:
    n = F.count_if(F.col(status) == value)
    return log.agg(n.alias("successes"), (n > 0).alias("ok"))


def verdict(ok: Column, is_empty: Column) -> Column:
    """``skip`` if there was nothing to check, else ``pass`` or ``fail``."""
    return F.when(is_empty, "skip").when(ok, "pass").otherwise("fail")


def verdict_totals(checks: DataFrame, col: str = "verdict") -> DataFrame:
    def n(v: str) -> Column:
        return F.count_if(F.col(col) == v)

    return checks.agg(
        n("pass").alias("passed"), n("fail").alias("failed"), n("skip").alias("skipped"),
        F.count("*").alias("total"), (n("fail") == 0).alias("ok"),
    )
