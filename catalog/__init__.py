"""The registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents; a table that is read by fewer tasks than there are cores is dealt out, larger ones stay."""
    docs = table(spark, sf_dir, "documents").select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


class Catalog:
    """Queries by name with their optional SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn

        return register
