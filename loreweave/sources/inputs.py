"""Readers for the raw inputs: record dumps, checksums, rule books."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.sources.staging import stage
from loreweave.sources.streams import RANGE, digests, split_dumps

_META = "meta struct<date: string, version: string>"


class ChecksumError(RuntimeError):
    """A file's digest differs from the one in its sidecar."""


def read_dump(spark: SparkSession, path: str, *, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(meta, entries)`` of nested JSON dumps ``{meta, data: {name: [face]}}``.

    ``entries`` has one row per name: ``entry_pos`` (order in the file),
    ``name``, ``faces`` (array of variant) and ``version``, that of its own
    dump. A dump is one JSON document, which one task has to parse;
    ``partitions`` deals its entries out for the work that follows. Many dumps
    parse in parallel; a large uncompressed one is split by ``read_split_dump``,
    and JSON lines are read by ``read_entry_lines``.
    """
    dump = (
        spark.read.schema(f"{_META}, data map<string, array<variant>>")
        .option("multiLine", True)
        .json(path)
    )
    entries = dump.select("meta.version", F.posexplode("data").alias("entry_pos", "name", "faces"))
    return dump.select("meta.*"), entries.repartition(partitions) if partitions else entries


def read_entry_lines(spark: SparkSession, path: str) -> DataFrame:
    """Entries from JSON lines ``{"name": …, "faces": […], "version": …}``, split by Spark.

    There is no order across files, so the name itself stands in for it.
    """
    lines = spark.read.schema("name string, faces array<variant>, version string").json(path)
    return lines.select("version", F.col("name").alias("entry_pos"), "name", "faces")


def read_split_dump(spark: SparkSession, path: str, *, size: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """As ``read_dump``, of uncompressed dumps, each parsed by as many tasks as it has ranges of ``size`` bytes.

    ``entry_pos`` is an entry's first byte in its file. A name that occurs twice
    in a dump is two entries.
    """
    metas, entries = split_dumps(spark, path, size)
    metas = metas.select("file", F.from_json("meta", "date string, version string").alias("meta"))
    parsed = entries.select("file", F.col("place").alias("entry_pos"), F.from_json("entry", "map<string, array<variant>>").alias("data"))
    named = parsed.join(metas.select("file", "meta.version"), "file")
    return metas.select("meta.*"), named.select("version", "entry_pos", F.explode("data").alias("name", "faces"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each file: ``file``, ``sha256``; files are streamed, so they may have any size."""
    return digests(spark, path)


def sidecar_words(spark: SparkSession, path: str) -> DataFrame:
    """The first word of each file: ``sidecar, expected``."""
    words = F.split(F.trim(F.regexp_replace(F.col("content").cast("string"), r"\s+", " ")), " ")
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("sidecar"), F.element_at(words, 1).alias("expected"))


def compare_words(actual: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Adds ``expected`` and ``matches`` to ``sha256`` by a key; a file without a sidecar does not match."""
    joined = actual.join(expected, list(key), "left")
    return joined.withColumn("matches", F.col("sha256").eqNullSafe(F.col("expected")))


def compare_digests(spark: SparkSession, path: str, sidecars: str, suffix: str = ".sha256") -> DataFrame:
    """``file, sha256, expected, matches`` of files and their sidecars ``<file><suffix>``."""
    plain = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    actual = file_digests(spark, path).withColumn("sidecar", F.concat(plain("file"), F.lit(suffix)))
    expected = sidecar_words(spark, sidecars).withColumn("sidecar", plain("sidecar"))
    return compare_words(actual, expected, ["sidecar"]).drop("sidecar")


def check_digests(spark: SparkSession, path: str, sidecars: str, suffix: str = ".sha256") -> DataFrame:
    """The digests of files that match their sidecars; raises if one does not."""
    compared = stage(compare_digests(spark, path, sidecars, suffix), "digests")
    wrong = compared.filter(~F.col("matches")).head(1)
    if wrong:
        raise ChecksumError(
            f"SHA-256 mismatch for {wrong[0].file}: expected {wrong[0].expected}, found {wrong[0].sha256}"
        )
    return compared.select("file", "sha256")


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """Rule books, one row per file (``doc``, ``text``): BOM dropped, line ends as LF."""
    books = spark.read.text(path, wholetext=True)
    text = F.replace(F.regexp_replace("value", "^﻿", ""), F.lit("\r\n"), F.lit("\n"))
    return books.select(F.col("_metadata.file_path").alias("doc"), text.alias("text"))
