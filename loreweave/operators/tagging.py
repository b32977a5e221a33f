"""Concept tags for texts that contain a concept's hints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.operators.matching import CHARACTERS, occurrences


def tag_texts(
    texts: DataFrame, id_col: str, text_col: str, hints: DataFrame, *, characters: int = CHARACTERS
) -> DataFrame:
    """``id, key``: each concept once for each row whose text contains one of its hints.

    ``hints`` has ``key, hint``. Containment ignores case and may start inside
    a word. Rows are kept apart by a number of their own, so null and repeated
    ids keep their tags. ``characters`` sizes the blocks of hints and changes no row.
    """
    wanted = hints.select("key", F.lower("hint").alias("_hint")).filter("_hint <> ''").distinct()
    rows = texts.select(F.col(id_col).alias("_id"), F.lower(text_col).alias("_low")).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    found = occurrences(rows, "_low", wanted, "_hint", characters=characters)
    tags = found.select("_row", "_id", "key").distinct()
    return tags.select(F.col("_id").alias(id_col), "key")


def tag_arrays(tags: DataFrame, id_col: str) -> DataFrame:
    """Tags as one sorted array per id."""
    return tags.groupBy(id_col).agg(F.sort_array(F.collect_set("key")).alias("taxonomy_tags"))
