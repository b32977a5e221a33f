"""Hashes for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(face: Column, keys: Sequence[str]) -> Column:
    """SHA-256 over the present ``keys`` of a variant object.

    Fields of a variant object are kept in name order at every level, so the
    text is the same for any order in the source; a missing key and an
    explicit null differ.
    """
    kept = F.map_filter(face.cast("map<string,variant>"), lambda k, _: k.isin(*keys))
    return F.sha2(F.to_json(kept), 256)


def chunk_hash(text: Column, model: str) -> Column:
    """MD5 of text and model name: either one changing calls for a new vector."""
    return F.md5(F.concat(text, F.lit("|"), F.lit(model)))
