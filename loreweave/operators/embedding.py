"""Change detection for chunks, and the seam to an embedding model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave.functions.hashing import chunk_hash


@dataclass(frozen=True)
class Backend:
    """A model: its name, vector width, and how it fills a column."""

    name: str
    width: int
    apply: Callable[[DataFrame, str, str], DataFrame]

    def embed(self, df: DataFrame, text_col: str, out_col: str = "embedding") -> DataFrame:
        return self.apply(df, text_col, out_col)


def tokens(text: Column) -> Column:
    """The runs of letters and digits of a text, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


#: Slots of tokens that a worker keeps; the store starts anew beyond it.
MOST_TOKENS = 500_000
#: Tokens whose places are held at a time, unless one text has more.
TOKENS = 1_000_000


def slot_counts(width: int):
    """A column function: how often the tokens of each slot occur, scaled to length one; zeros for no token.

    A token's slot is the number in the first eight hex digits of its MD5,
    modulo ``width``; it is worked out once for each different token.
    """
    known: dict[bytes, int] = {}

    @F.arrow_udf("array<float>")
    def counts(found: pa.Array) -> pa.Array:
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        parts = []
        step = max(4_000_000 // width, 1)  # rows whose counts are held at a time
        upto = np.concatenate([[0], np.cumsum(pc.list_value_length(found).fill_null(0).to_numpy(zero_copy_only=False))])
        i = 0
        while i < len(found):
            fit = int(np.searchsorted(upto, upto[i] + TOKENS, "right")) - 1
            part = found.slice(i, min(max(fit - i, 1), step)).fill_null([])
            i += len(part)
            sizes = np.diff(part.offsets.to_numpy())
            coded = part.flatten().cast(pa.binary()).dictionary_encode()
            names = coded.dictionary.to_pylist()
            if len(known) > MOST_TOKENS:
                known.clear()
            for name in names:
                if name not in known:
                    known[name] = int.from_bytes(hashlib.md5(name).digest()[:4]) % width
            slot = np.fromiter(map(known.__getitem__, names), np.int64, len(names))[coded.indices.to_numpy()]
            place = np.repeat(np.arange(len(part)), sizes) * width + slot
            total = np.bincount(place, minlength=len(part) * width).reshape(len(part), width)
            length = np.sqrt((total * total).sum(axis=1, keepdims=True))
            parts.append((total / np.where(length > 0, length, 1)).astype("float32"))
        flat = np.concatenate(parts).ravel() if parts else np.zeros(0, "float32")
        return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * width, pa.int32()), pa.array(flat))

    return counts


def hashing_backend(width: int = 384) -> Backend:
    """Token counts hashed into ``width`` slots, scaled to length one.

    Deterministic and without any model file. A text without tokens gives the
    zero vector, whose similarity to anything is NULL and ranks last.
    """

    def apply(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        return df.withColumn(out_col, slot_counts(width)(tokens(F.col(text_col))))

    return Backend(f"hashing-{width}", width, apply)


def batch_backend(
    name: str, width: int, load: Callable[[], Callable[[list[str]], list]], batch_size: int = 200
) -> Backend:
    """A model called on batches of texts.

    ``load`` runs once per Python worker stream and returns the function that
    turns a list of texts into a list of vectors.
    """

    def apply(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        @F.arrow_udf("array<float>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import pyarrow as pa

            kind = pa.list_(pa.float32())
            model = load()
            for texts in batches:
                vectors = [pa.array([], kind)]
                # Only the texts of one call are held as strings.
                for i in range(0, len(texts), batch_size):
                    made = model(texts.slice(i, batch_size).to_pylist())
                    vectors.append(pa.array([list(map(float, v)) for v in made], kind))
                yield pa.concat_arrays(vectors)

        return df.withColumn(out_col, encode(F.col(text_col)))

    return Backend(name, width, apply)


# Backends by name, built when asked for. Add to it to bring models of your own.
BACKENDS: dict[str, Callable[[], Backend]] = {"hashing": hashing_backend}


def backend(name: str) -> Backend:
    if name not in BACKENDS:
        raise ValueError(f"unknown embedding backend: {name}")
    return BACKENDS[name]()


def with_hash(chunks: DataFrame, model: str) -> DataFrame:
    return chunks.withColumn("chunk_hash", chunk_hash(F.col("chunk_text"), model))


def pending(chunks: DataFrame, stored: DataFrame, *, full_refresh: bool = False) -> DataFrame:
    """Chunks whose hash is not the stored one; without a stored hash they count as changed.

    One anti join on key and hash: an equal row in the store is what makes a
    chunk unchanged. Tables from before the hash column existed pass through
    with a null hash, which equals nothing.
    """
    if full_refresh:
        return chunks
    if "chunk_hash" not in stored.columns:
        stored = stored.withColumn("chunk_hash", F.lit(""))
    key = ["id", "chunk_index", "chunk_hash"]
    return chunks.join(stored.select(*key), key, "left_anti")
