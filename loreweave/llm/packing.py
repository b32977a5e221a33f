"""Packing by power-of-two pieces: no sequence crosses documents and none is padded.

A document of n ids is cut into whole sequences of the greatest length and then
into the binary digits of the rest, longest first. Pieces of one length form a
bucket; each is a sequence by itself, so a batch drawn from a bucket has equal
lengths without padding.

Every document is handled in its own task's stream of rows: nothing is shuffled
and copies or a hot source cost no more than other rows. Words, or their letters
and punctuation, are encoded once per task and looked up afterwards; the encoder never joins text over ASCII white
space, so the ids are those of the whole text.

Defined cases: a null or empty text has only the end id; a very long text gives
many whole sequences; equal rows give equal pieces under different sequence ids;
no rows give none. Only the id and the text are read, so other columns may have
any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

#: Parts of words kept per task; the store starts anew beyond it.
MOST_PARTS = 600_000
#: Rows whose ids are held at a time.
SLICE = 512

#: A word of Latin letters and punctuation behind them. The encoder lower-cases it,
#: keeps letters and punctuation apart and changes nothing else, so both are looked
#: up by themselves; all other words are encoded as they stand.
_PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?*%#$&|]*)$"


class WordIds:
    """Ids of whole texts, by a store of parts of words.

    A word is one or two parts; a part's ids stand in one array with all others,
    so the ids of many texts are gathered at once.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        vocabulary = self.encoder.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        # The first part is empty.
        self.parts: dict[str, int] = {"": 0}
        self.starts, self.sizes, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, "<u4")

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids begin and end."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        plain = pc.extract_regex(words.dictionary, _PLAIN)
        letters, marks = (pc.struct_field(plain, k) for k in ("letters", "marks"))
        first = pc.coalesce(pc.utf8_lower(letters), words.dictionary).dictionary_encode()
        second = pc.fill_null(marks, "").dictionary_encode()
        whole = np.zeros(len(first.dictionary), bool)
        whole[first.indices.to_numpy()[pc.is_valid(letters).to_numpy(zero_copy_only=False)]] = True
        names, others = first.dictionary.to_pylist(), second.dictionary.to_pylist()
        if len(self.parts) + len(names) + len(others) > MOST_PARTS:
            self.clear()
        left, right = self.numbers(names, whole), self.numbers(others, np.zeros(len(others), bool))
        both = np.column_stack([left[first.indices.to_numpy()], right[second.indices.to_numpy()]])
        parts = both[words.indices.to_numpy()].ravel()
        sizes = self.sizes[parts]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        each = np.repeat(self.starts[parts] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.ids[each], ends[2 * (split.offsets.to_numpy() - split.offsets[0].as_py())]

    def numbers(self, names: list[str], whole: np.ndarray) -> np.ndarray:
        """The numbers of different parts, which are learned if they are new; ``whole`` ones are words of letters."""
        found = np.array(list(map(self.parts.get, names, itertools.repeat(-1))), np.int64)
        new = found < 0
        for encode, many, some in ((self._encode_together, 500, new & whole), (self._encode, 10_000, new & ~whole)):
            at = np.flatnonzero(some)
            if len(at):
                words = [names[k] for k in at.tolist()]
                found[at] = np.arange(len(self.sizes), len(self.sizes) + len(at))
                self.parts.update(zip(words, found[at].tolist(), strict=True))
                ids, sizes = zip(*(encode(words[i : i + many]) for i in range(0, len(words), many)), strict=True)
                sizes = np.concatenate(sizes)
                self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
                self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, *ids])
        return found

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [c.ids for c in self.encoder.encode_batch_fast(parts, add_special_tokens=False)]
        return np.array([i for c in coded for i in c], "<u4"), np.array([len(c) for c in coded], np.int64)

    def _encode_together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters as one text, which is much cheaper: each ends at the next id that closes a word."""
        ids = np.array(self.encoder.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(parts) else self._encode(parts)


def lengths(n: int, longest: int) -> list[int]:
    """Whole sequences, then the binary digits of what is left, from the largest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(
    docs: DataFrame, id_col: str, text_col: str, tokenizer: str, *, end: int = 2, longest: int = 4096
) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: one row per piece.

    ``ids`` are little-endian unsigned 32-bit numbers; ``tokenizer`` is the path
    of a file that every executor has; ``longest`` is a power of two.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    kind = docs.schema[id_col].dataType
    out = StructType([
        StructField("doc_id", kind), StructField("start", LongType()), StructField("length", LongType()),
        StructField("ids", BinaryType()), StructField("doc_tokens", LongType()),
    ])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, closing = WordIds(tokenizer), np.array([end], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                row, start, length, ids, total = [], [], [], [], []
                coded, ends = coder(part.column(1))
                coded, ends = memoryview(coded.tobytes()), ends.tolist()
                for i in range(part.num_rows):
                    own, done = coded[4 * ends[i] : 4 * ends[i + 1]], 0
                    n = len(own) // 4 + 1
                    for size in lengths(n, longest):
                        row.append(i)
                        start.append(done)
                        length.append(size)
                        done += size
                        ids.append(bytes(own[4 * (done - size) : 4 * done]))
                        total.append(n)
                    ids[-1] += closing
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    cut = docs.select(id_col, text_col).mapInArrow(pieces, out)
    return cut.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Pieces in one folder per length, to draw batches of equal lengths from."""
    packed.withColumn("bucket", F.col("length")).write.mode("overwrite").partitionBy("bucket").parquet(path)
