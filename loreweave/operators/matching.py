"""Which of many search strings occur in which texts, by one walk over each text.

The search strings become an automaton (Aho-Corasick): a tree of their characters
with a link from each place to the longest end that is a beginning too. A text is
walked once, character by character, whatever the number of search strings, and
only the numbers of those that it holds leave its row. Search strings go to the
tasks in blocks of bounded size; texts are walked once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.sources.staging import stage

#: Characters of search strings in one automaton, which takes up to a hundred bytes for each.
CHARACTERS = 1_000_000
#: Texts of an Arrow batch that a worker holds as strings at a time.
ROWS = 256


def _blocks(words: DataFrame, characters: int) -> Iterator[list[str]]:
    """Search strings in blocks of bounded size, one block at a time on the driver."""
    part, size = [], 0
    for (word,) in words.toLocalIterator():
        if part and size + len(word) > characters:
            yield part
            part, size = [], 0
        part.append(word)
        size += len(word)
    if part:
        yield part


def _automaton(words: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for number, word in enumerate(words):
        found.add_word(word, number)
    found.make_automaton()
    return found


def _numbers(shared):
    """A column function: the numbers of the search strings that a text holds, each once."""

    @F.arrow_udf("array<int>")
    def numbers(texts: pa.Array) -> pa.Array:
        import pyarrow as pa

        walk = shared.value.iter
        found = []
        for i in range(0, len(texts), ROWS):
            found += [None if t is None else list({n for _, n in walk(t)}) for t in texts.slice(i, ROWS).to_pylist()]
        return pa.array(found, pa.list_(pa.int32()))

    return numbers


def occurrences(
    texts: DataFrame, text: str, needles: DataFrame, anchor: str, *, characters: int = CHARACTERS
) -> DataFrame:
    """Rows of ``texts`` with the rows of ``needles`` whose ``anchor`` occurs in ``text``.

    Rows without a text and search strings without an anchor meet nothing.
    """
    spark = texts.sparkSession
    wanted = needles.filter(F.length(anchor) > 0)
    out = texts.limit(0).join(wanted.limit(0), F.lit(False))
    for words in _blocks(wanted.select(anchor).distinct(), characters):
        numbers = _numbers(spark.sparkContext.broadcast(_automaton(words)))
        # As an Arrow table it needs no Python workers, which would stay beside those that walk the texts.
        numbered = spark.createDataFrame(pa.table({"_number": pa.array(range(len(words)), pa.int32()), "_word": pa.array(words, pa.string())}))
        # Written down, so that Spark knows its size: else the texts would be shuffled by number, all that hold one to one task.
        asked = stage(wanted.join(numbered, F.col(anchor) == F.col("_word")).drop("_word"), "needles")
        found = texts.withColumn("_numbers", numbers(F.col(text)))
        found = found.withColumn("_number", F.explode("_numbers")).drop("_numbers").join(asked, "_number").drop("_number")
        out = out.unionByName(found)
    return out
