"""Line-first cleaning: rules per line, then a verdict on what is left of the text.

Everything is a column of the row's own text, so nothing is shuffled and a hot
source or a group of copies costs no more than other rows.

Defined cases: a null text has no words and no lines; an empty line passes all
rules and weighs nothing; equal rows get equal results; a table without rows
gives none. Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave.llm.text import SPACE, split_words, squeezed, trimmed

#: Phrases of page furniture, lower case.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "log in to",
    "powered by",
    "privacy policy",
    "read more",
    "share this",
    "sign up",
    "skip to content",
    "subscribe to",
    "terms of use",
    "use cookies",
)
#: Characters between the entries of menus and breadcrumbs.
SEPARATORS = "|»›•·→"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """When a line fails, and how much text may be lost.

    A line fails if it has ``min_separators`` separators standing alone between
    words and they are at least ``separator_share`` of its words (navigation),
    if its symbols are more than ``symbol_share`` of its words (mark-up), if it
    holds a phrase of page furniture and at most ``boilerplate_chars`` characters,
    or if it has ``bare_words`` or more words and no punctuation at all.
    """

    min_separators: int = 3
    separator_share: float = 0.2
    symbol_share: float = 0.3
    boilerplate_chars: int = 80
    bare_words: int = 60
    max_lost: float = 0.5
    min_words: int = 10
    max_repeated: float = 0.2


def clean(docs: DataFrame, id_col: str, text_col: str, rules: LineRules = LineRules()) -> DataFrame:
    """One row per row: id, counts, ``base_failed``, the cleaned text, shares and ``kept``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    df = df.withColumn("plain", squeezed(F.col("text")))
    df = df.withColumn("words", split_words(F.col("plain"))).withColumn("lines", F.split("text", "\n", -1))
    df = df.withColumn("n_words", F.size("words").cast("bigint")).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("grams", _grams("hashes"))
    df = df.withColumn("kept_lines", F.filter("lines", lambda line: _passes(line, rules)))
    df = df.withColumn("full_lines", F.filter("lines", lambda line: trimmed(line) != ""))
    df = df.select(
        "doc_id",
        "n_words",
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.when(F.col("text").rlike(f"[{SYMBOLS}]"), F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")))
        .otherwise(0).cast("bigint").alias("n_symbols"),
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("grams")) < F.size("grams"), _by_gram("grams")).alias("sorted"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("kept_lines").cast("bigint").alias("n_kept_lines"),
        F.array_join("kept_lines", "\n").alias("clean_text"),
    )
    df = df.withColumn("n_repeat_words", F.coalesce(_covered("sorted"), F.lit(0)).cast("bigint"))
    whole = F.col("n_kept_lines") == F.col("n_lines")
    df = df.withColumn("kept_chars", F.when(whole, F.col("word_chars")).otherwise(_solid(F.col("clean_text"))))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > round(100 * rules.max_repeated) * F.col("n_words")
    )
    enough = F.col("kept_chars") >= (1 - rules.max_lost) * F.col("word_chars")
    return df.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & enough).alias("kept"),
        "n_lines", "n_kept_lines", "kept_chars", "clean_text",
    )


def _solid(text: Column) -> Column:
    """Code points that are not white space."""
    return F.length(F.regexp_replace(text, SPACE + "+", "")).cast("bigint")


def _passes(line: Column, rules: LineRules) -> Column:
    """Each rule begins with its cheapest test, so most lines meet no counting."""
    words = F.size(F.split(trimmed(line), SPACE + "+"))
    alone = F.regexp_count(line, F.lit(rf"(?<![^\x20\x09-\x0D])[{SEPARATORS}](?![^\x20\x09-\x0D])"))
    symbols = F.regexp_count(line, F.lit(f"[{SYMBOLS}]"))
    menu = (alone >= rules.min_separators) & (alone >= rules.separator_share * words)
    phrase = line.rlike("(?i)" + "|".join(BOILERPLATE))
    return ~(
        (line.rlike(f"[{SEPARATORS}]") & menu)
        | (line.rlike(f"[{SYMBOLS}]") & (symbols > rules.symbol_share * words))
        | ((F.length(line) <= rules.boilerplate_chars) & phrase)
        | (~line.rlike(r"[.!?…:;,。！？]") & (words >= rules.bare_words))
    )


def _grams(hashes: str, size: int = 5) -> Column:
    """A 64-bit hash of each window of ``size`` words, from the words' hashes."""
    ends = F.slice(hashes, size, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))
    return F.transform(ends, lambda last, i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size - 1)], last))


def _by_gram(grams: str) -> Column:
    return F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _covered(ordered: str, size: int = 5) -> Column:
    """Words inside a window that is found twice: neighbours in hash order are equal."""
    twice = F.filter(
        ordered,
        lambda x, j: (x["h"] == F.get(ordered, j - 1)["h"]) | (x["h"] == F.get(ordered, j + 1)["h"]),
    )
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct(
            (acc["n"] + p + size - F.greatest(p, acc["end"])).alias("n"), (p + size).alias("end")
        ),
        lambda acc: acc["n"],
    )
