"""Chunk sources: every one gives ``id, chunk_index, chunk_text``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave.functions.notation import expand_notation
from loreweave.functions.text import SPACE, last_position, strip
from loreweave.functions.vectors import card_id
from loreweave.operators.ranking import keep_first


@dataclass(frozen=True)
class BookFormat:
    """Where the parts of a rule book begin and how its rules are numbered."""

    # The layout of the standard rule book.
    body: str = "\n1. Game Concepts\n"
    glossary: str = "\nGlossary\n"
    credits: str = "\nCredits\n"
    number: str = r"\d{3}(?:\.\d+[a-z]?)?"
    min_rule: int = 20
    min_term: int = 10


def name_chunks(cards: DataFrame) -> DataFrame:
    """Names as they are."""
    return cards.select(
        card_id(F.col("scryfall_oracle_id"), F.col("face_index")).alias("id"),
        F.lit(0).alias("chunk_index"),
        F.col("name").alias("chunk_text"),
    )


def text_chunks(cards: DataFrame) -> DataFrame:
    """Texts in plain language; a card without a text keeps an empty chunk."""
    narrow = cards.select("scryfall_oracle_id", "face_index", "name", "oracle_text")
    return expand_notation(narrow, "oracle_text", "name").select(
        card_id(F.col("scryfall_oracle_id"), F.col("face_index")).alias("id"),
        F.lit(0).alias("chunk_index"),
        F.col("clean_text").alias("chunk_text"),
    )


def book_sections(books: DataFrame, fmt: BookFormat = BookFormat()) -> DataFrame:
    """Split whole books (``doc, text``) into ``body`` and ``glossary``.

    The body starts at the second body marker (the first one is in the table
    of contents), or at the first, or at the top; the glossary at the last
    glossary marker unless that lies before the body; the credits end it.
    """
    t = F.col("text")
    first = F.position(F.lit(fmt.body), t)
    again = F.position(F.lit(fmt.body), t, F.col("_first") + len(fmt.body))
    at = (
        books.withColumn("_first", first)
        .withColumn("_again", F.when(F.col("_first") > 0, again).otherwise(0))
        .withColumn("_body", F.greatest(F.col("_first"), F.col("_again"), F.lit(1)))
        .withColumn("_glossary", last_position(t, fmt.glossary))
        .withColumn("_credits", last_position(t, fmt.credits))
    )
    # A marker on the very first character cannot occur before the body.
    has_glossary = (F.col("_glossary") > 0) & (F.col("_glossary") >= F.col("_body"))
    terms_from = F.col("_glossary") + len(fmt.glossary)
    terms_to = F.when(F.col("_credits") > F.col("_glossary"), F.col("_credits")).otherwise(
        F.length(t) + 1
    )

    def cut(start: Column, end: Column) -> Column:
        return F.substr(t, start, F.greatest(end - start, F.lit(0)))

    end = F.length(t) + 1
    return at.select(
        "doc",
        cut(F.col("_body"), F.when(has_glossary, F.col("_glossary")).otherwise(end)).alias("body"),
        F.when(has_glossary, cut(terms_from, terms_to)).otherwise("").alias("glossary"),
    )


_RULE, _TERM = 0, 1


def book_pieces(sections: DataFrame, fmt: BookFormat = BookFormat()) -> DataFrame:
    """Rules and glossary terms of each book: ``doc, part, pos, id, raw``.

    A rule runs from its number at a line start to the next one. Text before
    the first number is dropped, and so are rules that are too short (they
    still end the one before). Glossary blocks are parted by blank lines and
    named by their first line. Both parts come out of one pass over the book.
    """
    head = rf"^({fmt.number})\.?{SPACE}"

    def pieces(part: int, texts: Column) -> Column:
        return F.transform(texts, lambda t, i: F.struct(
            F.lit(part).alias("part"), i.alias("pos"), t.alias("piece")
        ))

    both = F.concat(
        pieces(_RULE, F.split("body", rf"(?mdU)(?={head})")),
        pieces(_TERM, F.split(strip(F.col("glossary")), "\n\n+")),
    )
    rows = sections.select("doc", F.inline(both))
    rows = rows.withColumn("raw", strip(F.col("piece")))
    is_rule = F.col("part") == _RULE
    number = F.regexp_extract("piece", rf"(?U){head}", 1)
    rows = rows.withColumn("name", F.when(is_rule, number).otherwise(strip(F.substring_index("raw", "\n", 1))))
    long_enough = F.length("raw") >= F.when(is_rule, fmt.min_rule).otherwise(fmt.min_term)
    kind = F.when(is_rule, "rule:").otherwise("glossary:")
    return rows.filter(long_enough & ((F.col("name") != "") | ~is_rule)).select(
        "doc", "part", "pos", F.concat(kind, F.col("name")).alias("id"), "raw"
    )


def rule_segments(sections: DataFrame, fmt: BookFormat = BookFormat()) -> DataFrame:
    return book_pieces(sections, fmt).filter(F.col("part") == _RULE).drop("part")


def glossary_terms(sections: DataFrame, fmt: BookFormat = BookFormat()) -> DataFrame:
    return book_pieces(sections, fmt).filter(F.col("part") == _TERM).drop("part")


def rules_chunks(books: DataFrame, fmt: BookFormat = BookFormat()) -> DataFrame:
    """Rules and glossary terms in plain language; of equal ids the last one stays."""
    rows = last_chunk(book_pieces(book_sections(books, fmt), fmt), ["id"], "doc", "part", "pos")
    return expand_notation(rows, "raw").select(
        "id", F.lit(0).alias("chunk_index"), F.col("clean_text").alias("chunk_text")
    )


def last_chunk(chunks: DataFrame, key: list[str], *order: str) -> DataFrame:
    """Of chunks with one key, the last in the given order replaces the others."""
    return keep_first(chunks, key, *[F.col(c).desc() for c in order])


def taxonomy_chunks(taxonomy: DataFrame) -> DataFrame:
    """Concept descriptions as texts of their own."""
    return taxonomy.select(
        F.concat(F.lit("taxonomy:"), "key").alias("id"),
        F.lit(0).alias("chunk_index"),
        F.col("description").alias("chunk_text"),
    )


# A source takes the job's inputs by name (``cards``, ``books``, ``taxonomy``)
# and gives chunks. Add to a copy of this table to bring sources of your own.
ChunkSource = Callable[[dict[str, DataFrame]], DataFrame]

SOURCES: dict[str, ChunkSource] = {
    "card_name": lambda inputs: name_chunks(inputs["cards"]),
    "card_text": lambda inputs: text_chunks(inputs["cards"]),
    "rules": lambda inputs: rules_chunks(inputs["books"]),
}
