"""Columns shared by the text operators: words, lines and trimmed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words, as a list and as a pattern.
SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def squeezed(text: Column) -> Column:
    """The words of ``text`` with one blank between each two; empty if it is null.

    Plain replacements scan bytes, so a pattern runs only where blanks follow each other.
    """
    plain = F.coalesce(text, F.lit(""))
    for c in SPACES[1:]:
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    plain = F.trim(plain)
    return F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " {2,}", " ")).otherwise(plain)


def split_words(squeezed_text: Column) -> Column:
    """The words of a squeezed text; splitting at one plain character needs no pattern."""
    none = F.array().cast("array<string>")
    return F.when(squeezed_text == "", none).otherwise(F.split(squeezed_text, " ", -1))


def count_words(squeezed_text: Column) -> Column:
    """The number of words of a squeezed text, from its length with and without blanks."""
    blanks = F.octet_length(squeezed_text) - F.octet_length(F.replace(squeezed_text, F.lit(" "), F.lit("")))
    return F.when(squeezed_text == "", 0).otherwise(blanks + 1).cast("bigint")


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """Whether the remainder of the CRC of the id as text is ``part``; a null id is never held out."""
    return F.coalesce(F.crc32(id_column.cast("string")) % parts == part, F.lit(False))
