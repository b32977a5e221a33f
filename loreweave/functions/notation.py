"""Rewriting of bracketed notation into plain language, on columns.

Everything is built from SQL functions, so a whole table is rewritten inside
the JVM; ``expand_notation`` is the table-level entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave.functions.text import strip

# ---- Fixed values: the notation vocabulary -------------------------------

COLOURS = {
    "W": "white", "U": "blue", "B": "black", "R": "red", "G": "green", "C": "colorless",
}

BASIC_MANA = {
    "W": "white mana", "U": "blue mana", "B": "black mana", "R": "red mana",
    "G": "green mana", "C": "colorless mana", "S": "snow mana",
}

NUMBERS = {
    "0": "zero", "1": "one", "2": "two", "3": "three", "4": "four", "5": "five",
    "6": "six", "7": "seven", "8": "eight", "9": "nine", "10": "ten",
    "11": "eleven", "12": "twelve", "13": "thirteen", "14": "fourteen",
    "15": "fifteen", "16": "sixteen", "17": "seventeen", "18": "eighteen",
    "19": "nineteen", "20": "twenty", "100": "one hundred", "1000000": "one million",
}

SPECIAL = {
    "T": "Tap (tap this permanent)",
    "Q": "Untap (untap this permanent)",
    "E": "energy (energy counter)",
    "TK": "ticket (ticket counter)",
    "P": "power marker",
    "A": "acorn counter",
    "CHAOS": "chaos",
    "HR": "heart",
    "PW": "planeswalker symbol",
    "X": "X (variable amount)",
    "½": "half",
    "∞": "infinity",
    "D": "land drop (give up a land drop to pay this cost)",
    "Z": "multi-source mana (paid with mana from a source that could produce two or more colors)",
    "L": "legendary mana (paid with mana from a legendary source)",
    "H": "Phyrexian mana (paid with mana or 2 life)",
}

NON_ASCII = {
    "—": " -- ", "•": " * ", "−": "-", "½": "1/2",
    "²": "squared", "¹": "^1", "³": "cubed", "⁴": "^4",
    "⁵": "^5", "∞": "infinity", "π": "pi", "√": "sqrt",
    "→": "->", "ˣ": "^x", "☐": "[ ]", "♦": "<>",
    "꞉": ":", "º": "o",
}

VARIABLE_STATS = {
    "*": "variable", "1+*": "one plus variable", "2+*": "two plus variable",
    "*+1": "variable plus one", "*²": "variable squared",
    "7-*": "seven minus variable", "?": "unknown", "∞": "infinity",
}

SELF_TOKEN = "this card"

# ---- Symbols ---------------------------------------------------------------

# Whole symbols that a lookup settles; the rest is composed from parts.
_WHOLE = {**{n: f"{w} generic mana" for n, w in NUMBERS.items()}, **BASIC_MANA, **SPECIAL}
_HYBRID_PART = {**{n: f"{w} generic" for n, w in NUMBERS.items()}, **COLOURS}

# Splits a text into plain stretches, symbols and single signs; joining the
# tokens gives the text back. The first pattern takes nearly all of a Latin
# text, the third other scripts, the last whatever is left, one sign at a time:
# it covers all of NON_ASCII.
_TOKENS = "|".join([
    r"[\x00-z|-\x7f\xbe-\u024f]+",
    r"\{[^}]+\}",
    r"[\u0250-\u02e2\u02e4-\u03bf\u03c1-\u2013\u2667-\ua788\ua78a-\x{10ffff}]+",
    r"(?s:.)",
])
_MARKED = r"[{\u00b2-\u00bd\u02e3\u03c0\u2014-\u2666\ua789]"


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _named(parts: Column, table: dict[str, str]) -> Column:
    names = _lookup(table)
    return F.transform(parts, lambda p: F.coalesce(F.try_element_at(names, p), p))


def expand_symbol(inner: Column) -> Column:
    """Plain words for the inside of one pair of braces."""
    phyrexian = _named(F.split(F.replace(inner, F.lit("/P"), F.lit("")), "/"), COLOURS)
    hybrid = _named(F.split(inner, "/"), _HYBRID_PART)
    return F.coalesce(
        F.try_element_at(_lookup(_WHOLE), inner),
        F.when(
            F.contains(inner, F.lit("/P")),
            F.concat(
                F.lit("Phyrexian "), F.array_join(phyrexian, "-"), F.lit(" mana ("),
                F.array_join(phyrexian, " or "), F.lit(" mana or 2 life)"),
            ),
        ),
        F.when(
            F.contains(inner, F.lit("/")),
            F.concat(F.lit("hybrid "), F.array_join(hybrid, " or "), F.lit(" mana")),
        ),
        inner,
    )


def _spaced(c: Column) -> Column:
    return F.replace(c, F.lit("}{"), F.lit("}, {"))


def plain_ascii(text: Column) -> Column:
    """Replace the known non-ASCII signs; other characters stay."""
    single = {a: b for a, b in NON_ASCII.items() if len(b) == 1}
    out = F.translate(text, "".join(single), "".join(single.values()))
    for sign, words in NON_ASCII.items():
        if sign not in single:
            out = F.replace(out, F.lit(sign), F.lit(words))
    return out


def expand_symbols(text: Column) -> Column:
    """Replace braced symbols and then the known signs, in one pass over the text."""

    in_braces = _lookup({f"{{{s}}}": words for s, words in _WHOLE.items()})
    signs = _lookup(NON_ASCII)

    def one(tok: Column) -> Column:
        inner = F.substr(tok, F.lit(2), F.length(tok) - 2)
        symbol = F.endswith(tok, F.lit("}"))
        return (
            F.when(
                F.startswith(tok, F.lit("{")),
                # Signs inside a symbol are replaced after the symbol is read.
                F.coalesce(
                    F.try_element_at(in_braces, tok),
                    F.when(symbol, plain_ascii(expand_symbol(inner))).otherwise(tok),
                ),
            )
            .when(F.octet_length(tok) <= 3, F.coalesce(F.try_element_at(signs, tok), tok))
            .otherwise(tok)
        )

    tokens = F.regexp_extract_all(_spaced(text), F.lit(_TOKENS), F.lit(0))
    return F.when(
        F.regexp(text, F.lit(_MARKED)), F.array_join(F.transform(tokens, one), "")
    ).otherwise(text)


def hide_name(text: Column, name: Column) -> Column:
    """Replace a record's own name, then the single parts of an ``A // B`` name."""
    name = F.coalesce(name, F.lit(""))
    whole = F.replace(text, name, F.lit(SELF_TOKEN))

    def drop(acc: Column, part: Column) -> Column:
        part = strip(part)
        return F.when(F.length(part) > 2, F.replace(acc, part, F.lit(SELF_TOKEN))).otherwise(acc)

    parts = F.when(F.contains(name, F.lit(" // ")), F.split(name, " // ")).otherwise(
        F.array().cast("array<string>")
    )
    return F.aggregate(parts, whole, drop)


def squeeze(text: Column) -> Column:
    """Runs of blanks and tabs become one blank; line breaks stay."""
    has_runs = F.contains(text, F.lit("  ")) | F.contains(text, F.lit("\t"))
    return strip(F.when(has_runs, F.regexp_replace(text, r"[ \t]+", " ")).otherwise(text))


def expand_notation(
    df: DataFrame,
    text_col: str,
    name_col: str | None = None,
    *,
    out_col: str = "clean_text",
    strip_reminder: bool = False,
) -> DataFrame:
    """Add ``out_col``: the text in plain language, ready for a model.

    Null and empty texts give ``''``. The steps run in a fixed order, each in
    its own projection so that no step is evaluated more than once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    if strip_reminder:
        text = F.regexp_replace(text, r"\(([^()]*)\)", "")
    df = df.withColumn(out_col, text)
    df = df.withColumn(out_col, expand_symbols(F.col(out_col)))
    if name_col is not None:
        df = df.withColumn(out_col, hide_name(F.col(out_col), F.col(name_col)))
    return df.withColumn(out_col, squeeze(F.col(out_col)))


# ---- Short columns ---------------------------------------------------------


def mana_cost(cost: Column) -> Column:
    """The symbols of a cost, in words, joined by commas."""
    inner = F.regexp_extract_all(F.coalesce(cost, F.lit("")), F.lit(r"\{([^}]+)\}"), F.lit(1))
    return F.array_join(F.transform(inner, expand_symbol), ", ")


# Decimal numbers as the stat columns spell them.
_NUMERIC = (
    r"(?U)^\s*[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)"
    r"(?:[eE][+-]?\d+(?:_\d+)*)?|(?i:inf|infinity|nan))\s*\z"
)


def _numeric(c: Column) -> Column:
    return F.coalesce(F.regexp(c, F.lit(_NUMERIC)), F.lit(False))


def _stat(c: Column, label: str) -> Column:
    known = F.try_element_at(_lookup(VARIABLE_STATS), c)
    return (
        F.when(c.isNull(), F.lit(""))
        .when(known.isNotNull(), F.concat(known, F.lit(f" {label}")))
        .when(_numeric(c), c)
        .otherwise(F.concat(c, F.lit(f" {label}")))
    )


def power_toughness(power: Column, toughness: Column) -> Column:
    """``p/t`` for two numbers, words with labels otherwise."""
    both = F.array(_stat(power, "power"), _stat(toughness, "toughness"))
    return F.when(
        _numeric(power) & _numeric(toughness), F.concat(power, F.lit("/"), toughness)
    ).otherwise(F.array_join(F.filter(both, lambda s: s != ""), " / "))


def loyalty(c: Column) -> Column:
    return (
        F.when(c.isNull(), F.lit(""))
        .when(c.isin("*", "X"), F.lit("variable loyalty"))
        .otherwise(F.concat(F.lit("Loyalty: "), c))
    )
