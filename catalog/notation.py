"""Rewriting notation into plain language."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import Catalog, table, texts
from loreweave.functions import notation as T

catalog = Catalog()

# The documents hold no notation of their own: both sides write it into the
# whole texts in place of frequent words, one kind of symbol for each word.
WRITTEN = [
    (" the ", " {T}: {2}{R} "), (" of ", " {S}{20} ({Q} or {100}) "), (" and ", " {} {ZZ}\t \t{E}{E} "),
    (" in ", " {2/U} − {W/P} "), (" la ", " {G/W/P}{½} "), (" de ", " — {X} • {B/C} "),
    (" und ", " {HR}² → {{Q} "), (" que ", " (see {P/7}) {1000000} "), (" die ", " {21}{G/} ½ ∞ "),
]

# What each written symbol has to become, worked out by hand from the rules.
EXPECTED = [
    ("{T}", "Tap (tap this permanent)"), ("{2}", "two generic mana"), ("{R}", "red mana"),
    ("{S}", "snow mana"), ("{20}", "twenty generic mana"), ("{{Q}", "{Q"), ("{Q}", "Untap (untap this permanent)"),
    ("{100}", "one hundred generic mana"), ("{ZZ}", "ZZ"), ("{E}", "energy (energy counter)"),
    ("{2/U}", "hybrid two generic or blue mana"), ("{W/P}", "Phyrexian white mana (white mana or 2 life)"),
    ("{G/W/P}", "Phyrexian green-white mana (green or white mana or 2 life)"), ("{½}", "half"),
    ("{X}", "X (variable amount)"), ("{B/C}", "hybrid black or colorless mana"), ("{HR}", "heart"),
    ("{P/7}", "hybrid P or seven generic mana"), ("{1000000}", "one million generic mana"),
    ("{21}", "21"), ("{G/}", "hybrid green or  mana"),
    ("—", " -- "), ("•", " * "), ("−", "-"), ("½", "1/2"), ("²", "squared"), ("→", "->"), ("∞", "infinity"),
    ("º", "o"), ("¹", "^1"), ("³", "cubed"),
]


def written_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in notation, named by their first word or first two words."""
    docs = texts(spark, sf, "doc_id", "lang", "text")
    text = reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), WRITTEN, F.col("text"))
    first, second = (F.split_part("text", F.lit(" "), F.lit(n)) for n in (1, 2))
    name = F.when(F.col("lang").isin("en", "fr"), F.concat(first, F.lit(" // "), second)).otherwise(first)
    return docs.select("doc_id", name.alias("name"), text.alias("raw"))


def _nested(inner: str, pairs) -> str:
    return reduce(lambda t, p: f"replace({t}, '{p[0]}', '{p[1]}')", pairs, inner)


_RAW = f"""
WITH raw AS (
  SELECT doc_id, {_nested("text", WRITTEN).replace(chr(9), "' || chr(9) || '")} AS raw,
         split_part(text, ' ', 1) AS w1, split_part(text, ' ', 2) AS w2,
         lang IN ('en', 'fr') AS two
  FROM documents
)"""
_SPACED = "replace(raw, '}{', '}, {')"


def _tidy(t: str) -> str:
    return f"trim(regexp_replace({t}, '[ \\t]+', ' ', 'g'), ' ' || chr(9) || chr(10))"


@catalog.add(_RAW + f""", plain AS (
  SELECT *, {_nested(_SPACED, EXPECTED)} AS t FROM raw
), hidden AS (
  SELECT doc_id, w1, w2, two, replace(t, CASE WHEN two THEN w1 || ' // ' || w2 ELSE w1 END, 'this card') AS t FROM plain
), part1 AS (
  SELECT *, CASE WHEN two AND length(trim(w1, ' ' || chr(10))) > 2
                 THEN replace(t, trim(w1, ' ' || chr(10)), 'this card') ELSE t END AS t1 FROM hidden
), part2 AS (
  SELECT *, CASE WHEN two AND length(trim(w2, ' ' || chr(10))) > 2
                 THEN replace(t1, trim(w2, ' ' || chr(10)), 'this card') ELSE t1 END AS t2 FROM part1
)
SELECT doc_id, {_tidy('t2')} AS clean_text FROM part2""")
def expand_notation(spark: SparkSession, sf: str) -> DataFrame:
    rows = written_texts(spark, sf)
    return T.expand_notation(rows, "raw", "name").select("doc_id", "clean_text")


@catalog.add(_RAW + f"""
SELECT doc_id, {_tidy(_nested("replace(regexp_replace(raw, '[(][^()]*[)]', '', 'g'), '}{', '}, {')", EXPECTED))} AS clean_text
FROM raw""")
def expand_notation_no_reminder(spark: SparkSession, sf: str) -> DataFrame:
    rows = written_texts(spark, sf)
    return T.expand_notation(rows, "raw", strip_reminder=True).select("doc_id", "clean_text")


# ---- Short columns, on the parts ---------------------------------------------


def _cost() -> Column:
    first = F.upper(F.substring("p_name", 1, 1))
    brand = F.regexp_extract("p_brand", r"\d+", 0)
    return F.concat(F.lit("cost {"), F.col("p_size").cast("string"), F.lit("}{"), first, F.lit("}{"),
                    first, F.lit("/P} or {"), brand, F.lit("/"), first, F.lit("}"))


# Fixed values.
_NUMBER_LIST = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
    "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty",
]
_WORD = "CASE {0} " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(_NUMBER_LIST)) + " END"


@catalog.add(f"""
WITH p AS (
  SELECT p_partkey, upper(substr(p_name, 1, 1)) AS c, p_size,
         CAST(regexp_extract(p_brand, '\\d+') AS INTEGER) AS brand FROM part
), named AS (
  SELECT *, CASE c WHEN 'R' THEN 'red' WHEN 'B' THEN 'black' WHEN 'C' THEN 'colorless' WHEN 'W' THEN 'white'
                   WHEN 'G' THEN 'green' WHEN 'U' THEN 'blue' ELSE c END AS colour,
         coalesce({_WORD.format('p_size')} || ' generic mana', CAST(p_size AS VARCHAR)) AS w,
         coalesce({_WORD.format('brand')} || ' generic', CAST(brand AS VARCHAR)) AS b FROM p
)
SELECT p_partkey, w || ', ' || CASE c
    WHEN 'S' THEN 'snow mana' WHEN 'R' THEN 'red mana' WHEN 'B' THEN 'black mana' WHEN 'C' THEN 'colorless mana'
    WHEN 'H' THEN 'Phyrexian mana (paid with mana or 2 life)'
    WHEN 'L' THEN 'legendary mana (paid with mana from a legendary source)' ELSE c END
  || ', Phyrexian ' || colour || ' mana (' || colour || ' mana or 2 life), hybrid ' || b || ' or ' || colour || ' mana' AS cost_text
FROM named""")
def mana_cost(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", T.mana_cost(_cost()).alias("cost_text"))


def _stat(kind: str, of: str, size: str) -> str:
    """The same CASE for both engines: a stat that is special, numeric, signed, odd or missing."""
    specials = {"power": ("*", "1+*", "X"), "toughness": ("7-*", "∞", "1_0x")}[kind]
    first, second, third = specials
    return (f"CASE {of} WHEN 'ECONOMY' THEN '{first}' WHEN 'PROMO' THEN '{second}' WHEN 'SMALL' THEN '{third}' "
            f"WHEN 'LARGE' THEN NULL WHEN 'MEDIUM' THEN '+' || {size} ELSE {size} END")


_PT = (_stat("power", "p_type", "CAST(p_size AS STRING)"),
       _stat("toughness", "CASE WHEN p_size > 25 THEN p_type ELSE 'STANDARD' END", "CAST(p_size AS STRING)"))


@catalog.add(f"""
WITH s AS (SELECT p_partkey, {_PT[0]} AS p, {_PT[1]} AS t FROM part),
n AS (SELECT *, coalesce(regexp_full_match(p, '[+-]?[0-9.]+'), false) AS pn,
             coalesce(regexp_full_match(t, '[+-]?[0-9.]+'), false) AS tn FROM s),
w AS (SELECT *, CASE WHEN p IS NULL THEN '' WHEN pn THEN p ELSE
        (CASE p WHEN '*' THEN 'variable' WHEN '1+*' THEN 'one plus variable' ELSE p END) || ' power' END AS pw,
      CASE WHEN t IS NULL THEN '' WHEN tn THEN t ELSE
        (CASE t WHEN '7-*' THEN 'seven minus variable' WHEN '∞' THEN 'infinity' ELSE t END) || ' toughness' END AS tw FROM n)
SELECT p_partkey, CASE WHEN pn AND tn THEN p || '/' || t WHEN pw = '' THEN tw WHEN tw = '' THEN pw
                       ELSE pw || ' / ' || tw END AS stats FROM w""")
def power_toughness(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").withColumns({"p": F.expr(_PT[0]), "t": F.expr(_PT[1])})
    return parts.select("p_partkey", T.power_toughness(F.col("p"), F.col("t")).alias("stats"))


@catalog.add(f"""
SELECT p_partkey, CASE WHEN p IS NULL THEN '' WHEN p IN ('*', 'X') THEN 'variable loyalty' ELSE 'Loyalty: ' || p END AS loyalty
FROM (SELECT p_partkey, {_PT[0]} AS p FROM part)""")
def loyalty(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    return parts.select("p_partkey", T.loyalty(F.expr(_PT[0])).alias("loyalty"))
