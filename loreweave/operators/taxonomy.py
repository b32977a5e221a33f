"""Concept taxonomy as tables: aliases, hints, descriptions, query expansion.

A taxonomy has one row per concept. The key of a child is its parent's key
plus ``.`` and one more segment, so the ancestors of a concept can be read off
its key: descendants are found by an equi join, without recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Colour groups and their letters.
COLOUR_GROUPS = {
    "azorius": ["W", "U"], "dimir": ["U", "B"], "rakdos": ["B", "R"],
    "gruul": ["R", "G"], "selesnya": ["G", "W"], "orzhov": ["W", "B"],
    "izzet": ["U", "R"], "golgari": ["B", "G"], "boros": ["R", "W"],
    "simic": ["G", "U"],
    "bant": ["W", "U", "G"], "esper": ["W", "U", "B"], "grixis": ["U", "B", "R"],
    "jund": ["B", "R", "G"], "naya": ["R", "G", "W"],
    "abzan": ["W", "B", "G"], "jeskai": ["U", "R", "W"], "sultai": ["B", "G", "U"],
    "mardu": ["R", "W", "B"], "temur": ["G", "U", "R"],
}

# Abbreviations in query terms.
ABBREVIATIONS = {
    "ETB": "enters the battlefield", "LTB": "leaves the battlefield",
    "CMC": "mana value", "MV": "mana value", "P/T": "power and toughness",
    "GY": "graveyard", "WUBRG": "white blue black red green",
    "cEDH": "competitive commander", "EDH": "commander",
}


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy from one JSON tree: a list of nodes with ``children``.

    Nodes have ``key, name, aliases, description, oracle_hints, children``.
    Each level is taken off the variant by one explode, so a tree of depth d
    costs d narrow steps. ``dfs_ord`` is the place of a node in depth-first
    order, as the array of sibling positions from the root down: a parent
    sorts before its children and siblings sort in list order.
    """
    level = spark.read.text(path, wholetext=True).select(
        F.lit(None).cast("string").alias("parent_key"),
        F.array().cast("array<int>").alias("dfs_ord"),
        F.parse_json("value").cast("array<variant>").alias("nodes"),
    )
    out = None
    while True:
        rows = level.select("parent_key", "dfs_ord", F.posexplode("nodes").alias("pos", "node"))
        rows = rows.select(
            F.variant_get("node", "$.key", "string").alias("key"),
            "parent_key",
            F.variant_get("node", "$.name", "string").alias("name"),
            F.size("dfs_ord").alias("depth"),
            F.array_append("dfs_ord", F.col("pos")).alias("dfs_ord"),
            F.coalesce(F.variant_get("node", "$.aliases", "array<string>"), _no_strings()).alias("aliases"),
            F.variant_get("node", "$.description", "string").alias("description"),
            F.coalesce(F.variant_get("node", "$.oracle_hints", "array<string>"), _no_strings()).alias("oracle_hints"),
            F.coalesce(F.variant_get("node", "$.children", "array<variant>"), F.array().cast("array<variant>")).alias("children"),
        )
        nodes = rows.drop("children")
        out = nodes if out is None else out.unionByName(nodes)
        level = rows.filter(F.size("children") > 0).select(
            F.col("key").alias("parent_key"), "dfs_ord", F.col("children").alias("nodes")
        )
        if level.isEmpty():
            return out


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def walk(taxonomy: DataFrame) -> DataFrame:
    """Concepts in depth-first order, parents before children."""
    return taxonomy.orderBy("dfs_ord")


def node(taxonomy: DataFrame, key: str) -> DataFrame:
    return taxonomy.filter(F.col("key") == key)


def alias_map(taxonomy: DataFrame) -> DataFrame:
    """``alias, key`` with aliases in lower case; the last concept in order wins."""
    pairs = taxonomy.select(F.explode("aliases").alias("alias"), "key", "dfs_ord")
    return (
        pairs.groupBy(F.lower("alias").alias("alias"))
        .agg(F.max(F.struct("dfs_ord", "key")).alias("last"))
        .select("alias", F.col("last.key").alias("key"))
    )


def with_ancestors(taxonomy: DataFrame) -> DataFrame:
    """Every concept once per ancestor (and itself), in the column ``ancestor``."""
    parts = F.split("key", r"\.")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."),
    )
    return taxonomy.withColumn("ancestor", F.explode(ancestors))


def hints_below(taxonomy: DataFrame) -> DataFrame:
    """Hints of each concept and all below it: ``ancestor, key, dfs_ord, pos, hint``.

    Order by ``(dfs_ord, pos)`` for depth-first order; repeated hints are kept.
    """
    return with_ancestors(taxonomy).select(
        "ancestor", "key", "dfs_ord", F.posexplode("oracle_hints").alias("pos", "hint")
    )


def descriptions_below(taxonomy: DataFrame) -> DataFrame:
    return with_ancestors(taxonomy).select("ancestor", "key", "dfs_ord", "description")


def match_terms(terms: DataFrame, aliases: DataFrame, term: str = "term") -> DataFrame:
    """Terms that are, as a whole and in any case, an alias of a concept."""
    return terms.join(
        aliases.withColumnRenamed("alias", "_alias"), F.lower(term) == F.col("_alias")
    ).drop("_alias")


def expand_terms(terms: DataFrame, taxonomy: DataFrame, term: str = "term") -> DataFrame:
    """``term, key, hint``: the distinct hints that each distinct term fans out to."""
    matched = match_terms(terms.select(term).distinct(), alias_map(taxonomy), term)
    below = hints_below(taxonomy).select(F.col("ancestor").alias("key"), "hint")
    return matched.join(below, "key").select(term, "key", "hint").distinct()


def expand_abbreviations(df: DataFrame, term: str, table: DataFrame | None = None) -> DataFrame:
    """``full_term``: the expansion of a term that is an abbreviation, else the term."""
    if table is None:
        names = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
        return df.withColumn("full_term", F.coalesce(F.try_element_at(names, F.col(term)), F.col(term)))
    wide = df.join(table.select(F.col("abbr").alias(term), "expansion"), term, "left")
    return wide.withColumn("full_term", F.coalesce("expansion", F.col(term))).drop("expansion")


def colour_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COLOUR_GROUPS.items()), "name string, colours array<string>")


def abbreviations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ABBREVIATIONS.items()), "abbr string, expansion string")


def colours_match(colours: Column, wanted: Column, mode: str = "contains_all") -> Column:
    """Compare a row's colours with a group's.

    ``contains_all``: all of the group's colours; ``contained_by``: no others;
    ``exact``: both.
    """
    has_all = F.size(F.array_except(wanted, colours)) == 0
    no_other = F.size(F.array_except(colours, wanted)) == 0
    modes = {"contains_all": has_all, "contained_by": no_other, "exact": has_all & no_other}
    if mode not in modes:
        raise ValueError(f"unknown colour comparison: {mode}")
    return modes[mode]


def colour_filter(cards: DataFrame, group: str, colours: str = "color_identity",
                  mode: str = "contains_all") -> DataFrame:
    if group.lower() not in COLOUR_GROUPS:
        raise ValueError(f"unknown colour group: {group}")
    wanted = F.array(*[F.lit(c) for c in COLOUR_GROUPS[group.lower()]])
    return cards.filter(colours_match(F.col(colours), wanted, mode))
