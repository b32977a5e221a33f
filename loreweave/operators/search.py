"""Lookup, phrase search, filters, and exact vector top-k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.functions.vectors import cosine_to, id_face, id_oracle
from loreweave.operators.kernel import matcher
from loreweave.operators.matching import occurrences
from loreweave.operators.ranking import top_k
from loreweave.sources.staging import stage

# Decimals of a similarity that count: what differs only beyond them (the order
# in which a sum was taken) is a tie, and ties go to the smaller id.
DIGITS = 12

# Numbers in one block of query vectors (64 MB in doubles).
BLOCK_FLOATS = 8_000_000


# ---- Lookup and text -------------------------------------------------------


def lookup(df: DataFrame, column: str, values: DataFrame, value: str) -> DataFrame:
    """Batch equality lookup: each wanted value with its number of matches (0 if none).

    Rows are counted per value before they are joined, so a value that holds a
    large part of the table is one row per task.
    """
    counts = df.groupBy(F.col(column).alias(value)).agg(F.count("*").alias("n"))
    return values.join(counts, value, "left").select(
        value, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.col("n").isNotNull().alias("found")
    )


def find(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with one of a few exact values; the test is pushed into the scan."""
    return df.filter(F.col(column).isin(list(values)))


def phrase_counts(df: DataFrame, text_col: str, phrases: DataFrame) -> DataFrame:
    """Rows whose text contains each phrase, in any case: ``phrase, n``; ``phrases`` has ``phrase``.

    ``%`` and ``_`` in a phrase are wildcards. A phrase meets the texts that
    hold its longest plain part, and only these run its pattern. Phrases of
    wildcards alone ask for a number of characters.
    """
    plain = F.transform(
        F.regexp_extract_all("_low_phrase", F.lit(r"(?s)(?:\\.|[^%_\\])+"), F.lit(0)),
        lambda part: F.regexp_replace(part, r"(?s)\\(.)", "$1"),
    )
    longest = F.reduce(plain, F.lit(""), lambda a, b: F.when(F.length(b) > F.length(a), b).otherwise(a))
    asked = phrases.select("phrase").distinct().withColumn("_low_phrase", F.lower("phrase"))
    asked = asked.withColumn("_anchor", longest).withColumn("_like", F.concat(F.lit("%"), "_low_phrase", F.lit("%")))
    texts = df.select(F.lower(text_col).alias("_low"))
    rows = texts.withColumn("_row", F.monotonically_increasing_id())
    # A plain phrase is its own longest part.
    found = occurrences(rows, "_low", asked, "_anchor").filter(F.expr("_anchor = _low_phrase or _low like _like"))
    counts = found.select("_row", "phrase").distinct().groupBy("phrase").agg(F.count("*").alias("n"))

    wild = asked.filter("_anchor = ''").select("phrase", F.length(F.replace("_low_phrase", F.lit("%"), F.lit(""))).alias("least"))
    lengths = sorted(r[0] for r in wild.select("least").distinct().collect())
    if lengths:
        tests = [F.count_if(F.length("_low") >= k).alias(str(k)) for k in lengths]
        by_length = texts.agg(*tests).select(
            F.inline(F.array(*[F.struct(F.lit(k).alias("least"), F.col(str(k)).alias("n")) for k in lengths]))
        )
        counts = counts.unionByName(wild.join(by_length, "least").select("phrase", "n"))
    return phrases.select("phrase").join(counts, "phrase", "left").select("phrase", F.coalesce("n", F.lit(0)).alias("n"))


def has_all(array: Column, values: Sequence[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(v) for v in values]), array)) == 0


def has_any(array: Column, values: Sequence[str]) -> Column:
    return F.arrays_overlap(array, F.array(*[F.lit(v) for v in values]))


def is_legal(legalities: Column, game_format: str, status: str = "Legal") -> Column:
    return F.coalesce(F.try_element_at(legalities, F.lit(game_format)) == status, F.lit(False))


# ---- One query vector ------------------------------------------------------


def similar(
    vectors: DataFrame, query: Sequence[float], k: int = 5,
    *, id_col: str = "id", vector_col: str = "embedding", keep: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` nearest rows to one vector; rows without a vector do not take part.

    Ties go to the smaller id. A vector of length zero ranks last.
    """
    scored = _scored(vectors, query, vector_col).select(id_col, *keep, "similarity")
    return scored.orderBy(F.desc_nulls_last("similarity"), id_col).limit(k)


def similar_cards(
    vectors: DataFrame, cards: DataFrame, query: Sequence[float], k: int = 5,
) -> DataFrame:
    """The ``k`` nearest vectors that belong to a card, with the card's name.

    The join comes before the limit, so vectors without a card use up no
    place; it moves ids and similarities only, never the vectors.
    """
    scored = _scored(vectors, query, "embedding").select(
        "id", "chunk_index", "similarity",
        id_oracle(F.col("id")).alias("scryfall_oracle_id"), id_face(F.col("id")).alias("face_index"),
    )
    named = scored.join(
        cards.select("scryfall_oracle_id", "face_index", "name"), ["scryfall_oracle_id", "face_index"]
    )
    best = named.orderBy(F.desc_nulls_last("similarity"), "id", "chunk_index").limit(k)
    texts = vectors.select("id", "chunk_index", "chunk_text")
    return (
        texts.join(F.broadcast(best), ["id", "chunk_index"])  # k rows
        .select("id", "name", "chunk_text", "similarity")
        .orderBy(F.desc_nulls_last("similarity"), "id")
    )


def _scored(vectors: DataFrame, query: Sequence[float], vector_col: str) -> DataFrame:
    kept = vectors.filter(F.col(vector_col).isNotNull())
    return kept.withColumn("similarity", cosine_to(query, DIGITS)(F.col(vector_col)))


CARD_SOURCES = ("card_name", "card_text")


def vector_search(
    vectors: DataFrame, cards: DataFrame | None, query: Sequence[float], source: str, k: int = 5,
) -> DataFrame:
    """Top-k in one source: card sources are joined to the cards, rules are not."""
    if source in CARD_SOURCES:
        return similar_cards(vectors.filter(F.col("source") == source), cards, query, k)
    if source == "rules":
        rules = vectors.filter(F.col("source") == source)
        return similar(rules, query, k, keep=["chunk_text"])
    raise ValueError(f"unknown source: {source}")


# ---- Many query vectors ----------------------------------------------------


def known_vectors(vectors: DataFrame, cards: DataFrame) -> DataFrame:
    """Vectors that belong to a card.

    Ids are compared first, without the vectors; the ids without a card are
    written down, and the vectors leave out those. As long as they are few,
    Spark broadcasts them and no vector is shuffled.
    """
    ids = vectors.select("id").distinct()
    keys = cards.select("scryfall_oracle_id", "face_index")
    orphans = ids.withColumns({
        "scryfall_oracle_id": id_oracle(F.col("id")), "face_index": id_face(F.col("id")),
    }).join(keys, ["scryfall_oracle_id", "face_index"], "left_anti")
    return vectors.join(stage(orphans.select("id"), "orphans"), "id", "left_anti")


def similar_batch(
    vectors: DataFrame, queries: DataFrame, k: int = 5,
    *, id_col: str = "id", vector_col: str = "embedding",
    query_id: str = "query_id", query_vector: str = "query_vector",
    cell: str | None = None, block_floats: int = BLOCK_FLOATS,
) -> DataFrame:
    """Exact top-k of every query: ``query_id, id, similarity, rank``.

    Queries go in blocks of at most about ``block_floats`` numbers to all
    vectors, which stay where they are. Each task multiplies its own vectors
    with the block and keeps k candidates per query, so pairs are never
    materialised and only ``k × queries`` rows per task reach the ranking.

    With ``cell`` (a column of both sides) a query meets only the vectors of
    its own cells; a query takes part once per cell row. Vectors whose width
    differs from the queries' raise an error that names the widths.
    """
    base = vectors.filter(F.col(vector_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.col(vector_col).alias("vector"),
        (F.col(cell).cast("int") if cell else F.lit(0)).alias("cell"),
    )
    wanted = queries.filter(F.col(query_vector).isNotNull()).select(
        F.col(query_id).alias("query_id"),
        F.col(query_vector).cast("array<float>").alias("query_vector"),
        (F.col(cell).cast("int") if cell else F.lit(0)).alias("cell"),
    )
    out = T.StructType([
        wanted.schema["query_id"], base.schema["id"], T.StructField("similarity", T.DoubleType()),
    ])
    wanted = stage(wanted, "queries")
    size = wanted.agg(F.sum(F.size("query_vector")), F.max(F.size("query_vector"))).first()
    blocks = max(1, -(-(size[0] or 0) // block_floats))
    number = F.pmod(F.xxhash64("query_id", "query_vector"), F.lit(blocks))
    each = (wanted.filter(number == b).toArrow() for b in range(blocks))
    found = [_match_block(base, rows, size[1], k, out) for rows in each if rows.num_rows]
    partial = reduce(DataFrame.union, found) if found else base.sparkSession.createDataFrame([], out)
    order = (F.desc_nulls_last("similarity"), F.col("id"))
    return top_k(partial, ["query_id"], k, *order)


def _match_block(base: DataFrame, rows: pa.Table, width: int, k: int, out: T.StructType) -> DataFrame:
    """One block of queries, broadcast to the vectors where they lie."""
    vectors = rows.column("query_vector").combine_chunks()
    if (pc.list_value_length(vectors).to_numpy() != width).any():
        raise ValueError(f"query vectors differ in width; the widest has {width}")
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1).astype("float64")
    cells = rows.column("cell").to_numpy()
    shared = base.sparkSession.sparkContext.broadcast((rows.column("query_id").combine_chunks(), matrix, cells))
    match = matcher(k, DIGITS)

    def run(batches):
        for found in match(batches, *shared.value):
            yield from found.to_batches()

    # Vectors of cells that no query of the block asks for are not sent to Python.
    asked = sorted(set(cells.tolist()))
    return base.filter(F.col("cell").isin(asked)).mapInArrow(run, out)


def top1_check(hits: DataFrame, expected: DataFrame) -> DataFrame:
    """Best hit against the expected id per query: ``query_id, found, expected, ok``."""
    best = hits.filter(F.col("rank") == 1).select("query_id", F.col("id").alias("found"))
    return expected.join(best, "query_id", "left").withColumn(
        "ok", F.col("found").eqNullSafe(F.col("expected"))
    )
