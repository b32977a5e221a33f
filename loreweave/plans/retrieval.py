"""From query texts or terms to ranked rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.functions.notation import expand_notation
from loreweave.operators.embedding import Backend
from loreweave.operators.ranking import top_k
from loreweave.operators.search import known_vectors, similar_batch
from loreweave.operators.taxonomy import expand_terms
from loreweave.sources.staging import stage


def embed_queries(queries: DataFrame, text: str, model: Backend) -> DataFrame:
    """Query texts in the plain language of the documents, with ``query_vector``."""
    clean = expand_notation(queries, text, out_col="_clean")
    return model.embed(clean, "_clean", "query_vector").drop("_clean")


def search_texts(
    queries: DataFrame, vectors: DataFrame, model: Backend, k: int = 5, *, cards: DataFrame | None = None,
) -> DataFrame:
    """Top-k of each query text (``query_id, text``); with ``cards``, only among vectors of cards."""
    pool = known_vectors(vectors, cards) if cards is not None else vectors
    return similar_batch(pool, embed_queries(queries, "text", model), k)


def merge_best(hits: DataFrame, searches: DataFrame, term: str, k: int) -> DataFrame:
    """Merge the searches of a term: best similarity per row, then top-k.

    A row among a term's k best is among the k best of one of its searches,
    so merging the searches' top-k loses nothing.
    """
    best = hits.join(searches, "query_id").groupBy(term, "id").agg(F.max("similarity").alias("similarity"))
    return top_k(best, [term], k, F.desc_nulls_last("similarity"), F.col("id"))


def fan_out(
    terms: DataFrame, taxonomy: DataFrame, vectors: DataFrame, model: Backend, k: int = 5,
) -> DataFrame:
    """Terms (``term``) → concepts → one search per hint → merged top-k per term.

    Each distinct hint is embedded and searched once, however many terms ask
    for it.
    """
    expanded = expand_terms(terms, taxonomy)
    asked = stage(expanded.select("term", F.col("hint").alias("query_id")).distinct(), "searches")
    hints = asked.select("query_id").distinct()
    searches = embed_queries(hints, "query_id", model).select("query_id", "query_vector")
    return merge_best(similar_batch(vectors, searches, k), asked, "term", k)
