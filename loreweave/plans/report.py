"""The acceptance report of a knowledge base: eight checks with a verdict each."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.operators import checks as K
from loreweave.operators import search as S
from loreweave.operators.embedding import Backend
from loreweave.plans.retrieval import search_texts
from loreweave.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Expectations:
    """What a full load has to show. The defaults."""

    min_rows: int = 30000
    names: tuple[str, ...] = ("Lightning Bolt", "Counterspell", "Sol Ring", "Black Lotus")
    phrases: Mapping[str, int] = field(default_factory=lambda: {
        "destroy target creature": 20, "draw a card": 50, "can't be blocked": 10, "flying": 50,
        "lose all abilities": 3,
    })
    coverage: Mapping[str, int] = field(default_factory=lambda: {
        "card_name": 30000, "card_text": 30000, "rules": 500,
    })
    name_queries: tuple[str, ...] = ("Lightning Bolt", "Counterspell", "Wrath of God")
    text_queries: tuple[str, ...] = (
        "destroy all creatures", "counter target spell", "can't be blocked", "deals 3 damage to any target",
    )
    rule_queries: tuple[str, ...] = (
        "what can block a creature with flying", "what happens when a creature is destroyed",
        "how does trample damage work", "what does hexproof protect against",
    )


def run_checks(store: Warehouse, model: Backend, want: Expectations = Expectations()) -> DataFrame:
    """``name, verdict``: pass, fail, or skip where a source has no vectors."""
    spark = store.spark
    cards = store.cards()

    def all_ok(df: DataFrame):
        return df.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"), F.lit(False).alias("empty"))

    def queries(texts) -> DataFrame:
        return spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")

    names = spark.createDataFrame([(n,) for n in want.names], "name string")
    phrases = spark.createDataFrame(list(want.phrases.items()), "phrase string, min_count int")
    expected = spark.createDataFrame(list(want.coverage.items()), "source string, min_count int")
    found = S.phrase_counts(cards, "oracle_text", phrases)
    checks = {
        "foundation": all_ok(K.foundation(
            cards, "scryfall_oracle_id", "face_index", "content_hash", min_rows=want.min_rows)),
        "sync_log": all_ok(K.successes(store.sync_log())),
        "exact_name": all_ok(S.lookup(cards, "name", names, "name").withColumnRenamed("found", "ok")),
        "text_phrase": all_ok(K.coverage(found, phrases, "phrase")),
        "embedding_coverage": all_ok(K.coverage(K.source_counts(store.all_vectors()), expected)),
        "vec_card_name": _top_names(store, model, queries(want.name_queries)),
        "vec_card_text": _any_hits(store, model, "card_text", queries(want.text_queries), 5),
        "vec_rules": _any_hits(store, model, "rules", queries(want.rule_queries), 3),
    }
    out = None
    for name, df in checks.items():
        row = df.select(F.lit(name).alias("name"), K.verdict(F.col("ok"), F.col("empty")).alias("verdict"))
        out = row if out is None else out.unionByName(row)
    return out


def _top_names(store: Warehouse, model: Backend, queries: DataFrame) -> DataFrame:
    """Each name has to find itself first; its own text is what is expected."""
    vectors = store.vectors("card_name")
    hits = search_texts(queries, vectors, model, 1, cards=store.cards())
    named = hits.join(vectors.select("id", "chunk_text"), "id")
    ok = queries.join(named, "query_id", "left").select(
        F.col("chunk_text").eqNullSafe(F.col("text")).alias("ok")
    )
    return ok.agg(F.bool_and("ok").alias("ok"), F.lit(vectors.isEmpty()).alias("empty"))


def _any_hits(store: Warehouse, model: Backend, source: str, queries: DataFrame, k: int) -> DataFrame:
    vectors = store.vectors(source)
    cards = store.cards() if source in S.CARD_SOURCES else None
    hits = search_texts(queries, vectors, model, k, cards=cards)
    return hits.agg((F.count("*") > 0).alias("ok"), F.lit(vectors.isEmpty()).alias("empty"))
