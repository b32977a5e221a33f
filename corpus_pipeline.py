"""The corpus pipeline: documents through five operators, one written table after the other.

Stages: drop texts without a recognisable language, drop lines that repeat over
documents, keep one document of each near-duplicate group, mix the sources to
their weights, pack into power-of-two pieces. All but the last return the
columns of documents. Repeated ids are told apart only where a stage says so.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import Catalog, table
from loreweave.llm import language, linedup, mixing, packing, simhash
from loreweave.llm.queries import tokenizer_path
from loreweave.operators.ranking import keep_first
from loreweave.sources.staging import stage

#: A text stays if its best language has at least this posterior probability.
LEAST_SCORE = 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a recognised language; null texts and texts without letters go."""
    models = language.fit_models(
        docs, "text", "lang", F.xxhash64(F.col("doc_id").cast("string")),
        language.load_pieces(tokenizer_path("piece_bpe_32k.model")),
    )
    found = language.predict(docs, "text", models)
    return found.filter((F.col("lang_pred") != language.NONE) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat over documents; ``n_chars`` follows the text."""
    found = linedup.dedup_lines(docs, "doc_id", "text")
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    found = found.select("row", "n_dropped", text.alias("kept"))
    changed = F.col("n_dropped") > 0
    columns = {
        "text": F.col("kept"),
        "n_chars": F.when(changed, F.length("kept").cast("bigint")).otherwise(F.col("row.n_chars")),
    }
    return found.select(*[columns.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that differ by no more than two bits, the one with the least id.

    A document is an id with its text: equal rows are one, rows that share only
    the id are told apart by their text. A row with a null id stays only if its
    group has no other.
    """

    def place(doc_id: Column, text: Column) -> Column:
        return F.struct(doc_id.isNull().alias("nameless"), doc_id.alias("doc_id"), F.md5(F.coalesce(text, F.lit(""))).alias("text_md5"))

    named = docs.select(place(F.col("doc_id"), F.col("text")).alias("place"), "text")
    groups = simhash.near_duplicates(named, "place", "text")
    stays = stage(groups.select(F.to_json("component_id").alias("stays")).distinct(), "stays")
    # One row per document first: what this deals out serves the join as well.
    keyed = docs.withColumn("_place", F.to_json(place(F.col("doc_id"), F.col("text"))))
    one = keep_first(keyed, ["_place"], F.col("text"))
    return one.join(stays, F.col("_place") == F.col("stays"), "left_semi").drop("_place")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs, "doc_id", "source", "text")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, each a sequence by itself."""
    packed = packing.pack(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Languages, fingerprints and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


catalog = Catalog()


@catalog.add(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
