"""Table layouts and the fixed column and key lists."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, FloatType, IntegerType, LongType, MapType, StringType, StructField, StructType,
    TimestampType,
)

STRING, INT, LONG, FLOAT = StringType(), IntegerType(), LongType(), FloatType()
BOOLEAN, TIMESTAMP = BooleanType(), TimestampType()
STRINGS, TEXTS = ArrayType(STRING), MapType(STRING, STRING)
RULINGS = ArrayType(StructType([StructField("date", STRING), StructField("text", STRING)]))

# Source keys that take part in the content hash.
HASHED_KEYS = [
    "colorIdentity", "colorIndicator", "colors", "defense", "faceManaValue",
    "faceName", "hand", "hasAlternativeDeckLimit", "identifiers", "isFunny",
    "isGameChanger", "isReserved", "keywords", "layout", "leadershipSkills",
    "legalities", "life", "loyalty", "manaCost", "manaValue", "name", "power",
    "producedMana", "relatedCards", "rulings", "side", "subsets", "subtypes",
    "supertypes", "text", "toughness", "type", "types",
]


# The typed view of one source face. Fields left out here
# (translations, deprecated duplicates) are never materialised.
FACE = StructType([
    StructField("name", STRING),
    StructField("faceName", STRING),
    StructField("side", STRING),
    StructField("layout", STRING),
    StructField("manaCost", STRING),
    StructField("manaValue", FLOAT),
    StructField("faceManaValue", FLOAT),
    StructField("colors", STRINGS),
    StructField("colorIdentity", STRINGS),
    StructField("colorIndicator", STRINGS),
    StructField("type", STRING),
    StructField("supertypes", STRINGS),
    StructField("types", STRINGS),
    StructField("subtypes", STRINGS),
    StructField("power", STRING),
    StructField("toughness", STRING),
    StructField("loyalty", STRING),
    StructField("defense", STRING),
    StructField("hand", STRING),
    StructField("life", STRING),
    StructField("text", STRING),
    StructField("keywords", STRINGS),
    StructField("legalities", TEXTS),
    StructField("leadershipSkills", MapType(STRING, BOOLEAN)),
    StructField("rulings", RULINGS),
    StructField("purchaseUrls", TEXTS),
    StructField("relatedCards", MapType(STRING, STRINGS)),
    StructField("printings", STRINGS),
    StructField("producedMana", STRINGS),
    StructField("subsets", STRINGS),
    StructField("isFunny", BOOLEAN),
    StructField("isGameChanger", BOOLEAN),
    StructField("isReserved", BOOLEAN),
    StructField("hasAlternativeDeckLimit", BOOLEAN),
    StructField("edhrecRank", INT),
    StructField("edhrecSaltiness", FLOAT),
    StructField("firstPrinting", STRING),
])

# Columns of the card table, in load order.
CARDS = StructType([
    StructField("scryfall_oracle_id", STRING),
    StructField("face_index", INT),
    StructField("name", STRING),
    StructField("face_name", STRING),
    StructField("side", STRING),
    StructField("layout", STRING),
    StructField("mana_cost", STRING),
    StructField("mana_value", FLOAT),
    StructField("face_mana_value", FLOAT),
    StructField("colors", STRINGS),
    StructField("color_identity", STRINGS),
    StructField("color_indicator", STRINGS),
    StructField("type_line", STRING),
    StructField("supertypes", STRINGS),
    StructField("types", STRINGS),
    StructField("subtypes", STRINGS),
    StructField("power", STRING),
    StructField("toughness", STRING),
    StructField("loyalty", STRING),
    StructField("defense", STRING),
    StructField("hand", STRING),
    StructField("life", STRING),
    StructField("oracle_text", STRING),
    StructField("keywords", STRINGS),
    StructField("legalities", TEXTS),
    StructField("leadership_skills", MapType(STRING, BOOLEAN)),
    StructField("rulings", RULINGS),
    StructField("purchase_urls", TEXTS),
    StructField("related_cards", MapType(STRING, STRINGS)),
    StructField("printings", STRINGS),
    StructField("produced_mana", STRINGS),
    StructField("subsets", STRINGS),
    StructField("is_funny", BOOLEAN),
    StructField("is_game_changer", BOOLEAN),
    StructField("is_reserved", BOOLEAN),
    StructField("has_alt_deck_limit", BOOLEAN),
    StructField("edhrec_rank", INT),
    StructField("edhrec_saltiness", FLOAT),
    StructField("content_hash", STRING),
    StructField("first_printing", STRING),
    StructField("source_version", STRING),
    StructField("updated_at", TIMESTAMP),
])
CARD_COLUMNS = [c for c in CARDS.fieldNames() if c != "updated_at"]
CARD_KEY = ["scryfall_oracle_id", "face_index"]
CARD_REQUIRED = [
    "scryfall_oracle_id", "face_index", "name", "layout", "mana_value", "type_line",
    "legalities", "rulings", "purchase_urls", "is_funny", "is_game_changer",
    "is_reserved", "has_alt_deck_limit", "content_hash", "updated_at",
]

# The vector table, the logs and the concept tree.
VECTORS = StructType([
    StructField("id", STRING),
    StructField("source", STRING),
    StructField("chunk_index", INT),
    StructField("chunk_text", STRING),
    StructField("chunk_hash", STRING),
    StructField("embedding", ArrayType(FLOAT)),
    StructField("model", STRING),
    StructField("updated_at", TIMESTAMP),
])
VECTOR_KEY = ["id", "source", "chunk_index"]
VECTOR_REQUIRED = [c for c in VECTORS.fieldNames() if c != "embedding"]

SYNC_LOG = StructType([
    StructField("id", INT),
    StructField("started_at", TIMESTAMP),
    StructField("finished_at", TIMESTAMP),
    StructField("source_version", STRING),
    StructField("source_sha256", STRING),
    StructField("total_cards", LONG),
    StructField("inserted", LONG),
    StructField("updated", LONG),
    StructField("unchanged", LONG),
    StructField("deleted", LONG),
    StructField("status", STRING),
])

EMBED_LOG = StructType([
    StructField("id", INT),
    StructField("source", STRING),
    StructField("model", STRING),
    StructField("embedded", LONG),
    StructField("finished_at", TIMESTAMP),
])

TAXONOMY = StructType([
    StructField("key", STRING),
    StructField("parent_key", STRING),
    StructField("name", STRING),
    StructField("depth", INT),
    StructField("dfs_ord", ArrayType(INT)),
    StructField("aliases", STRINGS),
    StructField("description", STRING),
    StructField("oracle_hints", STRINGS),
])
