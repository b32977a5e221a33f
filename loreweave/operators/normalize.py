"""Nested record dump → one flat, keyed, deduplicated row per face."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave import schema
from loreweave.functions.hashing import content_hash
from loreweave.operators.ranking import keep_first, number_rows


def face_counter(ids: Column) -> Column:
    """Number of each id among the equal ids before it, for an array of ids.

    All ids of an Arrow batch are counted together, in linear time for arrays
    of any length; only the ids leave the JVM. Null and empty ids get no number
    and are not counted.
    """

    @F.arrow_udf("array<int>")
    def count(ids: pa.Array) -> pa.Array:
        import numpy as np
        import pandas as pd
        import pyarrow as pa
        import pyarrow.compute as pc

        codes = ids.flatten().dictionary_encode()
        row = pc.list_parent_indices(ids).to_numpy(zero_copy_only=False)
        code = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        empty = pc.index(codes.dictionary, pa.scalar("", codes.dictionary.type)).as_py()
        dropped = (code == -1) | ((code == empty) if empty >= 0 else False)
        n = pd.DataFrame({"row": row, "code": code}).groupby(["row", "code"], sort=False).cumcount()
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(n.to_numpy().astype("int32"), mask=np.asarray(dropped))
        )

    return count(ids)


def number_faces(entries: DataFrame, faces: str, record_id) -> DataFrame:
    """One row per face of each entry's array: ``record_id, face_index, face`` added.

    The index counts the faces with the same record id in array order; faces
    without an id are dropped and not counted. All faces of an entry sit in
    one row, so numbering them needs no shuffle.
    """
    counted = entries.withColumn("_ids", F.transform(faces, record_id)).withColumn(
        "_n", face_counter(F.col("_ids"))
    )
    rows = F.transform("_n", lambda n, i: F.struct(
        F.get("_ids", i).alias("record_id"), n.alias("face_index"), F.get(faces, i).alias("face")
    ))
    kept = F.filter(rows, lambda r: r["face_index"].isNotNull())
    others = [c for c in entries.columns if c != faces]
    return counted.select(*others, F.inline(kept))


def number_face_rows(df: DataFrame, entry: str, pos: str, record_id: str) -> DataFrame:
    """The same counter for faces that already are rows (entry, position, id)."""
    kept = df.filter(F.coalesce(F.col(record_id), F.lit("")) != "")
    return number_rows(kept, [entry, record_id], pos, "face_index")


def keep_canonical(df: DataFrame, key: list[str], name: str, *ties: str) -> DataFrame:
    """Of several rows with one key, keep the one from the shortest entry name."""
    return keep_first(df, key, F.length(name), *[F.col(t) for t in ties])


def prune_nulls(m: Column) -> Column:
    """A map without its null-valued entries; no map gives an empty one."""
    kept = F.map_filter(m, lambda _, v: v.isNotNull())
    return F.coalesce(kept, F.create_map().cast("map<string,string>"))


def none_if_empty(m: Column) -> Column:
    return F.when(F.size(m) > 0, m)


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def face_columns(face: Column, entry_name: Column, version: Column) -> dict[str, Column]:
    """The card columns that come straight from one typed face.

    Fixed values: the column for each source key.
    """
    f = face.getField
    return {
        "name": F.coalesce(f("name"), entry_name),
        "face_name": f("faceName"),
        "side": f("side"),
        "layout": F.coalesce(f("layout"), F.lit("normal")),
        "mana_cost": f("manaCost"),
        "mana_value": f("manaValue"),
        "face_mana_value": f("faceManaValue"),
        "colors": f("colors"),
        "color_identity": f("colorIdentity"),
        "color_indicator": f("colorIndicator"),
        "type_line": f("type"),
        "supertypes": f("supertypes"),
        "types": f("types"),
        "subtypes": f("subtypes"),
        "power": f("power"),
        "toughness": f("toughness"),
        "loyalty": f("loyalty"),
        "defense": f("defense"),
        "hand": f("hand"),
        "life": f("life"),
        "oracle_text": f("text"),
        "keywords": f("keywords"),
        "legalities": prune_nulls(f("legalities")),
        "leadership_skills": none_if_empty(f("leadershipSkills")),
        "rulings": F.coalesce(f("rulings"), F.array().cast("array<struct<date:string,text:string>>")),
        "purchase_urls": F.coalesce(f("purchaseUrls"), F.create_map().cast("map<string,string>")),
        "related_cards": none_if_empty(f("relatedCards")),
        "printings": f("printings"),
        "produced_mana": f("producedMana"),
        "subsets": f("subsets"),
        "is_funny": flag(f("isFunny")),
        "is_game_changer": flag(f("isGameChanger")),
        "is_reserved": flag(f("isReserved")),
        "has_alt_deck_limit": flag(f("hasAlternativeDeckLimit")),
        "edhrec_rank": f("edhrecRank"),
        "edhrec_saltiness": f("edhrecSaltiness"),
        "first_printing": f("firstPrinting"),
        "source_version": version,
    }


# Columns that hold maps and structs.
NESTED = ["legalities", "leadership_skills", "rulings", "purchase_urls", "related_cards"]


def as_json(cards: DataFrame) -> DataFrame:
    """Nested columns as JSON texts, for export; NULL stays NULL."""
    return cards.withColumns({c: F.to_json(c) for c in NESTED if c in cards.columns})


def normalize(entries: DataFrame, source_version: str | Column) -> DataFrame:
    """``(entry_pos, name, faces array<variant>)`` → the card columns.

    ``source_version`` is one text, or a column of the entries.

    Numbering happens inside each row. The raw face is reduced to its typed
    columns and its hash before the only shuffle, the one on the final key, in
    which one row per key and map task takes part.
    """
    version = F.lit(source_version) if isinstance(source_version, str) else source_version
    numbered = number_faces(
        entries.select("entry_pos", F.col("name").alias("entry_name"), "faces", version.alias("_version")), "faces",
        lambda f: F.try_variant_get(f, "$.identifiers.scryfallOracleId", "string"),
    )
    typed = numbered.select(
        "entry_pos",
        "entry_name",
        F.col("record_id").alias("scryfall_oracle_id"),
        "face_index",
        "_version",
        F.col("face").cast(schema.FACE).alias("typed"),
        content_hash(F.col("face"), schema.HASHED_KEYS).alias("content_hash"),
    )
    kept = keep_canonical(
        typed, schema.CARD_KEY, "entry_name", "entry_pos", "entry_name", "content_hash"
    )
    columns = face_columns(F.col("typed"), F.col("entry_name"), F.col("_version"))
    columns |= {c: F.col(c) for c in ("scryfall_oracle_id", "face_index", "content_hash")}
    return kept.select(*[columns[c].alias(c) for c in schema.CARD_COLUMNS])
