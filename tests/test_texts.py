import re

import pytest

from loreweave.operators import chunks as C
from loreweave.operators import embedding as E
from loreweave.plans import jobs
from loreweave.sources import inputs
from loreweave.sources.warehouse import ConstraintError, Warehouse

BOOK = (
    "Contents\n1. Game Concepts\nGlossary\nCredits\n\n1. Game Concepts\nIntro text\n\n"
    "100. General words about it\n100.1. These rules apply to all {T} games\n2. Parts\n"
    "100.1a A two-player game has two players\n101. short\n101.1 No-break space after the number\n"
    "1000. not a rule number here\nx 102. not at the line start\n"
    "\nGlossary\n\nFlying\nA keyword ability.\n\n\nshort\n\nReach\nSee also Flying.\n\nFlying\nThe later one.\n"
    "\nCredits\nSomebody"
)


def pieces(spark, text):
    df = spark.createDataFrame([("d", text)], "doc string, text string")
    return {r.id: r.raw for r in C.book_pieces(C.book_sections(df)).orderBy("part", "pos").collect()}


def by_hand(text):
    """The same segmentation with plain string functions."""
    marks = [m.start() for m in re.finditer(re.escape("\n1. Game Concepts\n"), text)]
    start = marks[1] if len(marks) > 1 else marks[0] if marks else 0
    g, c = text.rfind("\nGlossary\n"), text.rfind("\nCredits\n")
    if g == -1 or g < start:
        body, terms = text[start:], ""
    else:
        body, terms = text[start:g], text[g + 10: c if c > g else len(text)]
    out, current = {}, None
    for line in body.split("\n"):
        m = re.match(r"(\d{3}(?:\.\d+[a-z]?)?)\.?\s", line + "\n")
        if m:
            current = (m.group(1), [])
            out.setdefault("order", []).append(current)
        if current:
            current[1].append(line)
    found = {}
    for number, lines in out.get("order", []):
        raw = "\n".join(lines).strip()
        if len(raw) >= 20:
            found["rule:" + number] = raw
    for block in re.split(r"\n\n+", terms.strip()):
        block = block.strip()
        if len(block) >= 10:
            found["glossary:" + block.split("\n")[0].strip()] = block
    return found


@pytest.mark.parametrize("text", [
    BOOK,
    BOOK.replace("\nGlossary\n", "\nTerms\n"),
    BOOK.replace("\nCredits\n", "\nThanks\n"),
    BOOK.replace("1. Game Concepts", "1. Concepts"),
    BOOK.split("Intro")[0],
    "100.1 A book without any marker at all\n100.2 and two rules of enough length",
    "", "\nGlossary\nTerm\nwith a text\n", "\nGlossary\nCredits\n",
])
def test_book(spark, text):
    assert pieces(spark, text) == by_hand(text)


def test_rules_chunks(spark):
    df = spark.createDataFrame([("d", BOOK)], "doc string, text string")
    got = {r.id: r.chunk_text for r in C.rules_chunks(df).collect()}
    assert got["rule:100.1"] == "100.1. These rules apply to all Tap (tap this permanent) games\n2. Parts"
    assert got["glossary:Flying"] == "Flying\nThe later one."
    assert "rule:101" not in got and "rule:101.1" in got


def test_read_books(spark, tmp_path):
    (tmp_path / "b.txt").write_bytes(b"\xef\xbb\xbfone\r\ntwo\r\n")
    assert inputs.read_books(spark, str(tmp_path / "b.txt")).first().text == "one\ntwo\n"


def cards(spark, rows):
    return spark.createDataFrame(rows, "scryfall_oracle_id string, face_index int, name string, oracle_text string")


def test_card_chunks(spark):
    df = cards(spark, [("o", 0, "Bolt", "Bolt deals {R}."), ("o", 1, "Land", None)])
    assert {r.id: r.chunk_text for r in C.name_chunks(df).collect()} == {"o:0": "Bolt", "o:1": "Land"}
    assert {r.id: r.chunk_text for r in C.text_chunks(df).collect()} == {"o:0": "this card deals red mana.", "o:1": ""}


def chunk_rows(spark, texts):
    return spark.createDataFrame([(i, 0, t) for i, t in texts.items()], "id string, chunk_index int, chunk_text string")


def test_embed_job(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"))
    store.init()
    model = E.hashing_backend(16)
    a = chunk_rows(spark, {"1": "red fish", "2": "blue fish", "3": ""})
    assert jobs.embed_source(store, "s", a, model) == 3
    assert jobs.embed_source(store, "s", a, model) == 0
    b = chunk_rows(spark, {"1": "red fish", "2": "green fish"})
    assert jobs.embed_source(store, "s", b, model) == 1
    rows = {r.id: r for r in store.vectors("s").collect()}
    assert set(rows) == {"1", "2", "3"} and rows["2"].chunk_text == "green fish"  # ids never vanish
    assert sum(rows["3"].embedding) == 0 and rows["1"].updated_at < rows["2"].updated_at
    assert jobs.embed_source(store, "s", b, model, full_refresh=True) == 2
    wider = E.Backend("other", 16, model.apply)
    assert jobs.embed_source(store, "s", b, wider) == 2
    assert store.vectors("t").count() == 0 and store.all_vectors().count() == 3
    wrong = E.Backend("wrong-width", 17, model.apply)
    with pytest.raises(ConstraintError, match="width is not 17"):
        jobs.embed_source(store, "s", b, wrong)
    assert {r.model for r in store.vectors("s").collect()} == {"other", "hashing-16"}


def test_old_table_without_hashes(spark):
    chunks = E.with_hash(chunk_rows(spark, {"1": "a"}), "m")
    stored = chunks.drop("chunk_hash")
    assert E.pending(chunks, stored).count() == 1
    assert E.pending(chunks, chunks).count() == 0


def test_batch_backend(spark):
    def load():
        sizes = []

        def model(texts):
            sizes.append(len(texts))
            assert max(sizes) <= 4
            return [[float(len(t)), 1.0] for t in texts]

        return model

    model = E.batch_backend("lengths", 2, load, batch_size=4)
    df = chunk_rows(spark, {str(i): "x" * i for i in range(11)})
    got = {r.id: r.embedding for r in model.embed(df, "chunk_text").collect()}
    assert got == {str(i): [float(i), 1.0] for i in range(11)}
    with pytest.raises(ValueError):
        E.backend("nothing")


def test_run(spark, tmp_path):
    import gzip
    import json

    data = {n: [{"identifiers": {"scryfallOracleId": n.lower()}, "manaValue": 1, "type": "T", "text": f"{n} has {{T}}"}]
            for n in ("Alpha", "Beta")}
    dump = tmp_path / "d.gz"
    dump.write_bytes(gzip.compress(json.dumps({"meta": {"version": "v"}, "data": data}).encode()))
    (tmp_path / "book.txt").write_text(BOOK)
    model, root = E.hashing_backend(32), str(tmp_path / "w")
    assert jobs.run(spark, root, init_only=True) == {}
    done = jobs.run(spark, root, dump=str(dump), books=str(tmp_path / "book.txt"), model=model)
    assert done["sync"]["inserted"] == 2
    assert done["embed"]["card_name"] == done["embed"]["card_text"] == 2 and done["embed"]["rules"] > 4
    again = jobs.run(spark, root, embed_only=True, books=str(tmp_path / "book.txt"), model=model, only=["rules", "nope"])
    assert again == {"embed": {"rules": 0}}
    texts = {r.chunk_text for r in Warehouse(spark, root).vectors("card_text").collect()}
    assert texts == {"this card has Tap (tap this permanent)"}


def test_hashed_tokens_in_pieces(spark, monkeypatch):
    """Vectors do not depend on how many tokens are held at a time; empty and null texts keep their place."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    df = spark.range(50).select("id", F.when(F.col("id") % 7 != 3, F.repeat(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" x ")), (F.col("id") % 5).cast("int"))).alias("t"))
    want = {r.id: r.v for r in E.hashing_backend(16).embed(df, "t", "v").collect()}
    monkeypatch.setattr(E, "TOKENS", 3)
    rows = df.select("id", E.tokens(F.col("t")).alias("found")).orderBy("id").collect()
    got = E.slot_counts(16).func(pa.array([r.found for r in rows], pa.list_(pa.string())))
    assert got.to_pylist() == [want[r.id] for r in rows]
