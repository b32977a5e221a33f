import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from loreweave import schema
from loreweave.functions.hashing import content_hash
from loreweave.operators import normalize as N
from loreweave.operators import sync as S
from loreweave.operators.ranking import number_rows
from loreweave.plans import jobs
from loreweave.sources import inputs
from loreweave.sources.warehouse import ConstraintError, Warehouse


def face(oid, **more):
    return {"identifiers": {"scryfallOracleId": oid}, "manaValue": 1.0, "type": "Thing", **more}


def dump(path, data, version="v1"):
    body = json.dumps({"meta": {"date": "2020-01-01", "version": version}, "data": data}).encode()
    path.write_bytes(gzip.compress(body))
    return str(path)


def rows_of(spark, path):
    meta, entries = inputs.read_dump(spark, path)
    return {(r.scryfall_oracle_id, r.face_index): r for r in N.normalize(entries, meta.first().version).collect()}


def test_counter_skips_and_dedup(spark, tmp_path):
    path = dump(tmp_path / "d.json.gz", {
        "S // S": [face("s", text="long 0"), face("s", text="long 1")],
        "Four": [face("x", text="1"), face("y", text="2"), face("y", text="3"), face("x", text="4")],
        "Skip": [face("k", text="a"), face(None), face(""), {"name": "no ids"}, face("k", text="b")],
        "S": [face("s", text="short")],
        "AB": [face("t", text="first")], "CD": [face("t", text="second")],
    })
    got = {k: r.oracle_text for k, r in rows_of(spark, path).items()}
    assert got == {
        ("x", 0): "1", ("y", 0): "2", ("y", 1): "3", ("x", 1): "4", ("k", 0): "a", ("k", 1): "b",
        ("s", 0): "short", ("s", 1): "long 1", ("t", 0): "first",
    }


def test_columns_and_defaults(spark, tmp_path):
    path = dump(tmp_path / "d.json.gz", {
        "Full": [face("f", name="N", legalities={"a": "Legal", "b": None}, leadershipSkills={"brawl": True},
                      relatedCards={"spellbook": ["p", "q"]}, rulings=[{"date": "d", "text": "t"}], colors=[],
                      isFunny=True, edhrecRank=7, edhrecSaltiness=0.5, purchaseUrls={"u": "v"},
                      foreignData=[{"x": 1}], keywords=["k"])],
        "Bare": [face("b", leadershipSkills={}, relatedCards={})],
    })
    rows = rows_of(spark, path)
    full, bare = rows["f", 0], rows["b", 0]
    assert full.name == "N" and full.legalities == {"a": "Legal"} and full.leadership_skills == {"brawl": True}
    assert full.related_cards == {"spellbook": ["p", "q"]} and full.rulings[0].text == "t"
    assert full.colors == [] and full.is_funny and full.edhrec_rank == 7 and full.keywords == ["k"]
    assert bare.name == "Bare" and bare.layout == "normal" and bare.legalities == {} and bare.rulings == []
    assert bare.purchase_urls == {} and bare.leadership_skills is None and bare.related_cards is None
    assert bare.colors is None and bare.is_funny is False and bare.source_version == "v1"
    assert list(full.asDict()) == schema.CARD_COLUMNS


def test_entry_lines_give_the_same(spark, tmp_path):
    data = {"Bee": [face("o", text="x")], "B": [face("o", text="y")], "C": [face("p", text="z"), face("p", text="w")]}
    path = dump(tmp_path / "d.json.gz", data)
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps({"name": n, "faces": f}) for n, f in data.items()))
    other = N.normalize(inputs.read_entry_lines(spark, str(lines)), "v1").collect()
    assert {(r.scryfall_oracle_id, r.face_index): r for r in other} == rows_of(spark, path)


def test_hash_sees_what_counts(spark):
    variants = {
        "base": {"name": "a", "text": "t", "identifiers": {"x": 1, "y": [1, {"b": 2, "a": 1}]}, "printings": ["P"]},
        "order": {"identifiers": {"y": [1, {"a": 1, "b": 2}], "x": 1}, "text": "t", "printings": [], "name": "a"},
        "null": {"name": "a", "text": "t", "power": None, "identifiers": {"x": 1, "y": [1, {"b": 2, "a": 1}]}},
        "text": {"name": "a", "text": "u", "identifiers": {"x": 1, "y": [1, {"b": 2, "a": 1}]}},
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in variants.items()], "k string, j string")
    h = {r.k: r.h for r in df.select(
        "k", content_hash(F.parse_json("j"), schema.HASHED_KEYS).alias("h")).collect()}
    assert h["base"] == h["order"] and len({h["base"], h["null"], h["text"]}) == 3


def test_number_rows_across_ranges(spark):
    rows = [("hot", p) for p in range(0, 500, 3)] + [("b", p) for p in (7, 90, 91, 400)]
    df = spark.createDataFrame(rows, "k string, pos int")
    got = {(r.k, r.pos): r.n for r in number_rows(df, ["k"], "pos", "n", span=10).collect()}
    want = {}
    for k in ("hot", "b"):
        want |= {(k, p): i for i, p in enumerate(sorted(p for q, p in rows if q == k))}
    assert got == want


def test_checksums(spark, tmp_path):
    a = tmp_path / "a.gz"
    a.write_bytes(b"data")
    digest = hashlib.sha256(b"data").hexdigest()
    (tmp_path / "a.gz.sha256").write_text(f"{digest}  a.gz\n")
    assert inputs.check_digests(spark, str(a), str(tmp_path / "a.gz.sha256")).first().sha256 == digest
    (tmp_path / "a.gz.sha256").write_text("0" * 64)
    with pytest.raises(inputs.ChecksumError):
        inputs.check_digests(spark, str(a), str(tmp_path / "a.gz.sha256"))


def test_diff(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, content_hash string, rank int")
    new = spark.createDataFrame([(1, "a", 11), (2, "x", 21), (4, "d", 41)], "k int, content_hash string, rank int")
    classes = S.diff(old, new, ["k"])
    assert {r.k: r.change for r in classes.collect()} == {
        1: "unchanged", 2: "updated", 3: "deleted", 4: "inserted"}
    merged = {r.k: r["rank"] for r in S.merge(old, new, ["k"], classes).collect()}
    assert merged == {1: 10, 2: 21, 4: 41}  # what is outside the hash stays old
    kept = {r.k for r in S.merge(old, new, ["k"], classes, delete_stale=False).collect()}
    assert kept == {1, 2, 3, 4}
    assert S.diff_stats(classes).first().asDict() == {
        "inserted": 1, "updated": 1, "unchanged": 1, "deleted": 1, "total_cards": 3}


def test_sync_job(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"))
    store.init()
    store.init()
    first = dump(tmp_path / "1.gz", {"A": [face("a", text="1", edhrecRank=1)], "B": [face("b", text="2")]}, "v1")
    (tmp_path / "1.gz.sha256").write_text(hashlib.sha256((tmp_path / "1.gz").read_bytes()).hexdigest())
    counts = jobs.run_sync(store, first, first + ".sha256")
    assert counts == {"inserted": 2, "updated": 0, "unchanged": 0, "deleted": 0, "total_cards": 2}
    again = jobs.run_sync(store, first)
    assert again["unchanged"] == 2 and again["inserted"] == again["updated"] == again["deleted"] == 0
    second = dump(tmp_path / "2.gz", {"A": [face("a", text="1", edhrecRank=9)], "C": [face("c", text="3")]}, "v2")
    assert jobs.run_sync(store, second) == {
        "inserted": 1, "updated": 0, "unchanged": 1, "deleted": 1, "total_cards": 2}
    cards = {r.scryfall_oracle_id: r for r in store.cards().collect()}
    assert set(cards) == {"a", "c"} and cards["a"].edhrec_rank == 1 and cards["a"].source_version == "v1"
    log = store.sync_log().orderBy("id").collect()
    assert [r.id for r in log] == [1, 2, 3] and all(r.status == "success" for r in log)
    assert log[0].source_sha256 and log[0].finished_at == log[0].started_at


def test_failed_run_leaves_nothing(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"))
    store.init()
    good = dump(tmp_path / "1.gz", {"A": [face("a", text="1")]})
    jobs.run_sync(store, good)
    bad = dump(tmp_path / "2.gz", {"A": [face("a", text="1")], "B": [{"identifiers": {"scryfallOracleId": "b"}}]})
    with pytest.raises(ConstraintError, match="mana_value is null"):
        jobs.run_sync(store, bad)
    assert store.sync_log().count() == 1 and store.cards().count() == 1
    twice = store.cards().drop("updated_at")
    with pytest.raises(ConstraintError, match="duplicate key"):
        jobs.sync_cards(store, twice.union(twice), "v", "")


@pytest.mark.parametrize("max_deltas", [2, 0])
def test_deltas(spark, tmp_path, max_deltas):
    """Many small changes give the same table as writing it whole each time."""
    store = Warehouse(spark, str(tmp_path / "w"), max_deltas=max_deltas)
    store.init()
    state = {i: 0 for i in range(40)}
    for step in range(6):
        if step:
            state[step] = step  # one changed, one gone, one new, and one of before changed back and forth
            state.pop(10 + step, None)
            state[100 + step] = step
            state[0] = step % 2
        rows = spark.createDataFrame([(str(k), str(v)) for k, v in state.items()], "k string, v string")
        from catalog.records import _as_cards

        counts = jobs.sync_cards(store, _as_cards(rows.select(
            F.col("k").alias("scryfall_oracle_id"), F.lit(0).alias("face_index"), F.col("v").alias("content_hash"),
            F.col("v").alias("source_version"))), str(step), "")
        assert counts["total_cards"] == len(state)
        got = {int(r.scryfall_oracle_id): int(r.content_hash) for r in store.cards().collect()}
        assert got == state and store.cards().count() == len(state)
    bases = {r.base for r in store._log("sync_log").collect()}
    assert len(bases) == (2 if max_deltas else 6)


def test_many_dumps_have_one_order(spark, tmp_path):
    """Equal names in several files: the result does not depend on how they are read."""
    folder = tmp_path / "dumps"
    folder.mkdir()
    for i in range(4):
        dump(folder / f"{i}.json.gz", {"Same": [face("s", text=f"text {i}")], f"N{i}": [face("n", text=f"n {i}")]})
    _, entries = inputs.read_dump(spark, str(folder))
    seen = set()
    for parts in (1, 3, 8):
        rows = N.normalize(entries.repartition(parts), "v").collect()
        assert len(rows) == 2
        seen.add(tuple(sorted(r.oracle_text for r in rows)))
    assert len(seen) == 1


def test_long_entry(spark):
    """An entry with very many faces is numbered in linear time."""
    rows = spark.range(1).select(
        F.lit(0).alias("entry_pos"),
        F.transform(F.sequence(F.lit(0), F.lit(199_999)), lambda i: F.concat(
            F.lit("id"), F.pmod(i, F.lit(66_667)).cast("string"))).alias("faces"),
    )
    numbered = N.number_faces(rows, "faces", lambda f: f)
    got = numbered.groupBy("face_index").count().orderBy("face_index").collect()
    assert [(r.face_index, r["count"]) for r in got] == [(0, 66_667), (1, 66_667), (2, 66_666)]


def test_several_dumps_keep_their_versions(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, version in enumerate(("v1", "v2")):
        path = folder / f"{i}.json.gz"
        dump(path, {f"N{i}": [face(f"n{i}", text="t")]}, version)
        (folder / f"{i}.json.gz.sha256").write_text(hashlib.sha256(path.read_bytes()).hexdigest())
    store = Warehouse(spark, str(tmp_path / "w"))
    store.init()
    jobs.run_sync(store, str(folder / "*.gz"), str(folder / "*.sha256"))
    assert {r.name: r.source_version for r in store.cards().collect()} == {"N0": "v1", "N1": "v2"}
    row = store.sync_log().first()
    digests = sorted(hashlib.sha256((folder / f"{i}.json.gz").read_bytes()).hexdigest() for i in (0, 1))
    assert row.source_version == "v1,v2" and row.source_sha256 == hashlib.sha256("".join(digests).encode()).hexdigest()


def test_lines_give_the_same_table(spark, tmp_path):
    import json

    data = {"A": [face("a", text="1")], "B": [face("b", text="2")]}
    one, two = (Warehouse(spark, str(tmp_path / n)) for n in ("one", "two"))
    for store in (one, two):
        store.init()
    jobs.run_sync(one, dump(tmp_path / "1.gz", data, "v1"))
    lines = [json.dumps({"name": n, "faces": f, "version": "v1"}) for n, f in data.items()]
    (tmp_path / "lines.json").write_text("\n".join(lines))
    jobs.run_sync(two, lines=str(tmp_path / "lines.json"))
    rows = [sorted(map(str, s.cards().drop("updated_at").collect())) for s in (one, two)]
    assert rows[0] == rows[1] and len(rows[0]) == 2


def test_selection_and_last_chunk(spark, tmp_path):
    from loreweave.operators.embedding import hashing_backend

    model = hashing_backend(8)
    with pytest.raises(ValueError, match="books"):
        jobs.run(spark, str(tmp_path / "w"), embed_only=True, only=["rules"], model=model)
    store = Warehouse(spark, str(tmp_path / "w"))
    store.init()
    files = list((tmp_path / "w" / "sync_log").glob("*.parquet"))
    store.init()
    assert list((tmp_path / "w" / "sync_log").glob("*.parquet")) == files
    assert jobs.run_embed(store, {"cards": store.cards()}, model, only=[]) == {}
    chunks = spark.createDataFrame([("a", 0, "first"), ("a", 0, "second"), ("b", 0, "x")], "id string, chunk_index int, chunk_text string").coalesce(1)
    assert jobs.embed_source(store, "own", chunks, model) == 2
    assert {r.id: r.chunk_text for r in store.vectors("own").collect()} == {"a": "second", "b": "x"}


def test_blocks_of_files_share_folders(spark, tmp_path):
    """Files of forty blocks stand in one folder, whatever the number of brands, and are named by both."""
    from catalog import records as R

    rows = spark.range(6000).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("Brand#/ ,="), (F.col("id") % 3).cast("string")).alias("p_brand"),
        F.expr("id div 50").alias("block"), F.lit("x").alias("value"),
    )
    pattern = R._write_blocks(rows, str(tmp_path / "f"))
    assert len(list((tmp_path / "f").iterdir())) == 3
    found = R.digests_of(spark, pattern).select(*R._file_name("file"), "sha256")
    assert sorted((r.brand, r.block) for r in found.collect()) == [(f"Brand#/ ,={b}", k) for b in range(3) for k in range(120)]
