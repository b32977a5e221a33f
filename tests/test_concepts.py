import json

import pytest

from loreweave.operators import taxonomy as X
from loreweave.operators.chunks import taxonomy_chunks
from loreweave.operators.tagging import tag_arrays, tag_texts


def concept(key, aliases=(), hints=(), children=()):
    return {"key": key, "name": key.title(), "aliases": list(aliases), "description": f"About {key}.",
            "oracle_hints": list(hints), "children": list(children)}


TREE = [
    concept("kill", ["Kill", "removal"], [], [
        concept("kill.one", ["removal", "spot removal"], ["destroy target", "exile target"], [
            concept("kill.one.burn", ["burn"], ["destroy target", "damage"])]),
        concept("kill.all", ["wipe"], ["destroy all"]),
    ]),
    concept("killer", ["other"], ["unrelated"]),
    concept("gain", ["life"], ["gain life"]),
]


@pytest.fixture(scope="module")
def tax(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tax") / "tree.json"
    path.write_text(json.dumps(TREE, indent=1))
    return X.read_taxonomy(spark, str(path)).cache()


def test_walk(tax):
    rows = X.walk(tax).collect()
    assert [r.key for r in rows] == ["kill", "kill.one", "kill.one.burn", "kill.all", "killer", "gain"]
    assert [r.parent_key for r in rows] == [None, "kill", "kill.one", "kill", None, None]
    assert [r.depth for r in rows] == [0, 1, 2, 1, 0, 0]


def test_node(tax):
    assert X.node(tax, "kill.all").first().description == "About kill.all."
    assert X.node(tax, "nothing").count() == 0


def test_aliases(tax):
    got = {r.alias: r.key for r in X.alias_map(tax).collect()}
    assert got["removal"] == "kill.one" and got["kill"] == "kill" and len(got) == 7


def test_below(tax):
    rows = X.hints_below(tax).filter("ancestor = 'kill'").orderBy("dfs_ord", "pos").collect()
    assert [r.hint for r in rows] == ["destroy target", "exile target", "destroy target", "damage", "destroy all"]
    assert X.hints_below(tax).filter("ancestor = 'nothing'").count() == 0
    descriptions = X.descriptions_below(tax).filter("ancestor = 'kill.one'").orderBy("dfs_ord")
    assert [r.description for r in descriptions.collect()] == ["About kill.one.", "About kill.one.burn."]
    assert taxonomy_chunks(tax).filter("id = 'taxonomy:gain'").first().chunk_text == "About gain."


def test_terms(spark, tax):
    terms = spark.createDataFrame([("REMOVAL",), ("spot",), ("Life",)], "term string")
    assert {r.term: r.key for r in X.match_terms(terms, X.alias_map(tax)).collect()} == {"REMOVAL": "kill.one", "Life": "gain"}
    assert {(r.term, r.hint) for r in X.expand_terms(terms, tax).collect()} == {
        ("REMOVAL", "destroy target"), ("REMOVAL", "exile target"), ("REMOVAL", "damage"), ("Life", "gain life")}


def test_abbreviations(spark):
    df = spark.createDataFrame([("ETB",), ("etb",), ("P/T",), ("x",)], "term string")
    want = ["enters the battlefield", "etb", "power and toughness", "x"]
    assert [r.full_term for r in X.expand_abbreviations(df, "term").collect()] == want
    joined = X.expand_abbreviations(df, "term", X.abbreviations(spark))
    assert sorted(r.full_term for r in joined.collect()) == sorted(want)


def test_colours(spark):
    df = spark.createDataFrame([("wu", ["U", "W"]), ("wub", ["W", "U", "B"]), ("w", ["W"]), ("none", [])],
                               "n string, color_identity array<string>")

    def names(mode):
        return {r.n for r in X.colour_filter(df, "Azorius", mode=mode).collect()}

    assert names("contains_all") == {"wu", "wub"} and names("contained_by") == {"wu", "w", "none"}
    assert names("exact") == {"wu"} and X.colour_groups(spark).count() == 20
    with pytest.raises(ValueError):
        X.colour_filter(df, "nothing")


TEXTS = [(1, "Destroy ALL creatures and gain life"), (2, "nothing here"), (3, None), (4, "destroy target, damage é"),
         (5, "a"), (6, "")] + [(100 + i, "the hot phrase destroy target again") for i in range(40)]


@pytest.mark.parametrize("characters", [1 << 12, 1, 30])
@pytest.mark.parametrize("extra", [0, 30])
def test_tags(spark, characters, extra):
    hints = [("one", "destroy target"), ("all", "Destroy all"), ("gain", "gain life"), ("burn", "DAMAGE É"),
             ("gain", "creatures"), ("a", "a"), ("hot", "the hot phrase destroy target again"), ("no", "absent"), ("e", "")]
    hints += [(f"x{i}", f"absent {i}") for i in range(extra)]
    texts = spark.createDataFrame(TEXTS, "id int, t string")
    table = spark.createDataFrame(hints, "key string, hint string")
    tags = tag_texts(texts, "id", "t", table, characters=characters)
    want = {(i, k) for i, t in TEXTS if t for k, h in hints if h and h.lower() in t.lower()}
    rows = [(r.id, r.key) for r in tags.collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert tag_arrays(tags, "id").filter("id = 1").first().taxonomy_tags == ["a", "all", "gain"]


def test_tags_keep_rows_apart(spark):
    texts = spark.createDataFrame([(None, "big red fish"), (1, "red"), (1, "red"), (2, None)], "id int, t string")
    hints = spark.createDataFrame([("c", "red"), ("d", "")], "key string, hint string")
    rows = tag_texts(texts, "id", "t", hints).collect()
    assert sorted((str(r.id), r.key) for r in rows) == [("1", "c"), ("1", "c"), ("None", "c")]
    assert tag_texts(texts, "id", "t", hints.limit(0)).count() == 0


def test_tags_number_their_hints_without_python_rows(spark, monkeypatch):
    """Hints go to Spark as Arrow tables; lists of rows take Python workers of their own, which stay beside the others."""
    seen, plain = [], type(spark).createDataFrame
    texts = spark.createDataFrame([(1, "a Small ring"), (2, None)], "id int, text string")
    hints = spark.createDataFrame([("k", "small"), ("k", "ring"), ("l", "Ä")], "key string, hint string")
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *args, **named: seen.append(data) or plain(self, data, *args, **named))
    assert [tuple(r) for r in tag_texts(texts, "id", "text", hints).collect()] == [(1, "k")]
    assert len(seen) == 1 and not isinstance(seen[0], list)
