from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loreweave.functions import notation as T

CASES = [
    ("{T}: Add {G}.", None, "Tap (tap this permanent): Add green mana."),
    ("{E}{E}", None, "energy (energy counter), energy (energy counter)"),
    ("{G/W/P}", None, "Phyrexian green-white mana (green or white mana or 2 life)"),
    ("{2/U}", None, "hybrid two generic or blue mana"),
    ("{ZZ}", None, "ZZ"),
    ("{}", None, "{}"),
    ("{{Q}", None, "{Q"),
    ("a { b", None, "a { b"),
    ("{½} and ½", None, "half and 1/2"),
    ("{a—b}", None, "a -- b"),
    ("Fire and Firebreath", "Fire // Ice", "this card and this cardbreath"),
    ("Fire // Ice burns, It stays", "Fire // It", "this card // Ice burns, It stays"),
    ("lightning Bolt hits", "Bolt", "lightning this card hits"),
    ("a \t b\nc", None, "a b\nc"),
    ("   x \x1f", None, "x"),
    ("Æther — é • ∞ º", None, "Æther  --  é  *  infinity o".replace("  ", " ")),
    ("漢字 ♦ 5−3", None, "漢字 <> 5-3"),
    (None, "x", ""),
    ("", "x", ""),
]


def test_expand(spark):
    df = spark.createDataFrame([(i, t, n) for i, (t, n, _) in enumerate(CASES)], "i int, t string, n string")
    got = {r.i: r.clean_text for r in T.expand_notation(df, "t", "n").collect()}
    for i, (text, name, want) in enumerate(CASES):
        assert got[i] == want, (text, name)


def test_reminder(spark):
    df = spark.createDataFrame([("Fly (a (b) c) up (see\nthere).",)], "t string")
    assert T.expand_notation(df, "t", strip_reminder=True).first().clean_text == "Fly (a c) up ."


def test_short_columns(spark):
    rows = [("{2}{R}{R}", "two generic mana, red mana, red mana"), ("x {U/P} y", "Phyrexian blue mana (blue mana or 2 life)"),
            ("none", ""), (None, "")]
    df = spark.createDataFrame(rows, "c string, want string").select(T.mana_cost(F.col("c")).alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())
    stats = [("*", "1+*", "variable power / one plus variable toughness"), ("3", "4", "3/4"), ("3", None, "3"),
             ("+1", "-1", "+1/-1"), ("*", "3", "variable power / 3"), ("X", None, "X power"), (None, None, ""),
             ("1_0", "3d", "1_0 / 3d toughness"), ("1.5", ".5", "1.5/.5"), ("∞", "?", "infinity power / unknown toughness"),
             ("", "2", " power / 2")]
    df = spark.createDataFrame(stats, "p string, t string, want string")
    df = df.select("p", "t", T.power_toughness(F.col("p"), F.col("t")).alias("got"), "want")
    for r in df.collect():
        assert r.got == r.want, r
    loyal = spark.createDataFrame([("*",), ("X",), ("4",), (None,)], "l string").select(T.loyalty(F.col("l")).alias("g"))
    assert [r.g for r in loyal.collect()] == ["variable loyalty", "variable loyalty", "Loyalty: 4", ""]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab{}é—漢½ \n", max_size=12), min_size=20, max_size=60))
def test_tokens_lose_nothing(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.select("t", F.array_join(F.regexp_extract_all("t", F.lit(T._TOKENS), F.lit(0)), "").alias("u"))
    assert all(r.t == r.u for r in df.collect())
