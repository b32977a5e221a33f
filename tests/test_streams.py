"""Files read in pieces: digests of any size, dumps split at their entries."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from loreweave.operators import normalize as N
from loreweave.plans import jobs
from loreweave.sources import inputs, streams
from loreweave.sources.warehouse import Warehouse

ODD = {
    'quote " and \\ back': [{"text": 'a "b" {c} [d] \\', "identifiers": {"scryfallOracleId": "o1"}}],
    "": [], "twice {": [{"x": [1, [2.0, {"y": None}]]}, {"x": "}],\\\\"}], "é日\u2028": [{"text": "\\\\\""}, None],
    "long": [{"text": "w" * 700, "identifiers": {"scryfallOracleId": "o2"}}], "data": [{"data": {"meta": ["data"]}}],
}


def body(data, version="v1", **more):
    return json.dumps({"meta": {"date": "2020-01-01", "version": version}, "data": data}, **more)


TEXTS = {
    "plain": body(ODD), "spread": body(ODD, indent=3), "tight": body(ODD, separators=(",", ":"), ensure_ascii=False),
    "turned": json.dumps({"note": "data", "n": [1, "data"], "data": ODD, "meta": {"version": "v2", "date": "d"}, "z": "meta"}),
    "empty": body({}), "none": '{"meta": {"version": "v"}}',
}


def plain(rows):
    return [(r.version, r.name, [str(f) for f in r.faces]) for r in rows]


@pytest.mark.parametrize("name", list(TEXTS))
def test_split_at_every_size(name, tmp_path, monkeypatch):
    """The entries of all ranges, put together, are the document's, wherever ranges and pieces are cut."""
    path = tmp_path / "d.json"
    path.write_text(TEXTS[name], encoding="utf-8")
    length = path.stat().st_size
    want = [(k, v) for k, v in json.loads(TEXTS[name]).get("data", {}).items()]
    for size, piece in ((1, 5), (2, 64), (7, 3), (64, 1), (100, 1000), (length, 11)):
        if length // size > 400 and piece < 5:
            continue
        monkeypatch.setattr(streams, "PIECE", piece)
        with streams.open_file(str(path)) as stream:
            inside = depth = 0
            starts = []
            for at in range(0, length, size):
                starts.append((at, min(at + size, length), bool(inside), depth))
                odd, outside, within = streams.effect(stream, at, min(at + size, length))
                inside, depth = inside ^ odd, depth + (within if inside else outside)
            assert (inside, depth) == (0, 0)
            found = sorted(k for s in starts for k in streams.keys(stream, *s))
            assert [k for _, k in found] == list(json.loads(TEXTS[name]))
            places = {k: i for i, k in found}
            if "data" not in places:
                continue
            low = places["data"]
            high = min((i for i, _ in found if i > low), default=2**62)
            got = sorted(e for s in starts for e in streams.entries(stream, *s, low, high))
        assert [next(iter(json.loads(b"{" + t + b"}").items())) for _, t in got] == want


def test_split_dump_gives_the_rows_of_the_whole(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    for name, text in TEXTS.items():
        (folder / f"{name} %23.json").write_text(text, encoding="utf-8")
    meta, entries = inputs.read_split_dump(spark, str(folder), size=90)
    whole_meta, whole = inputs.read_dump(spark, str(folder))
    assert sorted(plain(entries.collect()), key=repr) == sorted(plain(whole.collect()), key=repr)
    assert sorted(map(tuple, meta.collect()), key=repr) == sorted(map(tuple, whole_meta.collect()), key=repr)
    assert len(TEXTS) == meta.count()
    # Entries keep their order in the file, and several tasks find them.
    one = tmp_path / "one.json"
    one.write_text(body({f"n{k}": [{"k": k}] for k in range(500)}))
    _, entries = streams.split_dumps(spark, str(one), 1000)
    rows = entries.withColumn("task", F.spark_partition_id()).orderBy("place").collect()
    assert [json.loads(r.entry) for r in rows] == [{f"n{k}": [{"k": k}]} for k in range(500)]
    assert len({r.task for r in rows}) > 1


def test_job_over_a_split_dump(spark, tmp_path):
    path = tmp_path / "d.json"
    data = {f"Card {k}": [{"identifiers": {"scryfallOracleId": f"o{k % 7}"}, "text": f"t{k}", "type": "T", "manaValue": 1.0}] for k in range(60)}
    path.write_text(body(data))
    tables = []
    for split in (None, 500):
        store = Warehouse(spark, str(tmp_path / f"w{split}"))
        store.init()
        counts = jobs.run_sync(store, str(path), split=split)
        tables.append((counts, sorted(map(str, store.cards().drop("updated_at").collect()))))
    assert tables[0] == tables[1]


def test_digest_of_a_file_over_two_gigabytes(spark, tmp_path):
    path = tmp_path / "big.bin"
    with path.open("wb") as f:
        f.write(b"head")
        f.truncate(2**31 + 100)  # a hole; takes no disk
    state = hashlib.sha256(b"head")
    for _ in range(2**31 // (1 << 24)):
        state.update(bytes(1 << 24))
    state.update(bytes(96))
    assert inputs.file_digests(spark, str(path)).first().sha256 == state.hexdigest()


def test_compared_digests(spark, tmp_path):
    for name, ok in (("a", True), ("b c%20d", False), ("e", None)):
        (tmp_path / name).write_bytes(name.encode())
        if ok is not None:
            digest = hashlib.sha256(name.encode() if ok else b"other").hexdigest()
            (tmp_path / f"{name}.sha256").write_text(f" {digest}\t{name}\nmore")
    got = inputs.compare_digests(spark, str(tmp_path / "*[!6]"), str(tmp_path / "*.sha256")).collect()
    assert {r.file.rsplit("/", 1)[1]: r.matches for r in got} == {"a": True, "b c%20d": False, "e": False}
    with pytest.raises(inputs.ChecksumError):
        inputs.check_digests(spark, str(tmp_path / "*[!6]"), str(tmp_path / "*.sha256"))


def test_small_ranges_share_tasks(spark):
    """Ranges by the thousand do not make as many tasks; large ones still have one each."""
    small = spark.range(3000).select(F.lit("f").alias("file"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 10).alias("stop"))
    dealt = streams._dealt(small)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert dealt.exceptAll(small).isEmpty() and dealt.count() == 3000
    wide = small.limit(50).selectExpr("file", f"start * {streams.RANGE // 10} as start", f"stop * {streams.RANGE // 10} as stop")
    assert streams._dealt(wide).rdd.getNumPartitions() > 40


def test_written_lines(spark, tmp_path):
    """Small files share folders, are listed and hashed by few tasks, and hold their lines in order."""
    rows = spark.range(3000).select(
        F.concat(F.lit(f"{tmp_path}/t/"), (F.col("id") % 3).cast("string"), F.lit("/n "), (F.col("id") % 300).cast("string")).alias("file"),
        (-F.col("id")).alias("place"), F.when(F.col("id") != 7, F.concat(F.lit("é"), F.col("id").cast("string"))).alias("value"),
    )
    for _ in range(2):  # written again, not added to
        streams.write_lines(rows, 300)
    text = {k: "".join("\n" if i == 7 else f"é{i}\n" for i in reversed(range(k, 3000, 300))) for k in range(300)}
    assert {f.name: f.read_text(encoding="utf-8") for f in (tmp_path / "t").rglob("n *")} == {f"n {k}": t for k, t in text.items()}
    found = inputs.file_digests(spark, f"{tmp_path}/t/*")
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert {r.file.rsplit(" ", 1)[1]: r.sha256 for r in found.collect()} == {str(k): hashlib.sha256(t.encode()).hexdigest() for k, t in text.items()}


def test_dumps_are_parsed_once(spark, tmp_path, monkeypatch):
    """The job goes on from the written entries; the dump itself is not read again."""
    path = tmp_path / "d.json"
    path.write_text(body({f"Card {k}": [{"identifiers": {"scryfallOracleId": f"o{k}"}, "text": "t", "type": "T", "manaValue": 1.0}] for k in range(5)}))

    def normalize(entries, version):
        path.unlink()
        return N.normalize(entries, version)

    monkeypatch.setattr(jobs, "normalize", normalize)
    store = Warehouse(spark, str(tmp_path / "w"))
    store.init()
    assert jobs.run_sync(store, str(path))["inserted"] == 5
    assert store.sync_log().first().source_version == "v1"


def test_a_list_of_small_files_is_written_by_few_tasks(spark, tmp_path):
    """Spark's reader takes 300 small files in ten tasks; the list of them is not ten files."""
    for i in range(300):
        (tmp_path / f"n{i}").write_text(str(i))
    assert streams.listed(spark, str(tmp_path)).rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    found = streams._listed_once(spark, str(tmp_path))
    assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
    assert sorted(r.length for r in found.collect()) == sorted(len(str(i)) for i in range(300))
    digests = inputs.file_digests(spark, str(tmp_path))
    assert {r.file.rsplit("/n", 1)[1]: r.sha256 for r in digests.collect()} == {str(i): hashlib.sha256(str(i).encode()).hexdigest() for i in range(300)}
