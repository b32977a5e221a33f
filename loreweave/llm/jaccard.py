"""N-gram Jaccard join by a token-group matrix: all texts whose sets of five-word shingles are 0.8 alike.

Texts with the same set are one class. A class can only be linked if enough of its
shingles stand in other classes too. That is tested first on the least hashes of
each set, of which alike sets share a known number, and then on whole sets, so most
classes leave before anything is compared. Sets are counted in blocks: a block asks
shards of the hashes for the number of texts that have each of its shingles, in
arrays of bounded size.

The shingles of a set are ordered by how rarely they occur; of two alike sets, the
rarest few share one. Classes are partitioned into groups of similar ones: classes
that share a frequent one of these few are compared in bounded parts, parts are
linked through one member per group, and what is linked is a group. Groups keep the
union of their members' shingles, a row of the token-group matrix per shingle: the
rarest few as a table, with bounds of sizes and places, and whole unions where a
group is opened. A class meets groups other than its own through the table, bounds
its overlap with them by sizes, places and then by the whole union, and only groups
that qualify are opened and compared member by member. The members of a group are
linked already, so one link to a part of it is enough, and a large group of near
copies costs no pairs.

Every two alike sets are either in one group or met in this way, so the classes'
components are exact.

Defined cases: a text without words has an empty set and is linked with nothing, its
own id names it; a text of fewer words than a shingle is one shingle; equal rows
share a class; a null id names a component only if all its ids are null; no rows
give none. Texts of any length are used whole. Only the id and the text are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from loreweave.llm.batches import slices
from loreweave.llm.components import components
from loreweave.operators.ranking import keep_first
from loreweave.sources.staging import stage

#: Words per shingle, and the similarity of links as a fraction.
SIZE, ALIKE = 5, (4, 5)
#: Shingles per block of sets, and per shard of the hashes.
BLOCK, SHARD = 2_000_000, 1_000_000
#: Members and shingles that a task compares at a time, and classes that meet them.
MEMBERS, TOKENS, QUERIES = 256, 4_000_000, 1_024
#: Columns of a matrix product.
COLUMNS = 1 << 14
#: Words whose hashes a task keeps; the store starts anew beyond it.
MOST_WORDS = 1_000_000
#: Classes whose names are sent to all tasks (about 50 bytes each); more are joined by a shuffle.
SENT = 1_000_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Shingler:
    """Sets of shingles as rising 64-bit hashes, from hashes of words."""

    def __init__(self) -> None:
        self.known = _Hashes()

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > MOST_WORDS:
            self.known = _Hashes()
        codes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        size = min(SIZE, len(words))
        n = len(words) - size + 1
        mixed = np.full(n, size, np.uint64)
        for k in range(size):
            mixed += codes[k : k + n] * _ODD[k]
            mixed ^= mixed >> np.uint64(29)
            mixed *= _ODD[0]
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def common(n):
    """The least number of shingles that a set of ``n`` shares with one that is alike."""
    return -(-n * ALIKE[0] // ALIKE[1])


def least_shared(n):
    """How many of the least hashes are kept beyond those that may not be shared."""
    return 1 + n // 10


class _Blocks:
    """Numbers blocks of sets that follow each other in a task."""

    def __init__(self) -> None:
        self.now, self.size = TaskContext.get().partitionId() << 32, 0

    def __call__(self, sizes: list[int]) -> list[int]:
        found = []
        for n in sizes:
            if self.size + n > BLOCK and self.size:
                self.now, self.size = self.now + 1, 0
            self.size += n
            found.append(self.now)
        return found


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, key, n, block, tokens``: a set's name, its size, and its least hashes.

    Of all shingles that two alike sets share, ``least_shared`` of the smaller
    set are among the least hashes of both.
    """
    import xxhash

    out = StructType([
        StructField("doc_id", docs.schema[id_col].dataType), StructField("text_key", BinaryType()), StructField("key", BinaryType()),
        StructField("n", LongType()), StructField("block", LongType()), StructField("tokens", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, blocks = Shingler(), _Blocks()
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                sets = [shingles(t) for t in texts]
                least = [s[: len(s) - common(len(s)) + least_shared(len(s))] for s in sets]
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(blocks([len(s) for s in least]), pa.int64()),
                     pa.array([s.tobytes() for s in least], pa.binary())],
                    out.names,
                )

    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), text.cast("binary").alias("text"), _text_key(text)).mapInArrow(run, out)


def _text_key(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("text_key")


def whole_sets(texts: DataFrame) -> DataFrame:
    """``c, n, block, tokens`` of ``c, n, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, blocks = Shingler(), _Blocks()
        for batch in batches:
            at = 0
            for some in slices(batch.column(2)):
                sets = [shingles(t) for t in some]
                part = batch.slice(at, len(some))
                at += len(some)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(blocks([len(s) for s in sets]), pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["c", "n", "block", "tokens"],
                )

    plain = texts.select("c", "n", F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(run, "c long, n long, block long, tokens binary")


def _tokens(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def frequencies(sets: DataFrame, total: int) -> DataFrame:
    """``block, shard, df``: how many of all sets have each different shingle of a block.

    ``df`` are 32-bit numbers in the order of the shingles; shards are ranges of
    these, about ``SHARD`` of the ``total`` shingles each. A shingle is counted
    in its block first, so one that stands everywhere is one number per block.
    """
    bits = max(0, (total // SHARD).bit_length())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def asked(block: int, held: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            shards = values >> np.uint64(64 - bits) if bits else np.zeros(len(values), np.uint64)
            names, first = np.unique(shards, return_index=True)
            cuts = first[1:]
            return pa.RecordBatch.from_arrays(
                [pa.array(names.astype(np.int64)), pa.array([block] * len(names), pa.int64()),
                 pa.array([x.tobytes() for x in np.split(values, cuts)][: len(names)], pa.binary()),
                 pa.array([x.astype("<u4").tobytes() for x in np.split(counts, cuts)][: len(names)], pa.binary())],
                ["shard", "block", "tokens", "counts"],
            )

        now, held = None, []
        for batch in batches:
            for block, tokens in zip(batch.column(0).to_pylist(), _tokens(batch.column(1)), strict=True):
                if block != now and held:
                    yield asked(now, held)
                    held = []
                now = block
                held.append(tokens)
        if held:
            yield asked(now, held)

    def count(group: pa.Table) -> pa.Table:
        tokens, blocks = _tokens(group["tokens"]), group["block"].to_numpy()
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in group["counts"].to_pylist()])
        values, place = np.unique(np.concatenate(tokens), return_inverse=True)
        df = np.minimum(np.bincount(place, counts), 2**32 - 1).astype("<u4")
        names, found = np.unique(blocks), []
        for block in names:
            own = [tokens[i] for i in np.flatnonzero(blocks == block)]
            own = own[0] if len(own) == 1 else np.unique(np.concatenate(own))
            found.append(df[np.searchsorted(values, own)].tobytes())
        return pa.table({"block": names, "shard": pa.array([group["shard"][0].as_py()] * len(names), pa.int64()), "df": pa.array(found, pa.binary())})

    asked = sets.select("block", "tokens").mapInArrow(ask, "shard long, block long, tokens binary, counts binary")
    return asked.groupBy("shard").applyInArrow(count, "block long, shard long, df binary")


def _matched(sets: list[np.ndarray], replies: pa.Table) -> list[np.ndarray]:
    """The frequencies of each set's shingles, from all sets of a block and the shards' replies."""
    replies = replies.sort_by("shard")
    df = np.concatenate([np.zeros(0, "<u4"), *[np.frombuffer(x, "<u4") for x in replies["df"].to_pylist()]])
    both = np.concatenate(sets)
    values, place = np.unique(both, return_inverse=True)
    if len(values) != len(df):
        raise ValueError("a block and its frequencies differ")
    return np.split(df[place], np.cumsum([len(s) for s in sets])[:-1])


def _surviving(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``c, n, text_key`` of classes whose least hashes are shared with others often enough."""
    total = rows.agg(F.coalesce(F.sum(F.octet_length("tokens") / 8), F.lit(0)).cast("long")).first()[0]
    replies = frequencies(rows.filter("n > 0"), total).select("block", "shard", "df", F.lit(None).cast("binary").alias("name"), F.lit(0).cast("long").alias("copies"))
    # A class of several rows is counted as often: its shingles have to stand in more.
    several = stage(classes.filter("copies > 1").select(F.col("key").alias("name"), "copies"), "several")
    several = rows.select("block", "key").join(several, F.col("key") == F.col("name")).select("block", "name", "copies").distinct()
    replies = replies.unionByName(several.select("block", F.lit(-1).cast("long").alias("shard"), F.lit(None).cast("binary").alias("df"), "name", "copies"))

    def alive(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"key": pa.array([], pa.binary())})
        n, keys = left["n"].to_numpy(), left["key"].to_pylist()
        kind = right["shard"].to_numpy() < 0
        copies = {r["name"]: r["copies"] for r in right.filter(pa.array(kind)).select(["name", "copies"]).to_pylist()}
        found = _matched(_tokens(left["tokens"]), right.filter(pa.array(~kind)))
        shared = np.array([int((df > copies.get(k, 1)).sum()) for df, k in zip(found, keys, strict=True)])
        # An alike set has least_shared(common(n)) of them at least.
        return pa.table({"key": left["key"].filter(pa.array(shared >= least_shared(common(n))))})

    left = rows.filter("n > 0").select("block", "key", "n", "tokens").groupBy("block")
    keys = left.cogroup(replies.groupBy("block")).applyInArrow(alive, "key binary").distinct().withColumnRenamed("key", "alive")
    kept = classes.join(keys, F.col("key") == F.col("alive"), "left_semi")
    return stage(kept.select("c", "n", "text_key"), "surviving")


def _rarest(sets: DataFrame) -> DataFrame:
    """``c, n, tokens, rarest``: each set's rarest shingles that others share, as ``token, df, reach``.

    Sets of which too many shingles stand in no other are left out.

    Two alike sets share one of them, and the first that they share, in this
    order, has a ``reach`` in both that is no less than the number they share.
    """
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long")).first()[0]

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, parts = [], []
        tokens = _tokens(left["tokens"])
        for i, df in enumerate(_matched(tokens, right) if tokens else []):
            # Shingles of no other set come first in the order, so the reach starts at the number of shared ones.
            live = np.flatnonzero(df > 1)
            some = len(live) - common(len(df)) + 1
            if some > 0:
                own = live[np.lexsort((tokens[i][live], df[live]))[:some]]
                rows.append(i)
                parts.append((tokens[i][own].view(np.int64), df[own].astype(np.int64), np.arange(len(live), len(live) - some, -1)))
        token, df, reach = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 3
        ends = np.concatenate([[0], np.cumsum([len(x[0]) for x in parts])]).astype(np.int32)
        entry = pa.StructArray.from_arrays([pa.array(token), pa.array(df), pa.array(reach)], ["token", "df", "reach"])
        kept = left.select(["c", "n", "tokens"]).take(pa.array(rows, pa.int64()))
        return kept.append_column("rarest", pa.ListArray.from_arrays(pa.array(ends), entry))

    replies = frequencies(sets, total).groupBy("block")
    out = "c long, n long, tokens binary, rarest array<struct<token: long, df: long, reach: long>>"
    return stage(sets.groupBy("block").cogroup(replies).applyInArrow(pick, out), "rarest")


def _shared_counts(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """How many shingles each of ``sets`` shares with each of ``others`` (or of ``sets``), by products of 0-1 matrices."""
    both = sets if others is None else [*sets, *others]
    sizes = [len(s) for s in both]
    values, column, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(both)), sizes)
    live = times[column] > 1
    place = np.cumsum(times > 1) - 1
    row, column = row[live], place[column[live]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    found = np.zeros((len(sets), len(both) if others is None else len(others)), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        here = slice(*np.searchsorted(column, [at, at + COLUMNS]))
        matrix = np.zeros((len(both), min(COLUMNS, int(column[-1]) + 1 - at)), np.float32)
        matrix[row[here], column[here] - at] = 1
        other = matrix if others is None else matrix[len(sets) :]
        found += (matrix[: len(sets)] @ other.T).astype(np.int64)
    return found


def _alike(shared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return shared * ALIKE[1] >= (n[:, None] + m - shared) * ALIKE[0]


def _roots(near: np.ndarray) -> np.ndarray:
    """The first member that each member is linked to, itself if none."""
    label = np.arange(len(near))
    i, j = np.nonzero(near)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _parts(members: DataFrame, name: str) -> DataFrame:
    """Adds ``parts`` and ``part``: members of ``name`` in parts of bounded size."""
    sized = members.groupBy(name).agg(F.count("*").alias("k"), F.sum("n").alias("t"))
    parts = F.greatest(F.ceil(F.col("k") / MEMBERS), F.ceil(F.col("t") / TOKENS))
    sized = stage(sized.select(F.col(name).alias("of"), parts.alias("parts"), "k"), "parts")
    dealt = members.join(sized, F.col(name) == F.col("of")).drop("of")
    return dealt.withColumn("part", F.pmod(F.xxhash64("c"), "parts"))


def _first_links(rarest: DataFrame) -> DataFrame:
    """``u, v``: links inside parts of classes that share a frequent one of their rarest shingles."""

    def link(group: pa.Table) -> pa.Table:
        c, n = group["c"].to_numpy(), group["n"].to_numpy()
        order = np.argsort(c)
        tokens = _tokens(group["tokens"])
        root = _roots(_alike(_shared_counts([tokens[i] for i in order]), n[order], n[order]))
        return pa.table({"c": c[order], "n": n[order], "token": group["token"].slice(0, 1).take(pa.array([0] * len(c))),
                         "parts": group["parts"].slice(0, 1).take(pa.array([0] * len(c))), "root": c[order][root]})

    # Of the most frequent ones, by powers of two, the one with the least hash.
    best = F.array_min(F.transform("rarest", lambda x: F.struct(
        (-F.floor(F.log2(x["df"]))).alias("rank"), F.xxhash64(x["token"]).alias("hash"), x["token"].alias("token"))))
    members = rarest.select("c", "n", best["token"].alias("token"))
    links, before = None, None
    while True:
        dealt = _parts(members, "token").filter("k > 1")
        found = dealt.join(rarest.select("c", "tokens"), "c").groupBy("token", "part").applyInArrow(
            link, "c bigint, n bigint, token bigint, parts bigint, root bigint"
        )
        found = stage(found, "linked")
        new = found.filter("c <> root").select(F.col("c").alias("u"), F.col("root").alias("v"))
        links = new if links is None else links.union(new)
        members = found.filter("c = root and parts > 1").select("c", "n", "token")
        left = members.count()
        if not left or before is not None and left > before / 2:
            return links
        before = left


def _met(rarest: DataFrame, labels: DataFrame) -> DataFrame:
    """``c, n, label``: classes and the groups, other than their own, whose bounds they pass."""
    rows = rarest.drop("tokens").join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("own", F.coalesce("root", "c"))
    rows = rows.select("c", "n", "own", F.inline("rarest"))
    rows = stage(rows.drop("df"), "rows")
    matrix = rows.groupBy(F.col("token").alias("t"), F.col("own").alias("label")).agg(
        F.min("n").alias("fewest"), F.max("n").alias("most"), F.max("reach").alias("farthest")
    )
    matrix = stage(matrix, "matrix")
    a, b = ALIKE
    passes = (
        (F.col("token") == F.col("t")) & (F.col("own") > F.col("label"))
        & (F.least("reach", "farthest") * (a + b) >= (F.col("n") + F.col("fewest")) * a)
        & (F.col("most") * b >= F.col("n") * a) & (F.col("n") * b >= F.col("fewest") * a)
    )
    met = rows.join(matrix, passes).select("c", "n", "label").distinct()
    return stage(met, "met")


def _later_links(met: DataFrame, rarest: DataFrame, labels: DataFrame) -> DataFrame:
    """``u, v``: one link from each class to each part of a group that has a member alike."""

    def compare(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False)
        c, n, tokens = group["c"].to_numpy(), group["n"].to_numpy(), _tokens(group["tokens"])
        members, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
        u, v = [], []
        if len(members) and len(queries):
            union = np.unique(np.concatenate([tokens[i] for i in members]))
            own = np.concatenate([tokens[i] for i in queries])
            place = np.minimum(np.searchsorted(union, own), len(union) - 1)
            inside = np.add.reduceat((union[place] == own).astype(np.int64), np.cumsum([0, *n[queries][:-1]]))
            queries = queries[inside * (ALIKE[0] + ALIKE[1]) >= (n[queries] + n[members].min()) * ALIKE[0]]
            for at in range(0, len(queries), MEMBERS):
                some = queries[at : at + MEMBERS]
                near = _alike(_shared_counts([tokens[i] for i in some], [tokens[i] for i in members]), n[some], n[members])
                hit = near.any(axis=1)
                u.append(c[some[hit]])
                v.append(c[members[near.argmax(axis=1)[hit]]])
        none = [np.zeros(0, np.int64)]
        return pa.table({"u": np.concatenate(none + u), "v": np.concatenate(none + v)})

    asked = met.groupBy("label").agg(F.ceil(F.greatest(F.count("*") / QUERIES, F.sum("n") / TOKENS)).alias("blocks"))
    asked = stage(asked.withColumnRenamed("label", "of"), "asked")
    inside = rarest.select("c", "n").join(labels.withColumnRenamed("node", "c"), "c", "left")
    inside = inside.select("c", "n", F.coalesce("root", "c").alias("label"))
    inside = inside.join(asked, F.col("label") == F.col("of"), "left_semi")
    parts = stage(_parts(inside, "label"), "opened")
    members = parts.join(asked, F.col("label") == F.col("of")).select(
        "c", "n", "label", "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("asks")
    )
    places = parts.select(F.col("label").alias("l"), "parts").distinct()
    queries = met.join(asked, F.col("label") == F.col("of")).withColumn("block", F.pmod(F.xxhash64("c"), "blocks"))
    queries = queries.join(places, F.col("label") == F.col("l")).select(
        "c", "n", "label", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "block", F.lit(True).alias("asks")
    )
    all_rows = members.unionByName(queries).join(rarest.select("c", "tokens"), "c")
    return all_rows.groupBy("label", "part", "block").applyInArrow(compare, "u bigint, v bigint")


def class_links(sets: DataFrame) -> DataFrame | None:
    """``u, v``: links that connect all alike sets, and no others, of ``c, n, tokens``; none if no set has a partner."""
    rarest = _rarest(sets)
    if rarest.isEmpty():
        return None
    links = stage(_first_links(rarest), "links")
    labels = components(links)
    met = _met(rarest, labels)
    if met.isEmpty():
        return links
    return links.union(stage(_later_links(met, rarest, labels), "links"))


def join(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; the component is named by its least id."""
    rows = stage(sketches(docs, id_col, text_col), "sketches")
    classes = rows.filter("n > 0").groupBy("key", "n").agg(
        F.min("doc_id").alias("first"), F.min("text_key").alias("text_key"), F.count("*").alias("copies")
    )
    classes = stage(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    surviving = _surviving(rows, classes).withColumnRenamed("text_key", "k")
    if surviving.count() <= SENT:
        surviving = F.broadcast(surviving)
    texts = docs.select(F.col(text_col).alias("text"), _text_key(F.col(text_col)))
    texts = keep_first(texts.join(surviving, F.col("text_key") == F.col("k")).select("c", "n", "text"), ["c"], F.col("c"))
    sets = stage(whole_sets(texts), "sets")
    links = class_links(sets)
    named = classes.select("key", "first", F.col("c").alias("root"))
    if links is not None:
        roots = components(links)
        rooted = classes.join(roots, F.col("c") == F.col("node"), "left").select("key", "first", F.coalesce("root", "c").alias("root"))
        names = rooted.groupBy("root").agg(F.min("first").alias("first")).withColumnRenamed("root", "r")
        named = rooted.drop("first").join(names, F.col("root") == F.col("r"))
    named = stage(named.select(F.col("key").alias("k"), F.col("first").alias("component")), "names")
    out = rows.join(named, F.col("key") == F.col("k"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
