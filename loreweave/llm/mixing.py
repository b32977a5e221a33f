"""Mixing sources to target weights by weighted fair queueing.

Every document of a source gets a virtual finish time: the words of its source
up to and including it, in a shuffled order, divided by the source's target. A
source that has to give more words than it has is queued again, up to three
times. All entries ordered by finish time are cut where the total budget is
used up, so each source has given its target to within a document.

Only narrow rows are queued, equal rows as one entry with a number of copies. As a
source's entries are taken in shuffle order, the cut comes down to one last place
per source and round; applying these few places to the documents moves no text.
Where the cut falls between equal rows, these are numbered and the first ones taken.

Defined cases: a null text has size 0; a null source is a source of its own,
named last; rows are shuffled by id and text, so rows that share only the id, or
have none, stand apart, and of equal rows as many are taken as fit; documents
without words are taken with the round they stand in and weigh nothing; a table
without rows gives none. Columns are taken by the given names, so others may have
any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loreweave.llm.text import count_words, squeezed
from loreweave.operators.ranking import number_rows
from loreweave.sources.staging import stage

ROUNDS = 3
#: Equal rows listed at a time.
SPAN = 10_000


def shuffle_key(id_column: Column, text: Column, seed: str) -> Column:
    """A hexadecimal key that orders documents at random, the same way in every run."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(id_column.cast("string"), F.lit("")), F.lit(":"))
    return F.md5(F.concat(name, F.md5(F.coalesce(text, F.lit("")))))


def size_of(text: Column) -> Column:
    return count_words(squeezed(text))


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    """``doc_id, source, size, key`` of every row."""
    plain = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), squeezed(F.col(text_col)).alias("plain"),
        shuffle_key(F.col(id_col), F.col(text_col), seed).alias("key"),
    )
    return plain.select("doc_id", "source", count_words(F.col("plain")).alias("size"), "key")


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``; one row per source.

    Weights 1, 2, 3 repeat over the sources in code point order. Targets share
    all words by weight; those above three times their source's size are set to
    that and the excess is shared again. With the sources in the order of size
    per weight, those at the limit come first, and the level that the others
    share at is the largest of the levels that each place in this order gives.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = total.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("bigint"))
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - ROUNDS * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    levels = weighed.withColumn("level", left / F.sum("weight").over(onward))
    share = F.max("level").over(everything) * F.col("weight")
    return levels.select(
        "source", "source_size", F.least(share, (ROUNDS * F.col("source_size")).cast("double")).alias("target")
    )


def queue(rows: DataFrame) -> DataFrame:
    """``source, key, size, same, source_size, target, before`` from rows of ``source, size, key``.

    ``same`` rows are equal, ``before`` are the source's words up to and
    including them. A source is cut into buckets of its shuffle order; sums per
    bucket are added up first, so a task sorts one bucket, about the square root
    of all rows, and not a source.
    """
    rows = stage(rows.groupBy("source", "key", "size").agg(F.count("*").alias("same")), "places")
    count = rows.count()
    digits = max(1, (count.bit_length() + 7) // 8)  # of base 16: 16**digits is near the root of count
    words = F.col("size") * F.col("same")
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))
    sums = rows.groupBy("source", "bucket").agg(F.sum(words).alias("size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    goals = targets(sums).withColumnRenamed("source", "g")
    sums = sums.withColumnsRenamed({"source": "s", "bucket": "b"}).drop("size")
    sums = sums.join(goals, F.col("s").eqNullSafe(F.col("g"))).drop("g")
    inside = Window.partitionBy("source", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("inside", F.sum(words).over(inside))
    return (
        rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("before", F.col("start") + F.col("inside"))
        .drop("s", "b", "bucket", "start", "inside")
    )


def entries(queued: DataFrame) -> DataFrame:
    """One row per round and document that has words, or place that has none, with its ``finish`` time.

    ``at`` counts the equal rows of a place. They are listed a block at a time;
    places of many blocks are dealt out by block.
    """
    one = F.lit(1).cast("bigint")
    last_block = F.when(F.col("size") > 0, F.expr(f"(same - 1) div {SPAN}")).otherwise(0)
    blocks = queued.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block.cast("bigint"))))
    many = blocks.filter(F.col("same") > SPAN).repartition("key", "block")
    blocks = blocks.filter(F.col("same") <= SPAN).unionByName(many)
    first, last = F.col("block") * SPAN + one, F.least("same", (F.col("block") + 1) * SPAN)
    at = F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array("same"))
    turn = blocks.withColumn("at", F.explode(at)).withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(ROUNDS - 1))))
    words = F.col("round") * F.col("source_size") + F.col("before") - (F.col("same") - F.col("at")) * F.col("size")
    return turn.withColumn("finish", F.coalesce(F.try_divide(words.cast("double"), F.col("target")), F.lit(0.0)))


def cut(entered: DataFrame, count: int) -> float:
    """The last finish time at which all entries up to it fit into the total budget.

    Finish times are dealt into ranges; only the range that the budget ends in
    is sorted.
    """
    ranges = 1 << max(4, count.bit_length() // 2)
    weighed = entered.filter("size > 0").withColumn(
        "range", F.least(F.floor(F.col("finish") * ranges), F.lit(4 * ranges)).cast("bigint")
    )
    sums = weighed.groupBy("range").agg(F.sum("size").alias("size"), F.max("finish").alias("last"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = stage(sums.withColumn("upto", F.sum("size").over(upto)), "ranges")
    budget = weighed.filter("round = 0").agg(F.sum("size")).first()[0] or 0
    full = sums.filter(F.col("upto") <= budget).agg(F.max("last"), F.max("upto")).first()
    over = sums.filter(F.col("upto") > budget).agg(F.min("range")).first()[0]
    if over is None:
        return full[0] or 0.0
    same = weighed.filter(F.col("range") == over).groupBy("finish").agg(F.sum("size").alias("size"))
    running = same.withColumn("upto", F.sum("size").over(Window.orderBy("finish")) + (full[1] or 0))
    inside = running.filter(F.col("upto") <= budget).agg(F.max("finish")).first()[0]
    return inside if inside is not None else full[0] or 0.0


def plan(rows: DataFrame) -> DataFrame:
    """``source, source_size, target, lasts``: the last place taken of each source, per round.

    A place is a key, and how many of its equal rows (``at``) of how many
    (``same``) are taken.
    """
    queued = stage(queue(rows), "queue")
    entered = entries(queued)
    limit = cut(entered, rows.count())
    place = F.struct("key", "at", "same")
    taken = entered.filter(F.col("finish") <= limit).groupBy("source", "round").agg(F.max(place).alias("last"))
    lasts = taken.groupBy("source").agg(F.collect_list("last").alias("lasts"))
    goals = targets(queued.select("source", (F.col("size") * F.col("same")).alias("size")))
    joined = goals.join(lasts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    return stage(joined.drop("s"), "mix")


def copies(rows: DataFrame, planned: DataFrame, source: Column) -> DataFrame:
    """Rows, with their ``key``, with ``source_size, target, copies``: how often the mix takes each row."""
    known = planned.withColumnRenamed("source", "planned_source")
    joined = rows.join(known, source.eqNullSafe(F.col("planned_source")), "left").drop("planned_source")
    lasts, key = F.coalesce("lasts", F.array()), F.col("key")
    whole = F.filter(lasts, lambda x: (key < x["key"]) | ((key == x["key"]) & (x["at"] == x["same"])))
    part = F.filter(lasts, lambda x: (key == x["key"]) & (x["at"] < x["same"]))
    joined = joined.withColumn("copies", F.size(whole).cast("bigint")).withColumn("part", part).drop("lasts")
    if planned.filter(F.exists("lasts", lambda x: x["at"] < x["same"])).isEmpty():
        return joined.drop("part")
    # The cut falls between equal rows: number these.
    between = joined.filter(F.size("part") > 0).withColumn("number", F.monotonically_increasing_id())
    between = stage(between.withColumn("place", F.to_json(F.struct(source.alias("source"), key.alias("key")))), "between")
    between = number_rows(between, ["place"], "number", "nth").drop("place")
    more = F.size(F.filter("part", lambda x: F.col("nth") < x["at"]))
    between = between.withColumn("copies", F.col("copies") + more).drop("number", "nth")
    return joined.filter(F.size("part") == 0).unionByName(between).drop("part")


def mix(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str = "mix") -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row."""
    rows = stage(sized(docs, id_col, source_col, text_col, seed), "sizes")
    out = copies(rows, plan(rows.drop("doc_id")), F.col("source"))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("key")


def mixed_documents(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns."""
    rows = stage(sized(docs, id_col, source_col, text_col, seed).drop("doc_id"), "sizes")
    key = shuffle_key(F.col(f"row.{id_col}"), F.col(f"row.{text_col}"), seed)
    whole = docs.select(F.struct("*").alias("row")).withColumn("key", key)
    out = copies(whole, plan(rows), F.col(f"row.{source_col}"))
    return out.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
