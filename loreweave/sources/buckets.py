"""Keyed tables in hash buckets with a version per bucket.

A row's bucket is the hash of its key that Spark itself deals rows out by. Every
run writes the buckets that it touches, whole, as a version of its own; the log says
which version of a bucket is current. Versions are bucketed tables to Spark, so
incoming rows, dealt out by key once, meet the stored ones without moving these, and
a run with few changes in few buckets reads and writes little. The log row of a run
is written last and makes its buckets visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.operators import sync as S
from loreweave.sources.staging import scratch, stage

_LOG = T.StructType([
    T.StructField("run", T.IntegerType()), T.StructField("version", T.IntegerType()),
    T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
])


class BucketTable:
    """A table of ``layout`` with unique ``key``, below ``root``, in ``buckets`` buckets.

    The number of buckets is fixed when the table is created; take so many that a
    bucket's rows fit into a task. Runs with changes in more than ``max_share`` of
    the buckets, or behind ``max_versions`` versions, write all buckets.
    """

    def __init__(
        self, spark: SparkSession, root: str, layout: T.StructType, key: Sequence[str], buckets: int = 200,
        *, max_versions: int = 16, max_share: float = 0.5,
    ) -> None:
        self.spark, self.root, self.layout, self.key = spark, root.rstrip("/"), layout, list(key)
        self.buckets, self.max_versions, self.max_share = buckets, max_versions, max_share
        self._session = uuid.uuid4().hex[:12]
        spark.createDataFrame([], _LOG).write.mode("ignore").parquet(f"{self.root}/log")

    # -- reading -------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.hash(*self.key), F.lit(self.buckets)).cast("int")

    def log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")

    def current(self) -> dict[int, list[int]]:
        """The buckets that each version holds and no later one."""
        rows = self.log().filter("version is not null").orderBy("run").collect()
        owner = {b: r.version for r in rows for b in r.buckets}
        found: dict[int, list[int]] = {}
        for b, version in sorted(owner.items()):
            found.setdefault(version, []).append(b)
        return found

    def _version(self, version: int) -> DataFrame:
        return self._bucketed(f"v{version}", f"{self.root}/v={version}")

    def _bucketed(self, name: str, path: str) -> DataFrame:
        """Written buckets as a table that Spark knows to be bucketed."""
        table = f"loreweave_{self._session}_{name}"
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._stored().fields)
            key = ", ".join(f"`{k}`" for k in self.key)
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(table)

    def _stored(self) -> T.StructType:
        return T.StructType([*self.layout.fields, T.StructField("_bucket", T.IntegerType())])

    def _parts(self) -> list[tuple[DataFrame, list[int]]]:
        """The current rows of each version, and its buckets."""
        return [
            (self._version(v).filter(F.col("_bucket").isin(own)), own) for v, own in self.current().items()
        ]

    def rows(self) -> DataFrame:
        out = self.spark.createDataFrame([], self.layout)
        for part, _ in self._parts():
            out = out.unionByName(part.drop("_bucket"))
        return out

    # -- writing -------------------------------------------------------------

    def _write(self, df: DataFrame, name: str, path: str) -> DataFrame:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.layout.fields]
        rows = df.select(*columns, self.bucket().alias("_bucket"))
        table = f"loreweave_{self._session}_{name}"
        rows.write.mode("overwrite").option("path", path).bucketBy(self.buckets, *self.key).sortBy(*self.key).saveAsTable(table)
        return self.spark.table(table)

    def _incoming(self, new: DataFrame) -> DataFrame:
        """Incoming rows, dealt out by key once."""
        dealt = new.repartition(self.buckets, *self.key)
        return self._write(dealt, f"in_{uuid.uuid4().hex[:8]}", scratch(self.spark, "incoming"))

    def classes(self, incoming: DataFrame, hash_col: str) -> DataFrame:
        """``key…, change, _bucket`` of every key of the table and of bucketed rows; nothing is shuffled."""
        known = self._parts()
        owned = [b for _, own in known for b in own]
        fresh = incoming.filter(~F.col("_bucket").isin(owned))
        out = fresh.select(*self.key, F.lit(S.INSERTED).alias("change"))
        for part, own in known:
            out = out.unionByName(S.diff(part, incoming.filter(F.col("_bucket").isin(own)), self.key, hash_col))
        return out.withColumn("_bucket", self.bucket())

    def sync(
        self, new: DataFrame, hash_col: str = "content_hash", *, delete_stale: bool = True, stamp: dict[str, Column] | None = None,
    ) -> dict[str, int]:
        """Bring the table in step with ``new``; returns the counts by class.

        Rows whose hash is unchanged keep all their stored columns. ``stamp``
        gives columns of new and changed rows that ``new`` does not have.
        """
        incoming = self._incoming(new.withColumns(stamp or {}))
        changes = stage(self.classes(incoming, hash_col), "classes")
        by_class = {r.change: r.n for r in changes.groupBy("change").agg(F.count("*").alias("n")).collect()}
        counts = {c: by_class.get(c, 0) for c in (S.INSERTED, S.UPDATED, S.UNCHANGED, S.DELETED)}
        counts["total_cards"] = counts[S.INSERTED] + counts[S.UPDATED] + counts[S.UNCHANGED]
        active = [S.INSERTED, S.UPDATED, *([S.DELETED] if delete_stale else [])]
        if not delete_stale:
            counts[S.DELETED] = 0
        touched = sorted(r[0] for r in changes.filter(F.col("change").isin(active)).select("_bucket").distinct().collect())
        if not touched:
            self._append(None, [], counts)
            return counts
        known = self.current()
        if len(touched) > self.max_share * self.buckets or len(known) >= self.max_versions:
            touched = sorted({*touched, *(b for own in known.values() for b in own)})
        version = (self.log().agg(F.max("version")).first()[0] or 0) + 1
        merged = self._merged(incoming.filter(F.col("_bucket").isin(touched)), touched, hash_col, delete_stale)
        self._write(merged, f"v{version}", f"{self.root}/v={version}")
        self._append(version, touched, counts)
        return counts

    def _merged(self, incoming: DataFrame, touched: list[int], hash_col: str, delete_stale: bool) -> DataFrame:
        """The next rows of the touched buckets, by a join of buckets."""
        wanted = set(touched)
        out, left = None, set(touched)
        for part, own in self._parts():
            own = [b for b in own if b in wanted]
            left.difference_update(own)
            if own:
                rows = self._next(part.filter(F.col("_bucket").isin(own)), incoming.filter(F.col("_bucket").isin(own)), hash_col, delete_stale)
                out = rows if out is None else out.unionByName(rows)
        fresh = incoming.filter(F.col("_bucket").isin(sorted(left))).drop("_bucket")
        return fresh if out is None else out.unionByName(fresh)

    def _next(self, old: DataFrame, new: DataFrame, hash_col: str, delete_stale: bool) -> DataFrame:
        names = self.layout.fieldNames()
        before = old.select(*self.key, F.struct(*names).alias("_before"))
        after = new.select(*self.key, F.struct(*names).alias("_after"))
        both = before.join(after, self.key, "full_outer")
        same = F.col(f"_before.{hash_col}").eqNullSafe(F.col(f"_after.{hash_col}"))
        keep = F.col("_before").isNotNull() & (F.col("_after").isNull() | same)
        if delete_stale:
            both = both.filter(F.col("_after").isNotNull())
        return both.select(F.when(keep, F.col("_before")).otherwise(F.col("_after")).alias("r")).select("r.*")

    def _append(self, version: int | None, buckets: list[int], counts: dict[str, int]) -> None:
        run = (self.log().agg(F.max("run")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(run, version, buckets, counts)], _LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
