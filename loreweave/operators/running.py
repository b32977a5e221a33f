"""Counts kept up from the changes of a table instead of being taken again.

A change is a row that comes (+1) or goes (-1); an updated row does both. Per group
the state holds how many rows there are, how many of them meet each test, and per
value of a distinct column how many rows have it, all as signed sums: one small
table per run, added up when read. Next to them stands a sketch of the keys of each
run's table, from which the number of vanished keys is estimated without reading
either table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("base", T.IntegerType())])


class RunningCounts:
    """Counts by ``groups`` below ``root``.

    ``tests`` are conditions by name; ``distinct`` columns get the number of
    their different values, nulls left out. After ``max_runs`` runs the sums are
    written down as a new base. Readers see runs whose log row is written.
    """

    def __init__(
        self, spark: SparkSession, root: str, groups: Sequence[str], tests: Mapping[str, Column] | None = None,
        distinct: Sequence[str] = (), *, max_runs: int = 16,
    ) -> None:
        self.spark, self.root, self.groups = spark, root.rstrip("/"), list(groups)
        self.tests, self.distinct, self.max_runs = dict(tests or {}), list(distinct), max_runs
        spark.createDataFrame([], _LOG).write.mode("ignore").parquet(f"{self.root}/log")

    def _runs(self) -> list[int]:
        rows = self.spark.read.schema(_LOG).parquet(f"{self.root}/log").orderBy("run").collect()
        return [r["run"] for r in rows if r["run"] >= rows[-1]["base"]] if rows else []

    def apply(self, coming: DataFrame, going: DataFrame) -> int:
        """Takes in rows that come and rows that go, with all their columns as they were."""
        signed = coming.withColumn("_sign", F.lit(1)).unionByName(going.withColumn("_sign", F.lit(-1)))
        sums = {"n": F.sum("_sign"), **{name: F.sum(F.when(test, F.col("_sign")).otherwise(0)) for name, test in self.tests.items()}}
        counts = signed.groupBy(*self.groups).agg(*[s.cast("bigint").alias(name) for name, s in sums.items()])
        values = None
        for c in self.distinct:
            own = signed.filter(F.col(c).isNotNull()).groupBy(*self.groups, F.lit(c).alias("_column"), F.col(c).cast("string").alias("_value"))
            own = own.agg(F.sum("_sign").cast("bigint").alias("_n")).filter("_n <> 0")
            values = own if values is None else values.unionByName(own)
        runs = self._runs()
        run, base = max(runs, default=0) + 1, min(runs, default=1)
        if len(runs) >= self.max_runs:
            base = run
            counts = self._added(self._read(runs, "counts").unionByName(counts))
            if values is not None:
                values = self._added_values(self._read(runs, "values").unionByName(values))
        counts.write.mode("overwrite").parquet(f"{self.root}/run={run}/counts")
        if values is not None:
            values.write.mode("overwrite").parquet(f"{self.root}/run={run}/values")
        self.spark.createDataFrame([(run, base)], _LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return run

    def _read(self, runs: list[int], name: str) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/run={r}/{name}" for r in runs])

    def _added(self, counts: DataFrame) -> DataFrame:
        names = ["n", *self.tests]
        return counts.groupBy(*self.groups).agg(*[F.sum(c).alias(c) for c in names])

    def _added_values(self, values: DataFrame) -> DataFrame:
        return values.groupBy(*self.groups, "_column", "_value").agg(F.sum("_n").alias("_n")).filter("_n <> 0")

    def counts(self) -> DataFrame:
        """The groups that have rows, with ``n``, the tests, and ``distinct_<column>``; equal to a recount."""
        runs = self._runs()
        if not runs:
            raise ValueError("no run yet")
        out = self._added(self._read(runs, "counts")).filter("n > 0")
        if not self.distinct:
            return out
        values = self._added_values(self._read(runs, "values"))
        sizes = values.groupBy(*self.groups).agg(
            *[F.count_if(F.col("_column") == c).alias(f"distinct_{c}") for c in self.distinct]
        )
        on = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in self.groups]
        sizes = sizes.withColumnsRenamed({g: f"_{g}" for g in self.groups})
        test = on[0] if on else F.lit(True)
        for more in on[1:]:
            test = test & more
        joined = out.join(sizes, test, "left") if on else out.join(sizes, F.lit(True), "left")
        filled = [F.coalesce(f"distinct_{c}", F.lit(0)).alias(f"distinct_{c}") for c in self.distinct]
        return joined.select(*out.columns, *filled)


def key_sketch(rows: DataFrame, key: Sequence[str], *, size: int = 14) -> DataFrame:
    """``keys``: a sketch of the different keys, of ``2 ** size`` of their hashes at most."""
    return rows.agg(F.expr(f"theta_sketch_agg(xxhash64({', '.join(f'`{k}`' for k in key)}), {size})").alias("keys"))


def estimated_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old_keys, new_keys, vanished, added`` from two sketches, as estimates.

    The relative error of a count of n keys has a deviation of about
    ``1 / sqrt(2 ** size)`` times the root of (larger set / n); sets that fit into
    the sketch are exact.
    """
    both = old.select(F.col("keys").alias("o")).join(new.select(F.col("keys").alias("n")))
    size = "theta_sketch_estimate({})".format
    return both.selectExpr(
        f"{size('o')} AS old_keys", f"{size('n')} AS new_keys",
        f"{size('theta_difference(o, n)')} AS vanished", f"{size('theta_difference(n, o)')} AS added",
    )


def vanished_keys(
    old: DataFrame, new: DataFrame, key: Sequence[str], old_sketch: DataFrame, new_sketch: DataFrame, *, least: int = 1
) -> DataFrame:
    """Old keys that are not among the new ones, sought only if the sketches expect ``least`` or cannot rule them out.

    Sketches of sets that did not fit may miss a few keys, so they rule vanished
    keys out only where they are exact.
    """
    found = estimated_changes(old_sketch, new_sketch).first()
    exact = max(found["old_keys"], found["new_keys"]) < 2**12
    if exact and found["vanished"] < least:
        return old.select(*key).limit(0)
    return old.select(*key).join(new.select(*key), list(key), "left_anti").distinct()
