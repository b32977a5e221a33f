"""Versioned parquet tables with publish-last semantics.

A table is a base, a complete snapshot, and the deltas written after it. A
delta holds the new rows and the keys that it takes out of what came before,
so a run writes as much as has changed; reading leaves out the keys that later
deltas have taken out. The next run after a few deltas, or one with many
changes, writes a new base.

A run writes its files first and then appends one row to the log. The log row
is both the audit record and the commit: readers take what the last logged run
names, so a failed run leaves nothing visible behind, and a run without
changes writes no files at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave import schema


# The logs as stored: with the snapshot that is current after a run, and its base.
_VERSION = [T.StructField("snapshot", T.IntegerType()), T.StructField("base", T.IntegerType())]
_LOGS = {
    "sync_log": T.StructType([*schema.SYNC_LOG.fields, *_VERSION]),
    "embed_log": T.StructType([*schema.EMBED_LOG.fields, *_VERSION]),
}


@dataclass(frozen=True)
class Delta:
    """New rows, and the keys that are no longer as they were."""

    rows: DataFrame
    gone: DataFrame


class ConstraintError(ValueError):
    """Written rows break a key, a NOT NULL column or the vector width."""


def violations(
    df: DataFrame, key: Sequence[str], required: Sequence[str],
    vector_col: str | None = None, width: int | None = None,
) -> DataFrame:
    """Broken constraints with the number of offenders: ``check, n``."""
    tests = {f"{c} is null": F.col(c).isNull() for c in required}
    if vector_col is not None:
        tests[f"width is not {width}"] = F.size(vector_col) != width
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    named = [F.struct(F.lit(t).alias("check"), F.col(f"`{t}`").alias("n")) for t in tests]
    repeated = df.groupBy(*key).count().filter("count > 1").agg(
        F.lit("duplicate key").alias("check"), F.count("*").alias("n")
    )
    return counts.select(F.inline(F.array(*named))).unionByName(repeated).filter("n > 0")


def check(df: DataFrame, key: Sequence[str], required: Sequence[str],
          vector_col: str | None = None, width: int | None = None) -> None:
    bad = violations(df, key, required, vector_col, width).collect()
    if bad:
        raise ConstraintError("; ".join(f"{r.check}: {r.n}" for r in bad))


class Warehouse:
    """The tables of one knowledge base below ``root``.

    A table is written whole again after ``max_deltas`` deltas, or when more than
    ``max_share`` of its rows has changed; ``max_deltas=0`` writes it whole each
    time, so that reading it never joins. Contents are the same in any case.
    """

    def __init__(self, spark: SparkSession, root: str, *, max_deltas: int = 8, max_share: float = 0.25) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.max_deltas, self.max_share = max_deltas, max_share

    # -- tables ------------------------------------------------------------

    def init(self) -> None:
        """Create the logs if they are missing; repeating it writes nothing."""
        for name, layout in _LOGS.items():
            self._empty(layout).write.mode("ignore").parquet(f"{self.root}/{name}")

    def sync_log(self) -> DataFrame:
        return self._log("sync_log").drop("snapshot", "base")

    def embed_log(self) -> DataFrame:
        return self._log("embed_log").drop("snapshot", "base")

    def cards(self) -> DataFrame:
        return self._table("cards", self._log("sync_log"), schema.CARDS, schema.CARD_KEY)

    def vectors(self, source: str) -> DataFrame:
        """The current vectors of one source; other sources are not touched."""
        return self._table(
            f"embeddings/{source}", self._source_log(source), schema.VECTORS, ["id", "chunk_index"]
        )

    def all_vectors(self) -> DataFrame:
        out = self._empty(schema.VECTORS)
        for row in self._log("embed_log").select("source").distinct().orderBy("source").collect():
            out = out.unionByName(self.vectors(row.source))
        return out

    # -- publishing ----------------------------------------------------------

    def wants_delta(self, log: DataFrame, changed: int, total: int) -> bool:
        """Whether the next run should write a delta rather than a new base."""
        versions = self._versions(log)
        return 0 < len(versions) <= self.max_deltas and changed <= self.max_share * total

    def cards_delta(self, changed: int, total: int) -> bool:
        return self.wants_delta(self._log("sync_log"), changed, total)

    def vectors_delta(self, source: str, changed: int, total: int) -> bool:
        return self.wants_delta(self._source_log(source), changed, total)

    def publish_cards(self, cards: DataFrame | Delta | None, log: dict) -> int:
        """Write and commit the next state; ``None`` leaves the table as it is."""
        runs = self._log("sync_log")
        run = self._next_id(runs)
        version = self._version(runs)
        if cards is None and version is None:
            cards = self._empty(schema.CARDS)
        if cards is not None:
            version = self._write_version("cards", run, cards, version, schema.CARDS)
        self._append("sync_log", {**log, **version, "id": run})
        return run

    def publish_vectors(
        self, source: str, vectors: DataFrame | Delta, width: int, log: dict, fresh: Column | None = None
    ) -> int:
        """Write, check and commit vectors of one source.

        In a complete snapshot ``fresh`` marks the rows that are new; the
        others have been checked when they were written first.
        """
        run = self._next_id(self._log("embed_log"))
        current = self._version(self._source_log(source))
        version = self._write_version(f"embeddings/{source}", run, vectors, current, schema.VECTORS)
        written = self._read(f"{self.root}/embeddings/{source}/v={run}/rows", schema.VECTORS)
        if fresh is not None and not isinstance(vectors, Delta):
            written = written.filter(fresh)
        check(written, schema.VECTOR_KEY, schema.VECTOR_REQUIRED, "embedding", width)
        self._append("embed_log", {**log, **version, "id": run, "source": source})
        return run

    # -- versions ------------------------------------------------------------

    def _source_log(self, source: str) -> DataFrame:
        return self._log("embed_log").filter(F.col("source") == source)

    @staticmethod
    def _version(log: DataFrame) -> dict | None:
        row = log.agg(F.max_by(F.struct("snapshot", "base"), "id").alias("v")).first().v
        return row and row.asDict()

    def _versions(self, log: DataFrame) -> list[int]:
        """The base that is current and the deltas after it."""
        version = self._version(log)
        if version is None:
            return []
        same_base = log.filter(F.col("base") == version["base"]).select("snapshot").distinct()
        return sorted(r.snapshot for r in same_base.collect())

    def _table(self, folder: str, log: DataFrame, layout: T.StructType, key: list[str]) -> DataFrame:
        versions = self._versions(log)
        key_layout = T.StructType([layout[k] for k in key])
        out = None
        for i, v in enumerate(versions):
            rows = self._read(f"{self.root}/{folder}/v={v}/rows", layout)
            if later := versions[i + 1 :]:
                paths = [f"{self.root}/{folder}/v={w}/gone" for w in later]
                gone = self.spark.read.schema(key_layout).parquet(*paths)
                rows = rows.join(gone, key, "left_anti").select(*layout.fieldNames())
            out = rows if out is None else out.unionByName(rows)
        return self._empty(layout) if out is None else out

    def _write_version(
        self, folder: str, run: int, data: DataFrame | Delta, current: dict | None, layout: T.StructType
    ) -> dict:
        path = f"{self.root}/{folder}/v={run}"
        rows = data.rows if isinstance(data, Delta) else data
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.fields]
        # Overwrites only leftovers of a failed run: the id is not in the log yet.
        rows.select(*columns).write.mode("overwrite").parquet(f"{path}/rows")
        if not isinstance(data, Delta):
            return {"snapshot": run, "base": run}
        data.gone.write.mode("overwrite").parquet(f"{path}/gone")
        return {"snapshot": run, "base": current["base"]}

    # -- helpers -------------------------------------------------------------

    def _empty(self, layout: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], layout)

    def _read(self, path: str, layout: T.StructType) -> DataFrame:
        return self.spark.read.schema(layout).parquet(path)

    def _log(self, name: str) -> DataFrame:
        return self._read(f"{self.root}/{name}", _LOGS[name])

    def _append(self, name: str, values: dict) -> None:
        columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in _LOGS[name].fields]
        row = self.spark.range(0, 1, numPartitions=1).select(*columns)
        row.write.mode("append").parquet(f"{self.root}/{name}")

    @staticmethod
    def _next_id(log: DataFrame) -> int:
        return (log.agg(F.max("id")).first()[0] or 0) + 1


def run_time() -> datetime:
    """One time stamp per run, as a transaction clock would give."""
    return datetime.now(timezone.utc)
