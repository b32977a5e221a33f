"""The jobs of a knowledge base: sync the cards, embed the chunks, run both."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave import schema
from loreweave.operators import sync as S
from loreweave.operators.chunks import SOURCES, ChunkSource, last_chunk
from loreweave.operators.embedding import Backend, pending, with_hash
from loreweave.operators.normalize import normalize
from loreweave.sources.inputs import check_digests, read_books, read_dump, read_entry_lines, read_split_dump
from loreweave.sources.staging import stage
from loreweave.sources.warehouse import Delta, Warehouse, check, run_time

log = logging.getLogger(__name__)

_CHUNK = ["id", "chunk_index"]


def sync_cards(
    store: Warehouse, rows: DataFrame, source_version: str, source_sha256: str,
    *, delete_stale: bool = True,
) -> dict[str, int]:
    """Bring the card table in step with ``rows``; returns the counts by class.

    The incoming rows and the changed keys are written down once, so counts
    and table see the same rows, and a lost executor repeats little. What has
    changed is added as a delta; the table is written whole only from time to
    time.
    """
    now = run_time()
    old = store.cards()
    new = stage(rows.select(*schema.CARD_COLUMNS), "incoming")
    check(new, schema.CARD_KEY, [c for c in schema.CARD_REQUIRED if c != "updated_at"])
    classes = S.diff(old, new, schema.CARD_KEY)
    changes = stage(classes.filter(F.col("change") != S.UNCHANGED), "changes")
    by_class = {r.change: r.n for r in changes.groupBy("change").agg(F.count("*").alias("n")).collect()}
    total = new.count()
    counts = {
        "inserted": by_class.get(S.INSERTED, 0),
        "updated": by_class.get(S.UPDATED, 0),
        "deleted": by_class.get(S.DELETED, 0) if delete_stale else 0,
        "total_cards": total,
    }
    counts["unchanged"] = total - counts["inserted"] - counts["updated"]
    stamped = new.withColumn("updated_at", F.lit(now))
    n_changed = counts["inserted"] + counts["updated"] + counts["deleted"]
    if n_changed == 0:
        table = None
    elif store.cards_delta(n_changed, total):
        table = Delta(
            S.fresh_rows(stamped, schema.CARD_KEY, changes),
            S.leaving_keys(schema.CARD_KEY, changes, delete_stale=delete_stale),
        )
    else:
        table = S.merge(old, stamped, schema.CARD_KEY, changes, delete_stale=delete_stale)
    store.publish_cards(table, {
        "started_at": now, "finished_at": now, "source_version": source_version,
        "source_sha256": source_sha256, "status": "success", **counts,
    })
    return counts


def run_sync(
    store: Warehouse, dump: str | None = None, sidecar: str | None = None, *, lines: str | None = None,
    delete_stale: bool = True, partitions: int | None = None, split: int | None = None,
) -> dict[str, int]:
    """Verify, read, normalise and sync dumps, or entries as JSON lines, which Spark can split.

    ``split`` cuts uncompressed dumps into ranges of so many bytes, parsed in parallel.
    Every row carries the version of its own input; the log names all versions
    and one digest over the verified files, which for one file is its own.
    """
    if (dump is None) == (lines is None):
        raise ValueError("give either a dump or lines")
    sha = ""
    if sidecar is not None:
        digests = sorted(r.sha256 for r in check_digests(store.spark, dump or lines, sidecar).select("sha256").collect())
        sha = digests[0] if len(digests) == 1 else hashlib.sha256("".join(digests).encode()).hexdigest()
    if lines is None and split is not None:
        _, entries = read_split_dump(store.spark, dump, size=split)
        entries = stage(entries, "entries")
    elif lines is None:
        # Written down once: the versions would parse every dump again.
        _, entries = read_dump(store.spark, dump, partitions=partitions)
        entries = stage(entries, "entries")
    else:
        entries = read_entry_lines(store.spark, lines)
    rows = normalize(entries, F.col("version"))
    versions = sorted(r.version for r in entries.select("version").distinct().collect() if r.version is not None)
    return sync_cards(store, rows, ",".join(versions), sha, delete_stale=delete_stale)


def embed_source(
    store: Warehouse, name: str, chunks: DataFrame, model: Backend, *, full_refresh: bool = False
) -> int:
    """Embed the chunks of one source that changed; returns how many.

    Of chunks with the same id and index the last one counts: the one with the
    greatest ``ordinal`` if the source gives this column, else the one that comes
    last. Changes are found on ids and hashes alone and written down; only the
    chunks they name get their text built (again) and go to the model, whose
    vectors are written straight into the table, so it runs once. On a first
    load or a full refresh every chunk is new and nothing is compared.
    """
    stored = store.vectors(name)
    place = F.col("ordinal") if "ordinal" in chunks.columns else F.monotonically_increasing_id()
    single = last_chunk(chunks.select("id", "chunk_index", "chunk_text", place.alias("ordinal")), _CHUNK, "ordinal")
    hashed = with_hash(single.drop("ordinal"), model.name)
    if full_refresh or stored.isEmpty():
        ids = stage(hashed.select(*_CHUNK), "chunk-ids")
        changed = hashed
    else:
        ids = stage(pending(hashed, stored).select(*_CHUNK), "changed-ids")
        changed = hashed.join(ids, _CHUNK, "left_semi")
    n = ids.count()
    if n == 0:
        return 0
    now = run_time()
    fresh = model.embed(changed, "chunk_text").withColumns({
        "source": F.lit(name), "model": F.lit(model.name), "updated_at": F.lit(now),
    }).select(*schema.VECTORS.fieldNames())
    if not full_refresh and store.vectors_delta(name, n, stored.count()):
        table = Delta(fresh, ids)
    else:
        kept = stored.join(ids, _CHUNK, "left_anti")
        table = kept.select(*schema.VECTORS.fieldNames()).unionByName(fresh)
    store.publish_vectors(
        name, table, model.width, {"model": model.name, "embedded": n, "finished_at": now},
        F.col("updated_at") == F.lit(now),
    )
    return n


def run_embed(
    store: Warehouse, inputs: Mapping[str, DataFrame], model: Backend,
    *, only: Sequence[str] | None = None, full_refresh: bool = False,
    sources: Mapping[str, ChunkSource] = SOURCES,
) -> dict[str, int]:
    """Embed all sources or a selection; each one is published on its own."""
    done = {}
    for name in list(sources) if only is None else only:
        if name not in sources:
            log.warning("unknown source %s, skipped", name)
            continue
        chunks = sources[name](dict(inputs))
        done[name] = embed_source(store, name, chunks, model, full_refresh=full_refresh)
    return done


def run(
    spark: SparkSession, root: str, *, dump: str | None = None, sidecar: str | None = None,
    lines: str | None = None, books: str | None = None, model: Backend | None = None,
    init_only: bool = False, etl_only: bool = False, embed_only: bool = False,
    full_refresh: bool = False, only: Sequence[str] | None = None,
) -> dict[str, dict[str, int]]:
    """The stages by flag; the tables are always made sure of first.

    Without a selection the rules are left out if there are no books; asking
    for them without books is an error.
    """
    if only is not None and "rules" in only and books is None:
        raise ValueError("the source rules needs books")
    store = Warehouse(spark, root)
    store.init()
    done: dict[str, dict[str, int]] = {}
    if init_only:
        return done
    if not embed_only:
        done["sync"] = run_sync(store, dump, sidecar, lines=lines)
    if not etl_only:
        inputs = {"cards": store.cards()}
        if books is not None:
            inputs["books"] = read_books(spark, books)
        wanted = [s for s in SOURCES if s != "rules" or books is not None] if only is None else only
        done["embed"] = run_embed(store, inputs, model, only=wanted, full_refresh=full_refresh)
    return done
