"""Snapshot diff and merge by key and content hash.

Classification looks at keys and hashes only; full rows move through a join
that is driven by the changed keys. When few rows changed, the changed keys
are small enough to be broadcast and the old snapshot is rewritten without
any shuffle of its wide rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERTED, UPDATED, UNCHANGED, DELETED = "inserted", "updated", "unchanged", "deleted"


def diff(old: DataFrame, new: DataFrame, key: Sequence[str], hash_col: str = "content_hash") -> DataFrame:
    """Class of every key of either side: ``key…, change``."""
    before = old.select(*key, F.col(hash_col).alias("_old"))
    after = new.select(*key, F.col(hash_col).alias("_new"), F.lit(True).alias("_there"))
    change = (
        F.when(F.col("_there").isNull(), DELETED)
        .when(F.col("_old").isNull(), INSERTED)
        .when(F.col("_old").eqNullSafe(F.col("_new")), UNCHANGED)
        .otherwise(UPDATED)
    )
    return before.join(after, list(key), "full_outer").select(*key, change.alias("change"))


def stale_keys(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Old keys that no longer come in."""
    return old.select(*key).join(new.select(*key), list(key), "left_anti")


def diff_stats(classes: DataFrame, *, delete_stale: bool = True) -> DataFrame:
    """One row of counts by class, and the number of incoming rows."""
    def n(*names: str):
        return F.count_if(F.col("change").isin(*names))

    deleted = n(DELETED) if delete_stale else F.lit(0).cast("bigint")
    return classes.agg(
        n(INSERTED).alias(INSERTED),
        n(UPDATED).alias(UPDATED),
        n(UNCHANGED).alias(UNCHANGED),
        deleted.alias(DELETED),
        n(INSERTED, UPDATED, UNCHANGED).alias("total_cards"),
    )


def merge(
    old: DataFrame, new: DataFrame, key: Sequence[str], changes: DataFrame,
    *, delete_stale: bool = True,
) -> DataFrame:
    """The next snapshot.

    New and changed rows are taken from ``new``. Unchanged rows keep all their
    old columns, also those outside the hash. Vanished rows go, or stay if
    ``delete_stale`` is off.
    """
    leaving = leaving_keys(key, changes, delete_stale=delete_stale)
    kept = old.join(leaving, list(key), "left_anti")
    return kept.unionByName(fresh_rows(new, key, changes))


def leaving_keys(key: Sequence[str], changes: DataFrame, *, delete_stale: bool = True) -> DataFrame:
    """Keys whose old rows are not valid any more."""
    dropped = [UPDATED, DELETED] if delete_stale else [UPDATED]
    return changes.filter(F.col("change").isin(*dropped)).select(*key)


def fresh_rows(new: DataFrame, key: Sequence[str], changes: DataFrame) -> DataFrame:
    """The incoming rows that are new or different."""
    coming = changes.filter(F.col("change").isin(INSERTED, UPDATED)).select(*key)
    return new.join(coming, list(key), "left_semi")
