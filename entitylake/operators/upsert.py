"""Upsert into the latest table (J1): a bucketed base, one bucketed run of changes, and small pending deltas.

MERGE semantics: a batch row replaces the stored row with the same id
unconditionally (even a newer one), unmatched rows are inserted, nothing is
deleted, and NULL ids never match (they are always inserted).

Base and run are tables bucketed by ``id`` with the same bucket count, so they
meet bucket by bucket: the run's ids of a bucket are a task's hash table, the
base streams past it, and neither is shuffled or sorted (``merge_run``).  A batch
writes its newest rows as a plain delta; readers apply the pending deltas with a
broadcast anti join (``apply_deltas``), which the store keeps under a byte bound.

A compaction folds the deltas into the run (``fold_deltas``), or, once run and
deltas pass a share of the base, both into a new base.  Delta rows are shuffled
once to their buckets; base and run never are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ids(rows: DataFrame) -> DataFrame:
    return rows.select("id").where(F.col("id").isNotNull())


def merge_run(base: DataFrame, run: DataFrame) -> DataFrame:
    """Base rows not replaced by the run, and the run's (one per id); both bucketed alike: no exchange, no sort."""
    return base.join(_ids(run).hint("shuffle_hash"), "id", "left_anti").unionByName(run)


def newest_delta_rows(deltas: DataFrame) -> DataFrame:
    """Across pending deltas (each already one row per id) the last batch wins; NULL ids all stay."""
    w = Window.partitionBy("id").orderBy(F.col("_seq").desc())
    ranked = deltas.withColumn("_rn", F.row_number().over(w))
    return ranked.where((F.col("_rn") == 1) | F.col("id").isNull()).drop("_rn", "_seq")


def fold_deltas(base: DataFrame | None, deltas: DataFrame, buckets: int, broadcast_ids: bool) -> DataFrame:
    """``base`` with the pending deltas merged in, dealt to ``buckets`` by id.

    The delta rows are shuffled to their buckets, where the newest of an id is
    chosen.  With ``broadcast_ids`` (delta ids within the store's byte bound) the
    base is filtered map-side; otherwise by a sort-merge join bucket by bucket,
    for which a bucketed base is not shuffled either.
    """
    dealt = deltas.repartition(buckets, "id")
    newest = newest_delta_rows(dealt)
    if base is None:
        return newest
    ids = F.broadcast(_ids(deltas)) if broadcast_ids else _ids(dealt).hint("merge")
    return base.join(ids, "id", "left_anti").unionByName(newest)


def apply_deltas(base: DataFrame, deltas: DataFrame, broadcast_ids: bool) -> DataFrame:
    """Merge-on-read J1: base rows not replaced by a delta, plus the newest delta rows.

    The delta id set is small by construction (compaction keeps its estimated
    size under the store's byte bound), so the anti join is a broadcast hash
    join: the base is scanned, never shuffled.  Without a known size the join
    is left to the planner (sort-merge, or AQE's runtime broadcast).
    """
    ids = _ids(deltas)
    if broadcast_ids:
        ids = F.broadcast(ids)
    return base.join(ids, "id", "left_anti").unionByName(newest_delta_rows(deltas))
