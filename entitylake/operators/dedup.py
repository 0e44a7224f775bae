"""Newest version per id (W1 on a staged batch, W2 on a log table).

``row_number() = 1`` over ``partition by id`` lets Spark insert a partial
WindowGroupLimit before the shuffle, so a hot id (or the single NULL-id group)
contributes at most one row per input partition to the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_per_id(df: DataFrame, recorded: str, arrival: tuple[str, ...] | list[str], load: str | None = None) -> DataFrame:
    """Keep one row per id: largest ``recorded`` (NULL counts as largest), then latest arrival.

    All NULL ids form one group, as in a SQL window.  With ``load``, a column
    with the load number of each row's request, the newest request of an id wins
    first, and NULL ids keep one row per request: the outcome of loading the
    requests one after the other.
    """
    order = [F.col(recorded).desc_nulls_first(), *[F.col(c).desc() for c in arrival]]
    group = [F.col("id")]
    if load:
        order = [F.col(load).desc(), *order]
        group.append(F.when(F.col("id").isNull(), F.col(load)))
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def newest_from_log(log: DataFrame, live_only: bool = False) -> DataFrame:
    """W2 (+F3): newest row per id of an ordered log (``TableStore.read_log(ordered=True)``).

    One tie rule for log and latest: load time, then the entity's own
    ``recorded`` (NULL counts as largest), then arrival.  Both are stored with
    the log rows, so compaction does not change the outcome.
    """
    out = newest_per_id(log, "_erec", ("_arrival",), load="recorded").drop("_erec", "_arrival")
    if live_only:
        out = out.where(~F.col("deleted"))
    return out


def live(df: DataFrame) -> DataFrame:
    """rows not marked deleted."""
    return df.where(~F.col("deleted"))
