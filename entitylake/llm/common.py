"""Shared helpers: written intermediates, row keys and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.session import scratch_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame, *without: str) -> Column:
    """All columns as one struct, so that working columns beside it clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in without])


class Spool:
    """Intermediate tables in the shared scratch folder.

    A table that was written and read back cuts the lineage, survives the loss of
    executors and has a known size, from which Spark itself picks broadcast or
    sort-merge joins.  Each table goes to a folder of its own, removed with the
    application (or as soon as ``drop`` says that nothing reads it any more).
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = scratch_dir(spark, f"llm-{purpose}")
        self._n = 0
        path, fs = self._fs(self.root)
        fs.deleteOnExit(path)

    def _fs(self, where: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        where = f"{self.root}/{self._n:02d}-{name}"
        df.write.parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._spooled_at = where
        return out

    def folder(self, name: str) -> str:
        """A folder for a table that is written piece by piece."""
        self._n += 1
        return f"{self.root}/{self._n:02d}-{name}"

    def drop(self, df: DataFrame) -> None:
        path, fs = self._fs(df._spooled_at)
        fs.delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def connected_components(spool: Spool, edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of the edges; component = smallest node reached.

    Minimum labels travel along the edges and each round also jumps from a label to
    that label's own label, so long chains take a logarithmic number of rounds.
    Labels are reduced before the shuffle (partial ``min``), so a node with very many
    edges costs one row per task.  Each round is written to the shared scratch folder.
    """
    both = (
        edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
        .union(edges.select(F.col(b).alias("node"), F.col(a).alias("other")))
        .filter("node <> other")
        .distinct()
    )
    both = spool.put(both, "edges")
    labels = spool.put(
        both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels"
    )
    while True:
        seen = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        grown = labels.join(seen, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        roots = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        nxt = spool.put(
            grown.join(roots, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component"), "old"
            ),
            "labels",
        )
        moved = nxt.filter("component <> old").limit(1).count()
        spool.drop(labels)
        labels = nxt.select("node", "component")
        labels._spooled_at = nxt._spooled_at
        if not moved:
            return labels
