"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one representative per group.

Vectors of equal label and equal components are one class.  Spherical k-means (Lloyd's steps run
as Spark jobs over all classes, seeded by id hash) gives at most MAX_CELLS centroids, and of
centroids within the link angle of each other one stays, so a group of near copies is one cell
however large it is.  Each class has its nearest cell as home and visits every lower-numbered
cell that can be the home of a class linked to it; a pair is compared in the lower-numbered of
its two homes.  Within a cell and label, classes are dealt into blocks of about BLOCK_ROWS
rows and every pair of blocks with home classes is one task's matrix product, so no cell or
label grows into one task.  A block reports link counts per class and edges to the smallest
linked id only (a spanning forest), never all pairs of a group.  Components are then found over
those edges.

No pair is missed.  Linked x and y are at most the link chord apart, and y is no nearer to the
home h of x than to its own home c, so x lies at most that chord beyond the plane between h and c.
The angle from x to c differs from that of y by the link angle at most, so it is within
the link angle of the range of angles of the classes at home in c.  A class visits all cells that pass
both tests.  The cosine is computed in double precision from the whole vectors.

Defined results: vectors that are null, empty, all zero or hold null or non-finite components,
and rows without a label, link with nothing and are kept; vectors of different length do not
link; rows repeating an id are separate copies counted in n_links; a null id has a null
component and links with nothing; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.llm.bytetext import batch_column, list_array
from entitylake.llm.common import Spool, connected_components

MAX_CELLS = 1024
CELL_ROWS = 500
STEPS = 4
BLOCK_ROWS = 400
CHUNK_ROWS = 2048
SLACK = 1e-6  # of angles and distances, far above the rounding of double precision


def even(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each (exact) that brings their largest component to [0.5, 1): no square is lost or infinite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list<double> column of one common length, scaled to length 1."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = even(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vector_classes(vectors: DataFrame) -> DataFrame:
    """``(label, dim, vec, rep, copies)`` of linkable vectors; ``rep``: smallest id of the equal ones."""
    ok = "label is not null and vec_id is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(vec, x -> x <> 0)"
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
        .filter(ok)
        .groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dim", F.size("vec"))
    )


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x @ centroids.T).argmax(axis=1)


def spherical_kmeans(classes: DataFrame, dim: int, n_rows: int) -> np.ndarray:
    """At most MAX_CELLS unit centroids of the classes of this dimension (a bounded matrix)."""
    own = classes.filter(F.col("dim") == dim)
    k = int(min(MAX_CELLS, max(1, -(-n_rows // CELL_ROWS))))
    seeds = own.orderBy(F.xxhash64("rep"), "rep").select("vec").limit(k).toArrow()
    centroids = matrix(seeds.column("vec"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(centroids)
        for batch in batches:
            if len(batch):
                x = matrix(batch_column(batch, "vec"))
                np.add.at(total, _nearest(x, centroids), x)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), list_array(pa.array(total[used].ravel()), np.full(len(used), dim))], ["cell", "total"])

    for _ in range(STEPS):
        parts = own.select("vec").mapInArrow(sums, "cell long, total array<double>")
        rows = parts.select("cell", F.posexplode("total")).groupBy("cell", "pos").agg(F.sum("col").alias("x")).toArrow()
        total = np.zeros_like(centroids)
        total[rows.column("cell").to_numpy(), rows.column("pos").to_numpy()] = rows.column("x").to_numpy()
        length = np.linalg.norm(total, axis=1, keepdims=True)
        centroids = np.where(length > 0, total / np.maximum(length, 1e-300), centroids)
    return centroids


def _apart(centroids: np.ndarray, threshold: float) -> np.ndarray:
    """The centroids without those within the link angle of an earlier one that stays."""
    stay: list[int] = []
    for i, near in enumerate(centroids @ centroids.T):
        if not stay or near[stay].max() < threshold:
            stay.append(i)
    return centroids[stay]


def _angles(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ centroids.T, -1, 1))


def _chunks(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    x = matrix(batch_column(batch, "vec")) if len(batch) else np.zeros((0, 1))
    for at in range(0, len(x), CHUNK_ROWS):
        yield x[at : at + CHUNK_ROWS]


def _rings(own: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest angle from each centroid to a class at home there (a tie is at home in all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(len(centroids), np.inf), np.full(len(centroids), -np.inf)
        for batch in batches:
            for x in _chunks(batch):
                angle = _angles(x, centroids)
                home = angle <= angle.min(axis=1, keepdims=True) + SLACK
                low = np.minimum(low, np.where(home, angle, np.inf).min(axis=0))
                high = np.maximum(high, np.where(home, angle, -np.inf).max(axis=0))
        used = np.flatnonzero(high >= low)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(low[used]), pa.array(high[used])], ["cell", "low", "high"])

    rows = own.select("vec").mapInArrow(run, "cell long, low double, high double").groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    low, high = np.full(len(centroids), np.inf), np.full(len(centroids), -np.inf)
    low[rows.column("cell").to_numpy()] = rows.column("low").to_numpy()
    high[rows.column("cell").to_numpy()] = rows.column("high").to_numpy()
    return low, high


def visits(x: np.ndarray, centroids: np.ndarray, rings: tuple[np.ndarray, np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home of each row and the lower-numbered cells that can be home of a row linked to it (rows x cells)."""
    link, chord = np.arccos(min(1.0, threshold)), np.sqrt(max(0.0, 2 - 2 * threshold))
    near = x @ centroids.T
    home = near.argmax(axis=1)
    between = np.sqrt(np.maximum(0, 2 - 2 * (centroids @ centroids.T)))
    beyond = np.take_along_axis(near, home[:, None], 1) - near <= chord * between[home] + SLACK
    angle = np.arccos(np.clip(near, -1, 1))
    in_ring = (angle >= rings[0] - link - SLACK) & (angle <= rings[1] + link + SLACK)
    return home, beyond & in_ring & (np.arange(len(centroids)) < home[:, None])


def _assign(own: DataFrame, centroids: np.ndarray, rings: tuple[np.ndarray, np.ndarray], threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            homes, lists, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for x in _chunks(batch):
                home, guest = visits(x, centroids, rings, threshold)
                guest[np.arange(len(x)), home] = True
                homes.append(home)
                lists.append(np.nonzero(guest)[1])
                sizes.append(guest.sum(axis=1))
            cells = list_array(pa.array(np.concatenate(lists).astype(np.int32)), np.concatenate(sizes))
            home = pa.array(np.concatenate(homes).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, home, cells], [*batch.schema.names, "home", "cells"])

    return own.mapInArrow(run, "label string, dim int, rep long, copies long, vec array<double>, home int, cells array<int>")


def _compare(threshold: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        out_columns = ["rep", "links", "other"]
        cell, lo, hi = int(part["cell"].iloc[0]), int(part["lo"].iloc[0]), int(part["hi"].iloc[0])
        a = part[part["block"] == lo]
        b = part[part["block"] == hi]
        if not len(a) or not len(b):
            return pd.DataFrame([], columns=out_columns)
        xa, xb = (even(np.stack(p["vec"].to_numpy())) for p in (a, b))
        near = (xa @ xb.T) / np.linalg.norm(xa, axis=1)[:, None] / np.linalg.norm(xb, axis=1)[None, :] >= threshold
        if lo == hi:
            near = np.triu(near, 1)
        # two guests meet in the lower-numbered of their own homes
        near &= (a["home"].to_numpy() == cell)[:, None] | (b["home"].to_numpy() == cell)[None, :]
        i, j = np.nonzero(near)
        ra, rb = a["rep"].to_numpy(), b["rep"].to_numpy()
        na, nb = a["copies"].to_numpy(), b["copies"].to_numpy()
        ids = np.concatenate([ra, rb])
        links = np.concatenate([np.bincount(i, nb[j], len(ra)), np.bincount(j, na[i], len(rb))]).astype(np.int64)
        # each class with a link to a later one of its tree: smallest label spreads until nothing moves
        root = ids.copy()
        ja = j + len(ra)
        while True:
            before = root.copy()
            np.minimum.at(root, i, before[ja])
            np.minimum.at(root, ja, before[i])
            if (root == before).all():
                break
        found = links > 0
        return pd.DataFrame({"rep": ids[found], "links": links[found], "other": root[found]}, columns=out_columns)

    return run


def _links(spool: Spool, classes: DataFrame, dim: int, n_rows: int, threshold: float) -> DataFrame:
    own = classes.filter(F.col("dim") == dim)
    centroids = _apart(spherical_kmeans(classes, dim, n_rows), threshold)
    rings = _rings(own, centroids)
    placed = spool.put(_assign(own.select("label", "dim", "rep", "copies", "vec"), centroids, rings, threshold), f"cells-{dim}")
    at_home = F.col("cell") == F.col("home")
    sizes = placed.select("label", "home", F.explode("cells").alias("cell")).groupBy("label", "cell").agg(
        F.count(F.when(at_home, 1)).alias("hosts"), F.count(F.when(~at_home, 1)).alias("guests")
    )
    few = F.col("hosts") + F.col("guests") <= BLOCK_ROWS
    sizes = sizes.filter("hosts > 0 and hosts + guests > 1").select(
        "label", "cell",
        F.ceil(F.col("hosts") / BLOCK_ROWS).cast("int").alias("host_blocks"),
        F.when(few, 0).otherwise(F.ceil(F.col("guests") / BLOCK_ROWS)).cast("int").alias("guest_blocks"),
    )
    sizes = spool.put(sizes, f"sizes-{dim}")
    dealt = placed.withColumn("cell", F.explode("cells")).drop("cells").join(sizes, ["label", "cell"])
    spread = lambda blocks: F.pmod(F.xxhash64("rep"), F.greatest(blocks, F.lit(1))).cast("int")
    guest_block = F.when(F.col("guest_blocks") > 0, F.col("host_blocks") + spread(F.col("guest_blocks"))).otherwise(0)
    dealt = dealt.withColumn("block", F.when(at_home, spread(F.col("host_blocks"))).otherwise(guest_block))
    # a row meets each block once, as the lower or the higher one of the pair; blocks of guests meet those of hosts only
    others = F.when(F.col("block") < F.col("host_blocks"), F.col("host_blocks") + F.col("guest_blocks")).otherwise(F.col("host_blocks"))
    paired = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), others - 1))).select(
        "label", "cell", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "rep", "copies", "vec", "home"
    )
    return paired.groupBy("label", "cell", "lo", "hi").applyInPandas(_compare(threshold), "rep long, links long, other long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    spool = Spool(vectors.sparkSession, "embed")
    classes = spool.put(vector_classes(vectors), "classes")
    found = None
    for dim, n_rows in classes.groupBy("dim").count().orderBy("dim").collect():  # one row per vector length
        part = spool.put(_links(spool, classes, dim, n_rows, threshold), f"links-{dim}")
        found = part if found is None else found.union(part)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
    if found is None:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    edges = found.filter("rep <> other").select("rep", "other")
    label = connected_components(spool, edges, "rep", "other").withColumnRenamed("node", "rep")
    counts = found.groupBy("rep").agg(F.sum("links").alias("others"))
    groups = spool.put(
        classes.join(counts, "rep", "left").join(label, "rep", "left").select(
            "label", "vec", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")
        ),
        "groups",
    )
    joined = base.join(groups, ["label", "vec"], "left").select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"),
    )
    return joined.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
