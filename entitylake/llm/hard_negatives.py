"""Hard-negative mining with bounds from a spanning tree over the anchors.

Scores are inner products.  For anchors p and a and a candidate c, <c, a> differs from <c, p> by
at most |a - p| |c|.  The anchors of a block are joined by a minimum spanning tree of their distances;
going down the tree, the interval of a candidate's score at the parent, widened by edge length times
candidate norm, bounds its score at the child.  A candidate is scored exactly at an anchor only when
its interval overlaps what is still wanted there: for positives, scores not below the worst of the best
rows so far; for negatives, a positive's window above its worst row so far.  An exact score replaces the interval.

Scale: anchors are a stated share of the rows, so they are taken in blocks of about BLOCK anchors; one
block and its tree go to the tasks, which stream all candidates once for the positives and once
for the negatives.  No candidate is shuffled: a task hands on its best rows of an anchor (and
positive), and a window keeps the best of those.  A label or a vector that holds a third of all rows
is spread over the tasks like any other.  A task holds SLICE candidates and one interval for
each anchor on the way from the root.

Defined results: rows with a null id, null label, null or empty vector, or null or non-finite
components take no part, and neither do rows whose quantised length exceeds 2^31 (products then always
fit a long); of rows repeating an id the one with the least label, then least vector, counts;
vectors of different length have no score with each other; equal scores go by smaller id; an anchor
without a positive, or a positive without negatives, gives no rows; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entitylake.llm.bytetext import batch_column
from entitylake.llm.common import Spool

BLOCK = 2048  # anchors of a block, about: they are dealt by a hash of their id
SLICE = 2048  # candidates scored together
EXACT = 2.0**53  # integer products up to this size are exact in double precision
LENGTH_MAX = 2.0**31


@dataclass(frozen=True)
class Mining:
    """A negative n counts for a positive p when ``low * p <= 100 * n <= high * p``."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def quantised(vectors: DataFrame, label: Column | None = None, scale: int = 256) -> DataFrame:
    """``(vec_id, label, q)`` of the rows that take part: components ``floor(scale * x)``."""
    ok = "vec_id is not null and label is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"),
    ).filter(ok)
    rows = rows.withColumn("q", F.expr(f"transform(vec, x -> floor(cast(greatest(-1e18, least(1e18, {scale} * x)) as double)))")).drop("vec")
    length = F.expr(f"aggregate(q, 0D, (n, x) -> n + cast(x as double) * x) <= {LENGTH_MAX * LENGTH_MAX}")
    return rows.filter(length).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order (parents first, each subtree in one piece), parent's place in that order (-1: root) and edge lengths."""
    n = len(x)
    parent, dist, done = np.full(n, -1), np.full(n, np.inf), np.zeros(n, bool)
    children: list[list[int]] = [[] for _ in range(n)]
    at = 0
    for _ in range(n):
        done[at] = True
        if parent[at] >= 0:
            children[parent[at]].append(at)
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        near = ~done & (d < dist)
        parent[near], dist[near] = at, d[near]
        at = int(np.where(done, np.inf, dist).argmin())
    order, todo = [], [0] if n else []
    while todo:
        order.append(todo.pop())
        todo += children[order[-1]]
    place = np.empty(n, int)
    place[order] = np.arange(n)
    order = np.array(order, int)
    up = np.where(parent[order] >= 0, place[parent[order]], -1)
    return order, up, np.where(up >= 0, dist[order], 0.0)


class Block:
    """Anchors of one vector length in tree order: ids, labels, integer components, parents and edge lengths."""

    def __init__(self, ids: list[int], labels: list[str], q: np.ndarray):
        order, self.up, self.edge = spanning_tree(q.astype(float))
        self.ids, self.labels, self.q = np.array(ids)[order], np.array(labels, object)[order], q[order]
        self.norm = np.sqrt((self.q.astype(float) ** 2).sum(axis=1))
        self.deep = np.zeros(len(order), int)  # depth in the tree
        for k, u in enumerate(self.up):
            self.deep[k] = self.deep[u] + 1 if u >= 0 else 0

    @staticmethod
    def shared(state: dict[int, dict]) -> dict[int, "Block"]:
        """Blocks from the plain arrays that travel to the tasks (vector length -> fields)."""
        out = {}
        for dim, fields in state.items():
            out[dim] = object.__new__(Block)
            out[dim].__dict__.update(fields)
        return out

    def walk(self, cand: np.ndarray, wanted, found) -> None:
        """Bounds for all candidates (rows) anchor by anchor; ``wanted(k, low, high)`` says which are to be scored
        exactly, ``found(k, rows, scores)`` gets their integer scores."""
        real = cand.astype(float)
        norm = np.sqrt((real**2).sum(axis=1))
        small = norm.max(initial=0) * self.norm.max(initial=0) < EXACT
        path: list[tuple[np.ndarray, np.ndarray]] = []  # intervals from the root to the current anchor
        for k in range(len(self.ids)):
            del path[self.deep[k] :]
            if self.up[k] < 0:
                low, high = -norm * self.norm[k], norm * self.norm[k]
            else:
                reach = norm * self.edge[k] * (1 + 1e-9) + 1.0  # beyond all rounding, also of the scores as floats
                low, high = path[-1][0] - reach, path[-1][1] + reach
            slack = 1.0 + 1e-9 * np.maximum(np.abs(low), np.abs(high))
            rows = np.arange(len(cand)) if self.up[k] < 0 else np.flatnonzero(wanted(k, low - slack, high + slack))
            if len(rows):
                exact = (real[rows] @ self.q[k].astype(float)).astype(np.int64) if small else cand[rows] @ self.q[k]
                low[rows] = high[rows] = exact
                found(k, rows, exact)
            path.append((low, high))


class Best:
    """The first ``n`` (score, id) pairs per key: higher scores, then smaller ids."""

    def __init__(self, n: int):
        self.n, self.kept = n, {}

    def least(self, key) -> float:
        kept = self.kept.get(key)
        return float(kept[0][-1]) if kept is not None and len(kept[0]) == self.n else -np.inf

    def add(self, key, scores: np.ndarray, ids: np.ndarray) -> None:
        if key in self.kept:
            old = self.kept[key]
            scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
        if len(scores):
            top = np.lexsort((ids, -scores))[: self.n]
            self.kept[key] = scores[top], ids[top]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, labels, q)`` of candidates of one vector length, at most SLICE at a time."""
    for batch in batches:
        ids = batch_column(batch, "vec_id").to_numpy(zero_copy_only=False)
        labels = np.array(batch_column(batch, "label").to_pylist(), object)
        column = batch_column(batch, "q")
        sizes = np.diff(column.offsets.to_numpy())
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            for a in range(0, len(at), SLICE):
                part = at[a : a + SLICE]
                yield ids[part], labels[part], column.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(part), dim)


def _rows(best: Best, names: list[str]) -> Iterator[pa.RecordBatch]:
    keys = [k for k, (s, _) in best.kept.items() for _ in s]
    columns = [pa.array([k[j] for k in keys], pa.int64()) for j in range(len(names) - 2)]
    for j in (0, 1):
        columns.append(pa.array(np.concatenate([np.zeros(0, np.int64), *[v[j] for v in best.kept.values()]]).astype(np.int64)))
    yield pa.RecordBatch.from_arrays(columns, names)


def _top(rows: DataFrame, n: int, *group: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("id"))
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def best_positives(candidates: DataFrame, blocks, n: int) -> DataFrame:
    """``(anchor, score, id, place)``: the first ``n`` other rows of each anchor's label; ``blocks``: a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, by_dim = Best(n), Block.shared(blocks.value)
        for ids, labels, q in _slices(batches):
            block = by_dim.get(q.shape[1])
            if block is None:
                continue

            def own(k):
                return (labels == block.labels[k]) & (ids != block.ids[k])

            def found(k, rows, scores):
                mine = own(k)[rows]
                best.add((int(block.ids[k]),), scores[mine], ids[rows][mine])

            block.walk(q, lambda k, low, high: own(k) & (high >= best.least((int(block.ids[k]),))), found)
        yield from _rows(best, ["anchor", "score", "id"])

    return _top(candidates.mapInArrow(run, "anchor long, score long, id long"), n, "anchor")


def best_negatives(candidates: DataFrame, blocks, windows, n: int, low100: int, high100: int) -> DataFrame:
    """``(anchor, positive, score, id, place)``; ``windows``: a broadcast of anchor -> [(positive, its score)]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, by_dim = Best(n), Block.shared(blocks.value)
        # below 0 no score fits
        all_wins = {dim: [[(p, s) for p, s in windows.value.get(int(a), ()) if s >= 0] for a in b.ids] for dim, b in by_dim.items()}
        for ids, labels, q in _slices(batches):
            block = by_dim.get(q.shape[1])
            if block is None:
                continue
            wins = all_wins[q.shape[1]]

            def wanted(k, low, high):
                out = np.zeros(len(ids), bool)
                for p, s in wins[k]:
                    out |= (low * 100 <= high100 * s) & (high * 100 >= max(low100 * s, 100 * best.least((int(block.ids[k]), p))))
                return out & (labels != block.labels[k])

            def found(k, rows, scores):
                other = labels[rows] != block.labels[k]
                scores, of = scores[other], ids[rows][other]
                for p, s in wins[k]:
                    # integers: the least and the largest score of the window
                    fit = (scores >= -(-low100 * s // 100)) & (scores <= high100 * s // 100)
                    best.add((int(block.ids[k]), p), scores[fit], of[fit])

            block.walk(q, wanted, found)
        yield from _rows(best, ["anchor", "positive", "score", "id"])

    return _top(candidates.mapInArrow(run, "anchor long, positive long, score long, id long"), n, "anchor", "positive")


def mine(vectors: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: (vec_id, label, q) as ``quantised`` gives them."""
    spark = vectors.sparkSession
    spool = Spool(spark, "negatives")
    rows = spool.put(vectors, "vectors")
    anchors = spool.put(rows.filter(is_anchor), "anchors")
    n_blocks = max(1, -(-anchors.count() // BLOCK))
    out = spool.folder("mined")
    for b in range(n_blocks):
        # a bounded block of the queries: some BLOCK rows, whatever the table's size
        block_rows = anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).orderBy("vec_id").toArrow()
        by_dim: dict[int, list[tuple]] = {}
        for row in zip(*(block_rows.column(c).to_pylist() for c in ("vec_id", "label", "q"))):
            by_dim.setdefault(len(row[2]), []).append(row)
        blocks = spark.sparkContext.broadcast({d: vars(Block([r[0] for r in rs], [r[1] for r in rs], np.array([r[2] for r in rs], np.int64))) for d, rs in by_dim.items()})
        positives = best_positives(rows, blocks, mining.positives).collect()  # at most ``positives`` rows an anchor
        of: dict[int, list[tuple[int, int]]] = {}
        for r in positives:
            of.setdefault(r["anchor"], []).append((r["id"], r["score"]))
        windows = spark.sparkContext.broadcast(of)
        scores = spark.createDataFrame([(r["anchor"], r["id"], r["score"]) for r in positives], "anchor long, positive long, positive_score long")
        found = best_negatives(rows, blocks, windows, mining.negatives, mining.low, mining.high)
        found.join(F.broadcast(scores), ["anchor", "positive"]).select(
            F.col("anchor").alias("anchor_id"),
            F.col("positive").alias("positive_id"),
            F.col("place").cast("int").alias("rank"),
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
        blocks.destroy()
        windows.destroy()
    return spark.read.parquet(out)
