"""Counts of byte contexts, gathered by Spark, and tables of a byte's logarithm in its deepest kept context.

A gram is a byte with the ``depth`` bytes before it (zeros before a text's first byte); counts of all
shorter contexts follow from the gram counts.  A context is kept when it holds at least ``least`` training
bytes, an absolute number, so the contexts kept grow with the corpus.

Contexts that share their two nearest bytes form a subtree; a model is solved subtree by subtree in tasks, each
of at most 256^(depth - 2) contexts per byte by the alphabet.  What meets on the driver are the contexts of
order 0 and 1, at most 257 a group.

The result is a written table with one row of 256 logarithms a context.  Up to BROADCAST_CONTEXTS contexts are
broadcast whole.  Beyond, only the ones that hold the most bytes are, at most as many; a gram whose context may go on in the
written table is looked up by a join: distinct grams once, then their values join the documents they occur
in.  Either way a gram gets the value of its deepest kept context.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.llm.bytetext import batch_column, slices
from entitylake.llm.common import Spool

BROADCAST_CONTEXTS = 50_000  # rows of 1 KB
GRAMS_HELD = 1 << 20  # distinct grams a task holds (16 bytes each, several times while they are merged)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] = FOLD[97:123]  # A-Z as a-z
TABLES = "grp string, k int, ctx long, n long, logs array<float>"


def previous(data: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The byte ``k`` places earlier in the same text, 0 before its start."""
    out = np.zeros_like(data)
    if k < len(data):
        out[k:] = data[:-k]
    starts, ends = off[:-1], off[1:]
    for j in range(k):
        at = starts + j
        out[at[at < ends]] = 0
    return out


def grams(data: np.ndarray, off: np.ndarray, depth: int) -> np.ndarray:
    """A number for each byte and the ``depth`` bytes before it; the byte lowest, then the nearest."""
    out = data.astype(np.uint64)
    for k in range(1, depth + 1):
        out |= previous(data, off, k).astype(np.uint64) << np.uint64(8 * k)
    return out


def _merge(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def gram_counts(docs: DataFrame, group: str | None, fold_case: bool, depth: int) -> DataFrame:
    """``(grp, gram, n)`` over all rows of ``docs`` (text and the group column, if any)."""
    columns = ["text"] + ([group] if group else [])
    shift = np.uint64(8 * (depth + 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held_k, held_n = {}, [], []

        def rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            text = np.array(list(names), object)
            for at in range(0, len(keys), 1 << 18):
                k = keys[at : at + (1 << 18)]
                gram = (k & np.uint64((1 << int(shift)) - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(text[(k >> shift).astype(np.int64)], pa.string()), pa.array(gram), pa.array(n[at : at + (1 << 18)])], ["grp", "gram", "n"])

        for batch in batches:
            labels = batch_column(batch, group).to_pylist() if group else [""] * len(batch)
            code = np.array([names.setdefault(x, len(names)) for x in labels], np.uint64)
            for a, b, data, off in slices(batch_column(batch, "text")):
                if not len(data):
                    continue
                data = FOLD[data] if fold_case else data
                k, n = np.unique(grams(data, off, depth) | np.repeat(code[a:b], np.diff(off)) << shift, return_counts=True)
                held_k.append(k)
                held_n.append(n.astype(np.int64))
                if len(held_k) >= 16:
                    k, n = _merge(np.concatenate(held_k), np.concatenate(held_n))
                    held_k, held_n = [k], [n]
                    if len(k) > GRAMS_HELD:  # sums so far; Spark adds the rest
                        yield from rows(k, n)
                        held_k, held_n = [], []
        if held_k:
            yield from rows(*_merge(np.concatenate(held_k), np.concatenate(held_n)))

    return docs.select(*columns).mapInArrow(count, "grp string, gram long, n long").groupBy("grp", "gram").agg(F.sum("n").alias("n"))


def kept_counts(spool: Spool, counts: DataFrame, depth: int, least: int) -> DataFrame:
    """``(grp, k, ctx, sym, n)`` of all contexts of orders 0 to ``depth`` with at least ``least`` bytes, written.
    ``ctx`` has the nearest byte lowest."""
    counts = spool.put(counts, "grams")  # read several times, counted once
    out = None
    for k in range(depth + 1):
        part = (
            counts.withColumn("ctx", F.expr(f"shiftright(gram, 8) & {(1 << (8 * k)) - 1}L"))
            .withColumn("sym", F.expr("cast(gram & 255L as int)"))
            .groupBy("grp", "ctx", "sym").agg(F.sum("n").alias("n"))
            .withColumn("k", F.lit(k))
        )
        out = part if out is None else out.unionByName(part)
    out = spool.put(out, "orders")
    if least > 1:
        held = out.groupBy("grp", "k", "ctx").agg(F.sum("n").alias("total")).filter(F.col("total") >= least)
        out = spool.put(out.join(held.select("grp", "k", "ctx"), ["grp", "k", "ctx"]), "kept")
    return out.select("grp", "k", "ctx", "sym", "n")


def levels_of(part: pd.DataFrame, first: int, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order from ``first`` to ``depth``: contexts in order and their byte counts (contexts x 256)."""
    out = []
    for k in range(first, depth + 1):
        own = part[part["k"] == k]
        ctx = np.unique(own["ctx"].to_numpy(np.int64))
        n = np.zeros((len(ctx), 256))
        np.add.at(n, (np.searchsorted(ctx, own["ctx"].to_numpy(np.int64)), own["sym"].to_numpy(np.int64)), own["n"].to_numpy())
        out.append((ctx, n))
    return out


def parents(levels: list[tuple[np.ndarray, np.ndarray]], first: int, at: int) -> np.ndarray:
    """Place, one level up, of the parent of each context of level ``at``."""
    return np.searchsorted(levels[at - 1][0], levels[at][0] & ((1 << (8 * (first + at - 1))) - 1))


def table_rows(grp: str, k: int, ctx: np.ndarray, n: np.ndarray, logs: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"grp": grp, "k": np.int32(k), "ctx": ctx.astype(np.int64), "n": n.sum(axis=1).astype(np.int64), "logs": list(logs.astype(np.float32))})


def subtrees(kept: DataFrame, solve: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``solve`` for the contexts of order 2 and more that share their two nearest bytes."""
    return kept.filter("k >= 2").groupBy("grp", F.expr("ctx & 65535L").alias("near")).applyInPandas(lambda part: solve(part), schema)


def top_contexts(kept: DataFrame) -> pd.DataFrame:
    """The contexts of order 0 and 1: at most 257 x 256 rows a group."""
    return kept.filter("k < 2").toArrow().to_pandas()


@dataclass
class Lookup:
    """What is broadcast of a model, per group: ``keys`` (context and order, sorted), ``logs`` (rows x 256) and ``more``
    (whether contexts of the row go on in ``rest``, the table of all other contexts; None: there are none)."""

    depth: int
    names: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    more: list[np.ndarray]
    rest: DataFrame | None = None

    def shared(self) -> tuple:
        return self.depth, self.keys, self.logs, self.more


def _key(k: Column, ctx: Column) -> Column:
    return ctx + F.shiftleft(k.cast("long"), 56)


def least_broadcast(contexts: DataFrame, weight: Column, limit: int) -> int:
    """0 if the weights of all contexts (with their bytes ``n``) sum to ``limit`` at most, else the least power of two such
    that those of the contexts with at least so many bytes do."""
    by_size = contexts.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).agg(F.sum(weight).alias("w")).collect()  # 64 rows at most
    total = 0
    for r in sorted(by_size, key=lambda r: -r["b"]):
        total += r["w"]
        if total > limit:
            return 1 << (r["b"] + 1)
    return 0


def lookup(model: DataFrame, depth: int) -> Lookup:
    """``model``: a written table (TABLES)."""
    rows, rest = model.select("grp", "k", "ctx", "n", "logs"), None
    bound = least_broadcast(rows.filter("k >= 2"), F.lit(1), BROADCAST_CONTEXTS)
    if bound:
        often = (F.col("k") < 2) | (F.col("n") >= bound)
        rest = rows.filter(~often)
        rows = rows.filter(often).join(goes_on(rest), ["grp", "k", "ctx"], "left")
    else:
        rows = rows.withColumn("more", F.lit(False))
    held = rows.select("grp", _key(F.col("k"), F.col("ctx")).alias("key"), F.coalesce("more", F.lit(False)).alias("more"), "logs").toArrow()
    grp, key, more = (held.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "key", "more"))
    logs = np.empty((len(key), 256), np.float32)
    at = 0
    for chunk in held.column("logs").chunks:
        logs[at : at + len(chunk)] = chunk.flatten().to_numpy(zero_copy_only=False).reshape(-1, 256)
        at += len(chunk)
    del held
    out = Lookup(depth, sorted(set(grp)), [], [], [], rest)
    for name in out.names:
        at = np.flatnonzero(grp == name)
        at = at[np.argsort(key[at])]
        out.keys.append(key[at].astype(np.int64))
        out.logs.append(logs[at])
        out.more.append(more[at].astype(bool))
    return out


def goes_on(rest: DataFrame) -> DataFrame:
    """``(grp, k, ctx, more)``: the parents of the contexts in ``rest``."""
    up = F.expr("ctx & (shiftleft(1L, 8 * (k - 1)) - 1)")
    return rest.select("grp", (F.col("k") - 1).alias("k"), up.alias("ctx")).distinct().withColumn("more", F.lit(True))


class Scored:
    """Sums of a slice of texts: ``sums`` (groups x texts), and ``open``: per text the grams that the broadcast rows may not
    settle, with the value they have if nothing else is found."""

    def __init__(self, shared: tuple, data: np.ndarray, off: np.ndarray):
        depth, all_keys, all_logs, all_more = shared
        gram, place = np.unique(grams(data, off, depth), return_inverse=True)
        sym, ctx = (gram & np.uint64(255)).astype(np.int64), (gram >> np.uint64(8)).astype(np.int64)
        self.sums = np.zeros((len(all_keys), len(off) - 1))
        text, group, grams_, times, value = [], [], [], [], []
        doc = None
        for g, (keys, logs, more) in enumerate(zip(all_keys, all_logs, all_more)):
            row = np.zeros(len(gram), np.int64)
            for k in range(depth + 1):
                key = (ctx & ((1 << (8 * k)) - 1)) + (k << 56)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                row = np.where(keys[at] == key, at, row)
            own = logs[row, sym].astype(np.float64)
            open_ = more[row]
            if open_.any():
                doc = np.repeat(np.arange(len(off) - 1), np.diff(off)) if doc is None else doc
                at = np.flatnonzero(open_[place])
                pair, n = np.unique(np.stack([doc[at], place[at]]), axis=1, return_counts=True)
                text.append(pair[0])
                group.append(np.full(len(n), g))
                grams_.append(gram[pair[1]].astype(np.int64))
                times.append(n)
                value.append(own[pair[1]])
                own = np.where(open_, 0.0, own)
            self.sums[g] = sum_by_text(own[place], off)
        self.open = open_lists(len(off) - 1, text, group, grams_, times, value)


def open_lists(n_texts: int, text: list, group: list, gram: list, times: list, value: list) -> pa.Array:
    """Per text a list of (g, gram, times, value), from pieces of the five columns."""
    none = [np.zeros(0, np.int64)]
    text, group, gram, times = (np.concatenate(x or none) for x in (text, group, gram, times))
    order = np.argsort(text, kind="stable")
    off = np.searchsorted(text[order], np.arange(n_texts + 1)).astype(np.int32)
    names, kinds = ("g", "gram", "times", "value"), (pa.int32(), pa.int64(), pa.int64(), pa.float64())
    fields = [pa.array(x[order], kind) for x, kind in zip((group, gram, times, np.concatenate(value or [np.zeros(0)])), kinds)]
    return pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays(fields, names))


OPEN = "array<struct<g: int, gram: long, times: long, value: double>>"


def settled(spool: Spool, found: Lookup, scored: DataFrame) -> DataFrame:
    """``(uid, g, more)``: what a text's open grams add to its sum for group g.  ``scored``: (uid, open), written."""
    depth = found.depth
    rows = scored.select("uid", F.explode("open").alias("x")).select("uid", "x.*")
    names = F.array(*[F.lit(x) for x in found.names])
    wanted = rows.select("g", "gram").distinct().withColumn("grp", F.element_at(names, F.col("g") + 1)).withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(depth))))
    wanted = wanted.withColumn("ctx", F.expr("shiftright(gram, 8) & (shiftleft(1L, 8 * k) - 1)"))
    best = wanted.join(found.rest.select("grp", "k", "ctx", "logs"), ["grp", "k", "ctx"]).groupBy("g", "gram").agg(
        F.max(F.struct("k", F.expr("cast(logs[cast(gram & 255L as int)] as double)").alias("log"))).alias("best")
    )
    value = F.coalesce("best.log", "value")
    return rows.join(best, ["g", "gram"], "left").groupBy("uid", "g").agg(F.sum(F.col("times") * value).alias("more"))


def sum_by_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.zeros(len(values) + 1)
    np.cumsum(values, out=c[1:])
    return c[off[1:]] - c[off[:-1]]
