"""Language identification by prediction by partial matching.

Each language has a variable-order tree of byte contexts (orders 0 to DEPTH, A-Z folded) with
the counts of all its training texts.  A byte that a context has seen c times of n, with q
distinct bytes, has probability c / (n + q); otherwise the context escapes with q / (n + q) to
the next shorter one, at last to the uniform distribution.  The statistics are frozen, so a
text's code length under a language is a sum of table entries.  The shortest code wins;
the score is its posterior under equal priors.

A text is in no learned language (``foreign``) when even its shortest code is longer than the text
itself at 8 bits a byte and, once, 8 bits for each distinct byte it has.  Hex dumps, encoded blobs and
other scripts take far more a byte than that; the second term covers what little a short text says.

Scale: one pass counts grams per task with numpy and Spark sums them; contexts of at least LEAST bytes of a
language are kept, so their number grows with the corpus.  The model is a table with one number for each byte
seen in a kept context and one for its escape.  Up to BROADCAST_ENTRIES of them are broadcast whole; beyond, those
of the contexts that hold the most bytes, at most as many.  Grams whose context may go on in the written table are then
looked up by a join: distinct grams once, then their values join the documents they occur in.

Defined results: null, empty and letterless texts are ``und`` with score 0; without training
texts everything is ``und``; equal code lengths go to the first language in alphabetical
order; repeated rows are judged alike; further columns are ignored by ``predict`` and kept by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.llm.byte_contexts import FOLD, OPEN, goes_on, gram_counts, grams, kept_counts, least_broadcast, open_lists, sum_by_text
from entitylake.llm.bytetext import batch_column, slices
from entitylake.llm.common import Spool, whole_row

DEPTH = 4
LEAST = 16
BROADCAST_ENTRIES = 4_000_000  # of 12 bytes
ESCAPE = 256  # stands for the escape among a context's bytes
BASE = -8.0  # log2 of the uniform distribution
LETTER = np.zeros(256, bool)
LETTER[97:123] = True


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


@dataclass
class Model:
    """``names`` of languages; broadcast are ``keys`` (language, order, byte or escape and context in one number, sorted), their
    ``logs`` and, of escapes, ``more``: whether longer contexts are in ``rest``, the table of the others (None: there are none)."""

    depth: int
    names: list[str]
    keys: np.ndarray
    logs: np.ndarray
    more: np.ndarray
    rest: DataFrame | None = None

    def shared(self) -> tuple:
        return self.depth, len(self.names), self.keys, self.logs, self.more


def entries(kept: DataFrame) -> DataFrame:
    """``(grp, k, ctx, n, logs)``: a kept context's log2 probabilities, by byte and ESCAPE."""
    whole = kept.groupBy("grp", "k", "ctx").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("q"), F.map_from_entries(F.collect_list(F.struct("sym", "n"))).alias("c"))
    logs = F.transform_values("c", lambda _, c: F.log2(c) - F.log2(F.col("n") + F.col("q")))
    escape = F.create_map(F.lit(ESCAPE), F.log2("q") - F.log2(F.col("n") + F.col("q")))
    return whole.select("grp", "k", "ctx", "n", F.map_concat(logs, escape).alias("logs"))


def train(docs: DataFrame, depth: int = DEPTH, least: int = LEAST) -> Model:
    """From the texts and languages of ``docs``; rows without either are left out.  ``depth`` is 5 at most."""
    spool = Spool(docs.sparkSession, "contexts")
    known = docs.filter("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    rows = spool.put(entries(kept_counts(spool, gram_counts(known, "lang", True, depth), depth, least)), "model")
    names = sorted(r[0] for r in rows.filter("k = 0").select("grp").collect())
    bound, rest = least_broadcast(rows.filter("k > 0"), F.size("logs"), BROADCAST_ENTRIES), None
    held = rows.withColumn("more", F.lit(False))
    if bound:
        often = (F.col("k") == 0) | (F.col("n") >= bound)
        rest = rows.filter(~often)
        held = rows.filter(often).join(goes_on(rest), ["grp", "k", "ctx"], "left")
    g = (F.array_position(F.array(*[F.lit(x) for x in names]).cast("array<string>"), F.col("grp")) - 1).cast("long")
    one = held.select(g.alias("g"), "k", "ctx", F.coalesce("more", F.lit(False)).alias("more"), F.explode("logs").alias("sym", "log"))
    key = F.shiftleft(F.shiftleft(F.col("g") * 8 + F.col("k"), 9) + F.col("sym"), 40) + F.col("ctx")
    found = one.select(key.alias("key"), F.col("log").cast("float").alias("log"), "more").toArrow()
    keys, logs, more = (found.column(c).to_numpy(zero_copy_only=False) for c in ("key", "log", "more"))
    order = np.argsort(keys)
    return Model(depth, names, keys[order], logs[order], more[order].astype(bool), rest)


class Coded:
    """``bits`` of a slice of texts (languages x texts), and ``open``: per text the grams that the broadcast entries may not
    settle, with the order and value they have reached (``value`` holds order * 1000 - log2)."""

    def __init__(self, shared: tuple, data: np.ndarray, off: np.ndarray):
        depth, n_names, keys, logs, more = shared
        gram, place = np.unique(grams(data, off, depth), return_inverse=True)
        sym, ctx = (gram & np.uint64(255)).astype(np.int64), (gram >> np.uint64(8)).astype(np.int64)
        self.bits = np.zeros((n_names, len(off) - 1))
        text, group, found, times, value = [], [], [], [], []
        doc = None

        def find(g: int, k: int, s, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key = ((((g * 8 + k) << 9) + s) << 40) + (ctx[at] & ((1 << (8 * k)) - 1))
            where = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return where, keys[where] == key

        for g in range(n_names):
            log, reached, open_ = np.full(len(gram), BASE), np.zeros(len(gram), np.int64), np.zeros(len(gram), bool)
            alive = np.arange(len(gram))
            for k in range(depth + 1):
                where, kept = find(g, k, ESCAPE, alive)
                alive, where = alive[kept], where[kept]
                own, seen = find(g, k, sym[alive], alive)
                log[alive] = np.where(seen, logs[own], log[alive] + logs[where])
                reached[alive], open_[alive] = k, more[where]
            if open_.any():
                doc = np.repeat(np.arange(len(off) - 1), np.diff(off)) if doc is None else doc
                at = np.flatnonzero(open_[place])
                pair, n = np.unique(np.stack([doc[at], place[at]]), axis=1, return_counts=True)
                text.append(pair[0])
                group.append(np.full(len(n), g))
                found.append(gram[pair[1]].astype(np.int64))
                times.append(n)
                value.append((reached * 1000.0 - log)[pair[1]])
                log = np.where(open_, 0.0, log)
            self.bits[g] = -sum_by_text(log[place], off)
        self.open = open_lists(len(off) - 1, text, group, found, times, value)


def settled(model: Model, scored: DataFrame) -> DataFrame:
    """``(uid, g, more)``: the bits of a text's open grams under language g.  ``scored``: (uid, open), written.

    From the order it has reached on, a gram goes down the contexts of ``rest`` as long as they are kept."""
    rows = scored.select("uid", F.explode("open").alias("x")).select("uid", "x.*")
    names = F.array(*[F.lit(x) for x in model.names])
    reached = F.floor((F.col("value") + 500) / 1000).cast("int")  # a gram's bits so far are far below 500
    once = rows.select("g", "gram", "value").distinct().withColumn("grp", F.element_at(names, F.col("g") + 1)).withColumn("from", reached)
    asked = once.filter(F.col("from") < model.depth).withColumn("k", F.explode(F.sequence(F.col("from") + 1, F.lit(model.depth))))
    asked = asked.withColumn("ctx", F.expr("shiftright(gram, 8) & (shiftleft(1L, 8 * k) - 1)"))
    step = F.struct("k", F.col("logs")[ESCAPE].alias("escape"), F.col("logs")[F.expr("cast(gram & 255L as int)")].alias("seen"))
    # at most ``depth`` steps a gram; a kept context's parents are kept, so no order is missing between
    steps = asked.join(model.rest.select("grp", "k", "ctx", "logs"), ["grp", "k", "ctx"]).groupBy("g", "gram").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    so_far = F.col("value") - reached * 1000
    walked = F.aggregate("steps", so_far, lambda bits, x: F.when(x["seen"].isNotNull(), -x["seen"]).otherwise(bits - x["escape"]))
    bits = F.when(F.col("steps").isNull(), so_far).otherwise(walked)
    return rows.join(steps, ["g", "gram"], "left").groupBy("uid", "g").agg(F.sum(F.col("times") * bits).alias("more"))


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs`` (from text alone) with ``lang_pred``, ``score`` and ``foreign``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.shared())
    some_open = model.rest is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in slices(batch_column(batch, "text")):
                data = FOLD[data]
                lettered = sum_by_text(LETTER[data], off) > 0
                for i in np.flatnonzero(~lettered & (np.diff(off) > 0)):
                    lettered[i] = any(c.isalpha() for c in data[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace"))
                coded = Coded(shared.value, data, off)
                bits, size = coded.bits, np.diff(off)
                # distinct bytes matter where the code is longer than the text; with open grams that is not known yet
                alien = np.ones(b - a, bool) if some_open or not len(bits) else bits.min(axis=0) > 8 * size
                distinct = np.zeros(b - a, np.int64)
                for i in np.flatnonzero(alien):
                    distinct[i] = len(np.unique(data[off[i] : off[i + 1]]))
                each = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * len(bits)), pa.array(bits.T.ravel()))
                kept = [batch_column(batch, c).slice(a, b - a) for c in keep]
                own = [each, pa.array(lettered), pa.array(8 * (size + distinct)), coded.open]
                yield pa.RecordBatch.from_arrays([*kept, *own], schema=pa.schema([*[batch.schema.field(c) for c in keep], *[pa.field(n, x.type) for n, x in zip(added, own)]]))

    added = ["__bits", "__lettered", "__limit", "__open"]
    new = T._parse_datatype_string(f"__bits array<double>, __lettered boolean, __limit long, __open {OPEN}")
    rows = docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, T.StructType([*[docs.schema[c] for c in keep], *new.fields]))
    if some_open:
        spool = Spool(docs.sparkSession, "open-grams")
        rows = spool.put(rows.withColumn("__uid", F.monotonically_increasing_id()), "scored")
        more = settled(model, rows.select(F.col("__uid").alias("uid"), F.col("__open").alias("open")))
        more = more.groupBy(F.col("uid").alias("__uid")).agg(F.map_from_entries(F.collect_list(F.struct("g", "more"))).alias("__more"))
        added_bits = F.transform("__bits", lambda x, g: x + F.coalesce(F.element_at("__more", g), F.lit(0.0)))
        rows = rows.join(more, "__uid", "left").withColumn("__bits", F.when(F.col("__more").isNull(), F.col("__bits")).otherwise(added_bits))
    least = F.array_min("__bits")
    judged = F.col("__lettered") & (F.size("__bits") > 0)
    names = F.array(*[F.lit(x) for x in model.names]).cast("array<string>")
    score = 1 / F.aggregate("__bits", F.lit(0.0), lambda s, x: s + F.pow(F.lit(2.0), F.greatest(least - x, F.lit(-1000.0))))
    return rows.select(
        *keep,
        F.when(judged, F.element_at(names, F.array_position("__bits", least).cast("int"))).otherwise("und").alias("lang_pred"),
        F.when(judged, score).otherwise(0.0).alias("score"),
        F.coalesce(least > F.col("__limit"), F.lit(False)).alias("foreign"),
    )


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from rows whose crc32(doc_id) modulo 4 is not 2."""
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = train(docs.filter(~held_out))
    return predict(docs, model, "doc_id").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, least_score: float = 0.0) -> DataFrame:
    """Documents that have a language (not ``und``, not ``foreign``) with at least ``least_score``, all columns.
    By default the score rejects nothing: short texts have honest scores well below 1."""
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = train(docs.filter(~held_out))
    rows = docs.select(whole_row(docs, "text").alias("row"), "text")  # a text goes to Python and back once
    kept = predict(rows, model, "row", "text").filter((F.col("lang_pred") != "und") & ~F.col("foreign") & (F.col("score") >= least_score))
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
