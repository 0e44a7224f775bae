"""N-gram Jaccard join by set-relation skipping.

Documents are sets of word shingles; two link when their Jaccard similarity reaches
``num / den``.  The join is exact and works on set relations instead of single sets:

* Equal sets are one class (128-bit digest); only its smallest id takes part.
* Index level: a prefix of each set, in one global order (rare before frequent shingles), gives
  inverted list entries ``(shingle, id, size, position)``; before lists are compared, entries get
  a 256-bit parity sketch of their set.  Inside a list, entries are skipped without looking at the sets when sizes cannot reach the
  similarity, when the positions of the shared shingle already use up the allowed
  difference, or when the sketches differ in more bits than the sets may differ in elements.
  Pairs that are left meet a wider sketch (as many bits as the set has shingles) before any
  set is moved.
* Answer level: first every set is verified against one leader, the set that most often heads the
  lists it is in.  Sets that reach their leader share its answers: only the component as a
  whole matters from then on, so pairs within a component are never generated.  Then the
  lists are joined once more between sets of different components; what these pairs add is
  the difference between a set's answers and its leader's.  A group of n near copies costs
  about n pairs instead of n * n / 2.

Every pair that could link across components is generated, so no link is lost; copies and
members of a component are reported by membership only.

Scale: three passes over the texts (frequent shingles, prefixes, sets of candidates), numpy on
Arrow buffers.  What is broadcast is the list of frequent shingles, at most HEAVY_MAX numbers:
it only orders shingles, so its bound costs no links.  Lists, pairs and labels are joined by
sort-merge with skew splitting; nothing collects a list, a group or a component.

Defined results: null, empty and wordless texts have 0 shingles, link with nothing and are
their own component; a text of fewer words than a shingle has its whole word sequence as
one shingle; a null id takes part in no link and has a null component; rows repeating an id and text
give equal rows; an empty table gives no rows; further columns are ignored by ``groups`` and
kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.llm.bytetext import WHITE_SPACE, WordHasher, batch_column, list_array, mix, shingles, slices
from entitylake.llm.common import Spool, connected_components, whole_row

#: A shingle in this share of the documents (of about 4 million shingles at least HEAVY_LEAST) counts as frequent.
HEAVY_SHARE = 0.001
HEAVY_LEAST = 8
#: So many of the most frequent shingles go to the end of the order.
HEAVY_MAX = 200_000
HEAVY_CHUNK = 4_000_000


@dataclass(frozen=True)
class Similarity:
    words: int = 5
    num: int = 8
    den: int = 10

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Length of the prefix in which sets that link share a shingle."""
        return n - (n * self.num + self.den - 1) // self.den + 1

    def most_apart(self, sizes: str) -> str:
        """SQL for the most elements by which two linked sets differ, given the sum of their sizes."""
        return f"({sizes}) * {self.den - self.num} div {self.den + self.num}"


def _sets(hasher: WordHasher, data: np.ndarray, off: np.ndarray, words: int, heavy: np.ndarray):
    """Distinct shingles of each document in the global order: ``(key, document)``.  A key is the
    63-bit shingle hash with the top bit set for frequent shingles."""
    h, _, _, first = hasher.words(data, off)
    key, doc = shingles(h, first, words)
    key >>= np.uint64(1)
    if len(heavy) and len(key):
        at = np.minimum(np.searchsorted(heavy, key), len(heavy) - 1)
        key |= (heavy[at] == key).astype(np.uint64) << np.uint64(63)
    ends = np.searchsorted(doc, np.arange(len(off)))
    for a, b in zip(ends[:-1], ends[1:]):
        key[a:b].sort()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    return key[new], doc[new]


def frequent_shingles(docs: DataFrame, sim: Similarity) -> np.ndarray:
    """Sorted hashes of frequent shingles.  Each task reports the shingles that are frequent among about
    HEAVY_CHUNK of its own; a shingle frequent in the whole table is so in some task."""
    words, least, share, chunk = sim.words, HEAVY_LEAST, HEAVY_SHARE, HEAVY_CHUNK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, n_docs, n_all = WordHasher(WHITE_SPACE), [], 0, 0

        def report():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(least, 2 * share * n_docs)
            return pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["s", "n"])

        for batch in batches:
            for a, b, data, off in slices(batch_column(batch, "text")):
                held.append(_sets(hasher, data, off, words, np.zeros(0, np.uint64))[0])
                n_docs, n_all = n_docs + b - a, n_all + len(held[-1])
                if n_all >= chunk:
                    yield report()
                    held, n_docs, n_all = [], 0, 0
        if held:
            yield report()

    local = docs.select("text").mapInArrow(count, "s long, n long")
    n_docs = docs.count()
    often = local.groupBy("s").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(least, share * n_docs))
    rows = often.orderBy(F.desc("n"), "s").limit(HEAVY_MAX).select("s").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64)).view(np.uint64)


def _sketch(key: np.ndarray, doc: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity sketch per document: a power of two of bits, at least 256 and at least the set's size;
    folding a wide sketch onto half its length by xor gives the narrower sketch of the same set."""
    bits = np.full(len(n), 256)
    while (bits < n).any():
        bits = np.where(bits < n, bits * 2, bits)
    base = np.zeros(len(n) + 1, np.int64)
    np.cumsum(bits, out=base[1:])
    slot = (mix(key << np.uint64(1)) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64) + base[doc]
    odd = np.packbits((np.bincount(slot, minlength=base[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [odd[a // 8 : b // 8] for a, b in zip(base[:-1], base[1:])]


def _fold(sketch: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(sketch, np.uint64)
    while len(x) * 8 > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


FEATURES = "doc_id long, n long, d1 long, d2 long, wide binary, sk array<long>, prefix array<long>"


def features(docs: DataFrame, sim: Similarity, heavy) -> DataFrame:
    """Per row: set size, digest, sketches and prefix (none of the shingles beyond it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, often = WordHasher(WHITE_SPACE), heavy.value
        for batch in batches:
            ids = batch_column(batch, "doc_id")
            for a, b, data, off in slices(batch_column(batch, "text")):
                key, doc = _sets(hasher, data, off, sim.words, often)
                n = np.bincount(doc, minlength=b - a)
                digest = []
                for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
                    c = np.zeros(len(key) + 1, np.uint64)
                    np.cumsum(mix((key << np.uint64(1)) ^ np.uint64(salt)), out=c[1:])
                    at = np.concatenate([[0], np.cumsum(n)])
                    digest.append(pa.array((c[at[1:]] - c[at[:-1]]).view(np.int64)))
                wide = _sketch(key, doc, n)
                small = np.concatenate([_fold(w, 32) for w in wide]).view(np.int64)
                length = np.where(n > 0, sim.prefix(n), 0)
                rank = np.arange(len(key)) - (np.cumsum(n) - n)[doc]
                prefix = key[rank < length[doc]].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n), *digest, pa.array(wide, pa.binary()), list_array(pa.array(small), np.full(b - a, 4)), list_array(pa.array(prefix), length)],
                    ["doc_id", "n", "d1", "d2", "wide", "sk", "prefix"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, FEATURES)


def _candidate_sets(spool: Spool, docs: DataFrame, ids: DataFrame, sim: Similarity, name: str) -> DataFrame:
    """``(doc_id, elements)`` of the candidates: their distinct shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(WHITE_SPACE)
        for batch in batches:
            ids = batch_column(batch, "doc_id")
            for a, b, data, off in slices(batch_column(batch, "text")):
                key, doc = _sets(hasher, data, off, sim.words, np.zeros(0, np.uint64))
                at = np.searchsorted(doc, np.arange(b - a + 1)) * 8
                raw = key.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([raw[x:y] for x, y in zip(at[:-1], at[1:])], pa.binary())], ["doc_id", "elements"]
                )

    # both sides grow with the data: the same plan at every size
    chosen = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")
    return spool.put(chosen.mapInArrow(run, "doc_id long, elements binary").dropDuplicates(["doc_id"]), name)


def _sketch_filter(pairs: DataFrame, reps: DataFrame, sim: Similarity) -> DataFrame:
    """Pairs ``(a, b)`` whose wide sketches do not rule out the similarity."""
    up, down = sim.den - sim.num, sim.den + sim.num

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch_column(batch, c).to_numpy() for c in ("na", "nb"))
            wa, wb = (batch_column(batch, c).to_pylist() for c in ("wa", "wb"))
            apart = np.zeros(len(na), np.int64)
            for k, (x, y) in enumerate(zip(wa, wb)):
                size = min(len(x), len(y))
                apart[k] = np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum()
            keep = pa.array(apart * down <= (na + nb) * up)
            yield batch.select(["a", "b"]).filter(keep)

    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("wide").alias("wa"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("wb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _verified(spool: Spool, docs: DataFrame, pairs: DataFrame, sim: Similarity, name: str) -> DataFrame:
    """Pairs that link, by their whole sets."""
    num, den = sim.num, sim.den

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ea, eb = (batch_column(batch, c).to_pylist() for c in ("ea", "eb"))
            links = np.zeros(len(ea), bool)
            for k, (x, y) in enumerate(zip(ea, eb)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                links[k] = den * common >= num * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(links))

    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = _candidate_sets(spool, docs, ids, sim, f"{name}-sets")
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("ea")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("eb")), "b"
    )
    links = spool.put(both.mapInArrow(run, "a long, b long"), f"{name}-links")
    spool.drop(sets)
    return links


def _sizes_fit(sim: Similarity, x: str, y: str) -> str:
    return f"{x} * {sim.den} >= {y} * {sim.num} and {y} * {sim.den} >= {x} * {sim.num}"


def _entry_filter(sim: Similarity, x: str, y: str) -> str:
    """SQL: two entries of one list are not ruled out by size, position or sketch."""
    apart = sim.most_apart(f"{x}.n + {y}.n")
    sketch = " + ".join(f"bit_count({x}.sk[{k}] ^ {y}.sk[{k}])" for k in range(4))
    return f"{_sizes_fit(sim, f'{x}.n', f'{y}.n')} and {x}.pos + {y}.pos <= {apart} and {sketch} <= {apart}"


def classes(spool: Spool, docs: DataFrame, sim: Similarity) -> tuple[DataFrame, DataFrame]:
    """``(rows, reps)``: set size and digest of every row; one row per distinct non-empty set."""
    heavy = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, sim))
    whole = spool.put(features(docs, sim, heavy), "features")
    rows = spool.put(whole.select("doc_id", "n", "d1", "d2"), "rows")
    first = rows.filter("n > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    of_rep = whole.filter("n > 0").join(first, ["d1", "d2"]).filter("doc_id = rep").dropDuplicates(["d1", "d2"])
    reps = spool.put(of_rep.select("rep", "n", "d1", "d2", "wide", "sk", "prefix"), "reps")
    spool.drop(whole)
    return rows, reps


def links(spool: Spool, docs: DataFrame, reps: DataFrame, sim: Similarity) -> DataFrame:
    """Verified links ``(a, b)`` between class representatives that connect all components."""
    lists = reps.select("rep", "n", F.posexplode("prefix").alias("pos", "key"))
    shared = lists.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    index = spool.put(lists.join(shared, "key").select("key", "rep", "n", "pos"), "index")
    # the entry with the earliest position has the fewest shingles of its own before the shared one
    heads = index.groupBy("key").agg(F.min(F.struct("pos", "rep", "n")).alias("top")).select(
        "key", F.col("top.rep").alias("leader"), F.col("top.n").alias("ln"), F.col("top.pos").alias("lpos")
    )
    to_leader = (
        index.join(heads, "key")
        .filter(f"rep <> leader and {_sizes_fit(sim, 'n', 'ln')} and pos + lpos <= {sim.most_apart('n + ln')}")
        .groupBy("rep", "leader").agg(F.count(F.lit(1)).alias("c"))
        .groupBy("rep").agg(F.max(F.struct("c", "leader")).alias("best"))
        .select(F.least("rep", "best.leader").alias("a"), F.greatest("rep", "best.leader").alias("b")).distinct()
    )
    pairs = spool.put(_sketch_filter(to_leader, reps, sim), "leader-pairs")
    near = _verified(spool, docs, pairs, sim, "leader")
    label = connected_components(spool, near, "a", "b").withColumnRenamed("node", "rep")
    grouped = reps.select("rep", "sk").join(label, "rep", "left").select("rep", "sk", F.coalesce("component", "rep").alias("component"))
    entries = spool.put(index.join(grouped, "rep"), "entries")
    spool.drop(index)
    across = entries.alias("x").join(
        entries.alias("y"), F.expr(f"x.key = y.key and x.component < y.component and {_entry_filter(sim, 'x', 'y')}")
    )
    more = across.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
    more = spool.put(_sketch_filter(more, reps, sim), "across-pairs")
    return near.union(_verified(spool, docs, more, sim, "across"))


def groups(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, set_id (representative of the row's equal sets)."""
    spool = Spool(docs.sparkSession, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, reps = classes(spool, docs, sim)
    label = connected_components(spool, links(spool, docs, reps, sim), "a", "b").withColumnRenamed("node", "rep")
    of_set = spool.put(
        reps.select("rep", "d1", "d2").join(label, "rep", "left").select("d1", "d2", "rep", F.coalesce("component", "rep").alias("component")), "sets"
    )
    own = F.col("n") == 0
    return (
        rows.join(of_set, ["d1", "d2"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.when(own, F.col("doc_id")).otherwise(F.col("component"))).alias("component_id"),
            F.when(F.col("doc_id").isNotNull() & ~own, F.col("rep")).alias("set_id"),
        )
    )


def one_of_each(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """Documents that are the smallest id of their component, all columns; rows repeating an id keep one.
    Rows with a null id, and rows without words, are kept as they are."""
    spool = Spool(docs.sparkSession, "jaccard-keep")
    gone = spool.put(groups(docs, sim).filter("n_shingles > 0 and doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    kept = docs.select("doc_id", whole_row(docs).alias("row")).join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")
    return kept.select("row.*")
