"""Line dedup on content-defined chunks of lines.

A text is cut at ``\\n``.  Each line has a 60-bit hash; a rolling hash runs over pairs of
neighbouring line hashes.  A chunk begins where the rolling hash is a strict local minimum, so
boundaries depend on four neighbouring lines only: text put in front of a passage or behind
it does not move the boundaries inside, and no two boundaries are adjacent.  A line of at
least ``long_words`` words is a chunk of its own, as a passage of that size repeats on its own.

A second, finer level finds passages that hold no whole chunk: every line begins a run that ends with the
line in which ``long_words`` words are reached.  Both ends depend on the run's own lines alone, so
a passage of that many words has its runs wherever it stands, however short its lines are.

A chunk of several lines (or one long line) or a run that occurs more than once in the whole table is kept
at its first occurrence (smallest doc_id, then position); elsewhere its lines are removed.  Every removed
line thus has an equal one at an earlier place, so one copy of it stays.  Pieces are found by a digest and
compared by their bytes; a digest that stands for two different texts removes nothing.

Scale: pieces travel as digests with their places, counted with partial aggregation, so a passage that a third of
the documents hold costs one row per task.  Only places of repeated digests return to the documents (one
shuffle of the texts, sort-merge with skew splitting; written), and only the texts of repeated pieces are compared, each
once per task.  Row keys are digests of id and text, so a recomputed task gives the same keys.

Defined results: null text stays null and has no chunks; the empty text is one empty line; rows repeating
an id and text are one document and treated alike; a null id sorts first; an empty table gives
no rows; further columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.llm.bytetext import batch_column
from entitylake.llm.common import Spool, whole_row

LONG_WORDS = 50
ROLL, MODULUS = 1_000_003, 2_147_483_647


def chunk_lines(text: str, long_words: int) -> list[tuple[int, int, bool]]:
    """``(first line, end line, may be removed)`` of each chunk."""
    lines = text.encode().split(b"\n")
    h = [int(hashlib.md5(x).hexdigest()[:15], 16) % MODULUS for x in lines]
    big = [len(x) >= 2 * long_words - 1 and len(x.split()) >= long_words for x in lines]
    n = len(lines)
    roll = [(h[i] * ROLL + h[i + 1]) % MODULUS for i in range(n - 1)]
    # roll[i] looks at lines i and i+1; a boundary before line i+1 is a local minimum at i
    begins = [0]
    for i in range(1, n):
        low = 0 < i - 1 < n - 2 and roll[i - 2] > roll[i - 1] < roll[i]
        if big[i] or big[i - 1] or low:
            begins.append(i)
    ends = begins[1:] + [n]
    return [(a, b, b - a > 1 or big[a]) for a, b in zip(begins, ends)]


def pieces(text: str, long_words: int) -> list[tuple[int, int]]:
    """``(first line, end line)`` of what may be removed: chunks of several lines or one long line, and the runs."""
    out = {(a, b) for a, b, movable in chunk_lines(text, long_words) if movable}
    words = [len(x.split()) for x in text.encode().split(b"\n")]
    total, end = 0, 0
    for begin, n in enumerate(words):
        while end < len(words) and total < long_words:
            total += words[end]
            end += 1
        if total < long_words:
            break
        out.add((begin, end))
        total -= n
    return sorted(out)


def digest_of(piece: str) -> bytes:
    return hashlib.md5(piece.encode()).digest()


PLACES = "doc_id long, dkey binary, first int, end int, digest binary"


def _places(docs: DataFrame, long_words: int) -> DataFrame:
    """Every piece of every text: its place and digest."""
    names, kinds = ["doc_id", "dkey", "first", "end", "digest"], (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch_column(batch, c) for c in ("doc_id", "text"))
            out: list[tuple] = []
            for i in range(len(texts)):
                text = texts[i].as_py()
                if text is None:
                    continue
                doc_id = ids[i].as_py()
                dkey, lines = row_key(doc_id, text), text.split("\n")
                out += [(doc_id, dkey, a, b, digest_of("\n".join(lines[a:b]))) for a, b in pieces(text, long_words)]
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PLACES)


def row_key(doc_id: int | None, text: str) -> bytes:
    return hashlib.md5(f"{'' if doc_id is None else doc_id}:{text}".encode()).digest()


def _key_column():
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text"))))


def repeated_places(spool: Spool, docs: DataFrame, long_words: int) -> DataFrame:
    """``(dkey, first, end, digest, kept)`` of all pieces whose digest occurs more than once, written."""
    at = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "dkey", "first")
    places = spool.put(_places(docs, long_words), "places")
    seen = places.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("keeper"))
    repeated = spool.put(seen.filter("n > 1").select("digest", "keeper"), "repeated")
    kept = (F.col("dkey") == F.col("keeper.dkey")) & (F.col("first") == F.col("keeper.first"))
    return spool.put(places.join(repeated, "digest").select("dkey", "first", "end", "digest", kept.alias("kept")).distinct(), "repeats")


def _with_pieces(rows: DataFrame, repeats: DataFrame) -> DataFrame:
    """``rows`` (with dkey and text) and ``found``: their repeated pieces in order, null without any."""
    found = repeats.groupBy("dkey").agg(F.array_sort(F.collect_list(F.struct("first", "end", "digest", "kept"))).alias("found"))
    # both sides grow with the data: the same plan at every size
    return rows.join(found.withColumnRenamed("dkey", "found_key").hint("merge"), F.col("dkey") == F.col("found_key"), "left").drop("found_key")


def clashing(joined: DataFrame) -> DataFrame:
    """Digests of repeated pieces that stand for more than one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for text, found in zip(batch_column(batch, "text").to_pylist(), batch_column(batch, "found").to_pylist()):
                lines = text.split("\n")
                for x in found:
                    out.append((x["digest"], "\n".join(lines[x["first"] : x["end"]])))
                    size += len(out[-1][1])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.string()))], ["digest", "piece"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.string()))], ["digest", "piece"])

    texts = joined.filter("found is not null").select("text", "found").mapInArrow(run, "digest binary, piece string").distinct()
    return texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest")


def dedup_lines(docs: DataFrame, long_words: int = LONG_WORDS) -> DataFrame:
    """All rows and columns; ``text`` without repeated chunks.  Adds the struct ``dedup``:
    ``n_lines`` (before) and ``lines_gone``; a column of that name is replaced."""
    spool = Spool(docs.sparkSession, "lines")
    repeats = repeated_places(spool, docs.select("doc_id", "text"), long_words)
    rows = docs.select(whole_row(docs, "text").alias("row"), "text", _key_column().alias("dkey"))
    joined = spool.put(_with_pieces(rows, repeats), "documents")
    clash = spool.put(clashing(joined), "clashes")
    if clash.count():  # equal digests of different texts: without them once more
        joined = _with_pieces(rows, repeats.join(clash, "digest", "left_anti"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new, n_lines, gone = [], [], []
            for text, found in zip(batch_column(batch, "text").to_pylist(), batch_column(batch, "found").to_pylist()):
                lines, drop = [] if text is None else text.split("\n"), set()
                for x in found or ():
                    if not x["kept"]:
                        drop.update(range(x["first"], x["end"]))
                new.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text)
                n_lines.append(len(lines))
                gone.append(len(drop))
            counts = pa.StructArray.from_arrays([pa.array(n_lines, pa.int64()), pa.array(gone, pa.int64())], ["n_lines", "lines_gone"])
            fields = [batch.schema.field("row"), pa.field("text", pa.string()), pa.field("dedup", counts.type)]
            yield pa.RecordBatch.from_arrays([batch_column(batch, "row"), pa.array(new, pa.string()), counts], schema=pa.schema(fields))

    schema = joined.select("row", "text").schema.add("dedup", T._parse_datatype_string("n_lines long, lines_gone long"))
    out = joined.select("row", "text", "found").mapInArrow(rebuild, schema)
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c != "dedup"], "dedup")
