"""Benchmark decontamination: a hash set of the benchmark's word windows scans the training texts.

Words are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
A window is ``size`` consecutive words of an item; an item of fewer words (but not none) is
one window.  Every start position of a document is looked up by the 64-bit hash of its next
words, each hit is verified word by word, and a document word inside any verified window
counts as hit.

Scale: one pass over the texts, no shuffle of texts.  The windows are distinct and joined by
hash; they are written and counted first and broadcast up to BROADCAST_WINDOWS (a benchmark
of ordinary size); beyond that the positions, each with its window, are shuffled.  Per document
one header row and one row per hit position are grouped; a position hits at most one distinct
window of a length, however many items share it.  Where only the documents are asked for that hold a window
(``clean_documents``), nothing is gathered per document: hashes alone are broadcast, up to BROADCAST_HASHES, and
the positions they let through meet the windows' words in a join that Spark plans by the written sizes.

Defined results: null or empty texts and texts without words have no words and no hits; an
empty benchmark hits nothing; null item ids and null item texts are left out; equal items all
count; repeated document rows are judged each by itself (two rows with the same id and text
give two equal rows); further columns of either table are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.llm.common import Spool, ascii_lower

#: Up to so many distinct windows the hash set is broadcast with their words (some 700 bytes each); beyond, positions are shuffled.
BROADCAST_WINDOWS = 400_000
#: Up to so many hashes alone are broadcast.
BROADCAST_HASHES = 1_000_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """Array of normalised words; null or wordless texts give an empty array."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _window_hash(words: str, at: str, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.expr(f"get({words}, {at} + {k})") for k in range(length)])


def benchmark_windows(spool: Spool, benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct windows ``(h, win_len, win)``, their items ``(win, item_id)``, and the lengths in use
    (at most ``size`` numbers)."""
    items = (
        benchmark.select(F.col("item_id").alias("item_id"), normal_words(F.col("text")).alias("iw"))
        .filter("item_id is not null and size(iw) > 0")
        .select("item_id", "iw", F.least(F.size("iw"), F.lit(size)).alias("win_len"))
    )
    starts = items.select("item_id", "iw", "win_len", F.explode(F.expr("sequence(0, size(iw) - win_len)")).alias("at"))
    members = spool.put(
        starts.select(F.expr("slice(iw, at + 1, win_len)").alias("win"), "win_len", "item_id").distinct(), "windows"
    )
    lengths = sorted(r[0] for r in members.select("win_len").distinct().collect())
    by_len = reduce(
        lambda acc, n: acc.when(F.col("win_len") == n, _window_hash("win", "0", n)), lengths, F.when(F.lit(False), F.lit(0).cast("long"))
    )
    distinct = spool.put(members.select("win", "win_len").distinct().withColumn("h", by_len), "hashes")
    return distinct, members.select("win", "item_id"), lengths


def find_hits(spool: Spool, docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """One row per document row: ``doc_id, n_words, hits`` (sorted start/end word ranges, end exclusive) and
    ``wins``, the distinct windows found."""
    distinct, members, lengths = benchmark_windows(spool, benchmark, size)
    small = distinct.count() <= BROADCAST_WINDOWS
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").alias("doc_id"), normal_words(F.col("text")).alias("dw"))
    rows = texts.select("uid", "doc_id", "dw", F.posexplode_outer("dw").alias("pos", "first_word"))
    rows = rows.select("uid", "doc_id", "dw", F.coalesce("pos", F.lit(0)).alias("pos"), F.size("dw").alias("size"))
    for n in lengths:
        rows = rows.withColumn(f"k{n}", F.when(F.col("pos") + n <= F.col("size"), _window_hash("dw", "pos", n)))
        if not small:
            rows = rows.withColumn(f"s{n}", F.slice("dw", F.col("pos") + 1, n))
    if not small:  # what is shuffled is a position with its window, not the text
        rows = rows.drop("dw")
    for n in lengths:
        probe = distinct.filter(F.col("win_len") == n).select(F.col("h").alias(f"h{n}"), F.col("win").alias(f"w{n}"))
        same = F.expr(" and ".join(f"get(dw, pos + {k}) = w{n}[{k}]" for k in range(n)) if small else f"s{n} = w{n}")
        rows = rows.join(F.broadcast(probe) if small else probe, (F.col(f"k{n}") == F.col(f"h{n}")) & same, "left")
    found = reduce(lambda x, y: x | y, [F.col(f"w{n}").isNotNull() for n in lengths], F.lit(False))
    hit_list = [F.struct(F.col("pos").alias("s"), (F.col("pos") + n).alias("e"), F.col(f"w{n}").alias("w")) for n in lengths]
    none = F.expr("array(named_struct('s', 0, 'e', 0, 'w', cast(null as array<string>)))")
    hits = F.filter(F.array(*hit_list) if hit_list else none, lambda x: x["w"].isNotNull())
    return (
        rows.filter(found | (F.col("pos") == 0))
        .select("uid", "doc_id", F.when(F.col("pos") == 0, F.col("size")).cast("long").alias("nw"), hits.alias("hits"))
        .groupBy("uid", "doc_id")
        .agg(F.max("nw").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"))
        .select(
            "uid",
            "doc_id",
            "n_words",
            F.array_sort(F.transform("hits", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))).alias("hits"),
            F.array_distinct(F.transform("hits", lambda x: x["w"])).alias("wins"),
        )
    ), members


def rows_with_windows(spool: Spool, docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The distinct ``doc_id`` of the rows that hold a window."""
    windows, _, lengths = benchmark_windows(spool, benchmark, size)
    hashes, few = windows.select("h").distinct(), windows.count() <= BROADCAST_HASHES
    texts = docs.select("doc_id", normal_words(F.col("text")).alias("dw"))
    starts = texts.select("doc_id", "dw", F.posexplode("dw").alias("pos", "first_word"))
    if not lengths:
        return docs.select("doc_id").limit(0)
    each = [F.when(F.col("pos") + n <= F.size("dw"), F.struct(F.lit(n).alias("n"), _window_hash("dw", "pos", n).alias("h"))) for n in lengths]
    starts = starts.select("doc_id", "dw", "pos", (F.explode(F.array(*each)) if each[1:] else each[0]).alias("at")).filter("at is not null")
    starts = starts.select("doc_id", "dw", "pos", "at.n", "at.h")
    win = F.slice("dw", F.col("pos") + 1, F.col("n")).alias("win")
    if few:
        found = starts.join(F.broadcast(hashes), "h", "left_semi").select("doc_id", "h", win)
    else:  # what is shuffled is a position with its window, not the text
        found = starts.select("doc_id", "h", win).join(hashes, "h", "left_semi")
    return found.distinct().join(windows.select("h", "win"), ["h", "win"], "left_semi").select("doc_id").distinct()


def covered(hits: str) -> Column:
    """Number of word positions inside the union of sorted ``(s, e)`` ranges."""
    return F.expr(
        f"aggregate({hits}, named_struct('to', 0, 'n', 0L), "
        "(a, x) -> named_struct('to', greatest(a.to, x.e), 'n', a.n + greatest(0, x.e - greatest(a.to, x.s))), a -> a.n)"
    )


def judge(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``items_sha256``: of the distinct ids of items with an occurring window, sorted as
    strings and comma-joined (of the empty string when there is none)."""
    spool = Spool(docs.sparkSession, "decontam")
    per_doc, members = find_hits(spool, docs, benchmark, size)
    per_doc = spool.put(per_doc, "hits")
    items = (
        per_doc.select("uid", F.explode("wins").alias("win"))
        .join(members, "win")
        .select("uid", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    return per_doc.join(items, "uid", "left").select(
        "doc_id",
        "n_words",
        covered("hits").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.col("hits").alias("spans"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Documents without a benchmark window, all columns kept; rows with a null id are kept when their
    text is clean as well (they are matched by content, not by id)."""
    spool = Spool(docs.sparkSession, "decontam")
    key = F.xxhash64("doc_id", "text")
    # rows are told apart by id and content, so no text is shuffled unless something was found
    keyed = docs.select(F.struct(key.alias("h"), F.col("doc_id").alias("id")).alias("doc_id"), F.col("text").alias("text"))
    found = rows_with_windows(spool, keyed, benchmark, size)
    bad = spool.put(found.select(F.col("doc_id.h").alias("__bad"), F.col("doc_id.id").alias("__bad_id")), "bad")
    return docs.join(bad, (key == F.col("__bad")) & docs["doc_id"].eqNullSafe(F.col("__bad_id")), "left_anti")
