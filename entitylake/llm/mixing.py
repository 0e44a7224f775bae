"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain -> language -> source (a leaf holds the documents of one source in one
language).  A token budget is handed down by integer weights.  A leaf can give at most
``max_epochs`` passes over its tokens, an inner node what its subtree can give.  Siblings
that cannot take their share leave the rest to their brothers in proportion to weight
(water filling), so a shortage is met among siblings first and reaches the ancestors' level
only when the whole subtree is short.  Shares are rounded down; less than one token per
child is left over.

A leaf's share is drawn epoch by epoch: whole epochs first, then from the last epoch the
documents in the order of ``md5(seed:epoch:doc_id)`` until the share is reached: a document is
taken when the tokens before it (of documents earlier in the order) are less than what is left.  Documents are never cut, so a leaf overshoots by
less than one document.

Scale: texts are read once for token counts (written as a narrow table).  Budgets are computed
on one row per leaf.  A leaf's order is never sorted as a whole: hash ranges of about
``BUCKET_ROWS`` documents are summed with partial aggregation, and only the one range in
which a leaf's share ends is ordered.  What then goes to the documents is one threshold per
leaf, which Spark broadcasts or sort-merges (with skew splitting) by its written size.

Defined results: null language or source count as ``unknown``; tokens are the words of the
text, null and empty texts have none and are never drawn; rows that repeat an id within a
leaf tie and are drawn together; a null id is ordered as the empty string; leaves, languages
or domains of weight 0 get nothing; an empty table gives no rows; further columns are kept
by ``draw`` and ignored by ``plan``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entitylake.llm.common import Spool, whole_row

BUCKET_ROWS = 1000
HASH_BITS = 60


@dataclass(frozen=True)
class Mix:
    """``budget_share``: tokens to draw as (numerator, denominator) of the tokens in leaves of positive weight.  A name that is not
    listed has weight ``default_weight``."""

    domains: dict = field(default_factory=lambda: {"web": 5, "books": 3, "code": 2, "other": 1})
    languages: dict = field(default_factory=lambda: {"en": 5, "de": 2, "fr": 2, "es": 1})
    sources: dict = field(default_factory=dict)
    default_weight: int = 1
    budget_share: tuple = (1, 2)
    max_epochs: int = 2
    seed: str = "mix-1"


#: Domains of the numbered sources ``srcN``: N modulo 3; other names are of domain ``other``.
DOMAINS = ("web", "books", "code")


def domain_of(source: Column) -> Column:
    n = F.regexp_extract(source, r"^src([0-9]{1,9})$", 1)
    k = F.when(n != "", n.cast("int") % len(DOMAINS))
    out = F.when(k == 0, DOMAINS[0])
    for i, name in enumerate(DOMAINS[1:], 1):
        out = out.when(k == i, name)
    return out.otherwise("other")


def count_words(text: Column) -> Column:
    """Number of maximal runs of characters other than space and \\t-\\r."""
    squeezed = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(squeezed, " "), "")).cast("long")


def leaf_columns() -> list[Column]:
    source = F.coalesce(F.col("source").cast("string"), F.lit("unknown"))
    return [
        domain_of(source).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("unknown")).alias("language"),
        source.alias("leaf_source"),
    ]


LEAF = ["domain", "language", "leaf_source"]


def order_hash(seed: str, epoch: Column, doc_id: Column) -> Column:
    text = F.concat(F.lit(seed + ":"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _weight(name: str, weights: dict, default: int) -> Column:
    out = F.lit(default)
    for key, w in weights.items():
        out = F.when(F.col(name) == key, w).otherwise(out)
    return out.cast("long")


def _fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Water filling of ``budget`` among the children of each parent: adds ``share``."""
    big = "decimal(38,0)"
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), name)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    cap, w, b = (F.col(c).cast("decimal(19,0)") for c in ("cap", "w", "budget"))
    ranked = (
        children.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("w_rest", F.sum("w").over(rest))
        .withColumn(
            "reaches",
            (F.col("cap_before").cast("decimal(19,0)") * w + cap * F.col("w_rest").cast("decimal(19,0)")).cast(big) >= (b * w).cast(big),
        )
    )
    # the first child (least capacity per weight) whose level carries the budget fixes the level
    first = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), name)
    level = F.first(F.when(F.col("reaches"), F.struct(F.col("cap_before").alias("c"), F.col("w_rest").alias("w"))), ignorenulls=True).over(
        first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    ranked = ranked.withColumn("level", level)
    part = F.expr("cast(cast(budget - level.c as decimal(19,0)) * cast(w as decimal(18,0)) as decimal(38,0)) div cast(level.w as decimal(38,0))")
    return ranked.withColumn("share", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), part))).drop(
        "cap_before", "w_rest", "reaches", "level", "budget"
    )


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves``: one row per leaf with ``tokens``; adds ``share``, the leaf's tokens to draw."""
    n, d = mix.budget_share
    leaf = (
        leaves.filter("tokens > 0")
        .withColumn("w_d", _weight("domain", mix.domains, mix.default_weight))
        .withColumn("w_l", _weight("language", mix.languages, mix.default_weight))
        .withColumn("w_s", _weight("leaf_source", mix.sources, mix.default_weight))
        .filter("w_d > 0 and w_l > 0 and w_s > 0")
        .withColumn("cap", F.col("tokens") * mix.max_epochs)
    )
    langs = leaf.groupBy("domain", "language").agg(
        F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"), F.first("w_l").alias("w"), F.first("w_d").alias("w_d")
    )
    doms = langs.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"), F.first("w_d").alias("w"))
    doms = doms.withColumn("root", F.lit(0)).withColumn("all_tokens", F.sum("tokens").over(Window.partitionBy("root")))
    top = doms.select("root", "domain", "cap", "w", F.expr(f"all_tokens * {int(n)}L div {int(d)}L").alias("budget"))
    d_share = _fill(top, ["root"], "domain").select("domain", F.col("share").alias("budget"))
    l_share = _fill(langs.drop("w_d", "tokens").join(d_share, "domain"), ["domain"], "language").select("domain", "language", F.col("share").alias("budget"))
    s_in = leaf.select(*LEAF, "tokens", "cap", F.col("w_s").alias("w")).join(l_share, ["domain", "language"])
    return _fill(s_in, ["domain", "language"], "leaf_source").select(*LEAF, "tokens", F.col("share").cast("long").alias("share"))


def thresholds(spool: Spool, tokens: DataFrame, mix: Mix) -> DataFrame:
    """Per drawn leaf: ``share``, ``full`` (whole epochs), ``max_hash`` and ``max_id`` (the last document
    of epoch ``full + 1`` in its order; null when the share ends with a whole epoch)."""
    leaves = spool.put(tokens.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")), "leaves")
    shares = budgets(leaves.drop("n_docs"), mix).filter("share > 0").withColumn("full", F.expr("share div tokens").cast("int"))
    # a power of two of hash ranges, about BUCKET_ROWS documents in each
    width = F.expr(f"cast(floor(log2(greatest(1.0D, n_docs / {BUCKET_ROWS}.0D))) as int)")
    plan = spool.put(
        shares.join(leaves.drop("tokens"), LEAF).withColumn("rest", F.expr("share - tokens * full")).withColumn("shift", F.lit(HASH_BITS) - width),
        "shares",
    )
    part = tokens.join(plan.filter("rest > 0").select(*LEAF, "rest", "full", "shift"), LEAF).withColumn(
        "h", order_hash(mix.seed, F.col("full") + 1, F.col("doc_id"))
    )
    part = part.withColumn("bucket", F.expr("shiftright(h, shift)"))
    by_bucket = part.groupBy(*LEAF, "bucket").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    along = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = spool.put(
        by_bucket.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))).filter("before < rest and before + n >= rest").select(
            *LEAF, "bucket", "before"
        ),
        "ends",
    )
    ordered = Window.partitionBy(*LEAF).orderBy("h", "key").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        part.join(ends, [*LEAF, "bucket"])
        .withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        .groupBy(*LEAF, "h", "key")
        .agg(F.sum("n_tokens").alias("n"), F.first("before").alias("before"), F.first("rest").alias("rest"))
        .withColumn("ahead", F.col("before") + F.coalesce(F.sum("n").over(ordered), F.lit(0)))
        .filter("ahead < rest")
        .groupBy(*LEAF)
        .agg(F.max(F.struct("h", "key")).alias("end"))
    )
    return spool.put(
        plan.join(last, LEAF, "left").select(
            *[F.col(c).alias(f"t_{c}") for c in LEAF], "share", "full", F.col("end.h").alias("max_hash"), F.col("end.key").alias("max_key")
        ),
        "thresholds",
    )


def _drawn(rows: DataFrame, limits: DataFrame, mix: Mix) -> DataFrame:
    """Rows that carry the LEAF columns and doc_id, one output row per epoch in which they are drawn."""
    joined = rows.join(limits, [F.col(c) == F.col(f"t_{c}") for c in LEAF])
    h = order_hash(mix.seed, F.col("full") + 1, F.col("doc_id"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    last = F.coalesce((h < F.col("max_hash")) | ((h == F.col("max_hash")) & (key <= F.col("max_key"))), F.lit(False))
    epochs = F.filter(F.sequence(F.lit(1), F.lit(mix.max_epochs + 1)), lambda e: (e <= F.col("full")) | ((e == F.col("full") + 1) & last))
    return joined.withColumn("epoch", F.explode(epochs))


def plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per drawn document and epoch: doc_id, domain, language, source, n_tokens, share (its leaf's), epoch."""
    spool = Spool(docs.sparkSession, "mix")
    tokens = spool.put(docs.select("doc_id", *leaf_columns(), count_words(F.col("text")).alias("n_tokens")).filter("n_tokens > 0"), "tokens")
    limits = thresholds(spool, tokens, mix)
    return _drawn(tokens, limits, mix).select("doc_id", "domain", "language", F.col("leaf_source").alias("source"), "n_tokens", "share", "epoch")


def draw(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The drawn documents themselves, all columns and the epoch; a document drawn in two epochs comes twice."""
    spool = Spool(docs.sparkSession, "mix")
    n = count_words(F.col("text"))
    tokens = spool.put(docs.select("doc_id", *leaf_columns(), n.alias("n_tokens")).filter("n_tokens > 0"), "tokens")
    limits = thresholds(spool, tokens, mix)
    tagged = docs.select(whole_row(docs, "epoch").alias("row"), "doc_id", n.alias("n_tokens"), *leaf_columns()).filter("n_tokens > 0")
    return _drawn(tagged, limits, mix).select("row.*", "epoch")
