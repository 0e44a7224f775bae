"""Registered queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm import ctw, decontam, embed_dedup, hard_negatives, html_template, jaccard_join, lang_ppm, line_dedup, mixing, pii_crf, prefix_tree, turn_repair, url_filter
from entitylake.llm.common import table
from entitylake.llm.oracles import ORACLES


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "dedup.n_lines", "dedup.lines_gone")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"), jaccard_join.Similarity(words=3, num=90, den=100))


def op6_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), depth=4, least=128)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_ppm.identify(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.main_texts(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.quantised(table(spark, sf_dir, "embeddings"), shifted), F.col("vec_id") % 100 == 0)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32 of conv_id:turn modulo 20 (nulls: one space)."""
    role, text = (turn_repair.or_space(F.col(c)) for c in ("role", "text"))
    kind = F.crc32(F.concat(turn_repair.or_space(F.col("conv_id")), F.lit(":"), turn_repair.or_space(F.col("turn")))) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    rows = rows.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("kind") == 4, turn_repair.USER).otherwise(F.col("role")))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = turn_repair.digests(damaged(conversations)).withColumnRenamed("conv_id", "found_id")
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    sha = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), sha)


def control_turns(spark: SparkSession) -> DataFrame:
    """Conversation -1: a user, then an assistant, both with control strings of the template as text."""
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))


def op13_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return prefix_tree.read_back(prefix_tree.build(given.unionByName(control_turns(spark))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_mixing": op3_mixing,
    "op4_pii": op4_pii,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_ctw_scoring": op6_ctw_scoring,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_html_extraction": op10_html_extraction,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_turn_repair": op12_turn_repair,
    "op13_prefix_tree": op13_prefix_tree,
}

ORACLE_SQL: dict[str, str] = {k: v for k, v in ORACLES.items() if k in QUERIES}
