"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

STAGES are applied in order; each takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame.  All but the last return the columns of ``documents``; the last
returns one row per draw: the document's columns and the epoch in which it is drawn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm import decontam, jaccard_join, lang_ppm, line_dedup, mixing
from entitylake.llm.common import Spool, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose language is not recognised."""
    return lang_ppm.keep_known(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated line chunks; documents of which nothing but white space is left go, ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs).filter((F.col("dedup.lines_gone") == 0) | F.col("text").rlike(r"\S"))
    n_chars = F.when(F.col("dedup.lines_gone") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, similarity 0.8)."""
    return jaccard_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents to the target weights."""
    return mixing.draw(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    spool = Spool(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spool.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language identification by trained statistics is not expressible in SQL; see tests/llm for the brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
