"""Entity feed sink (K5): ``[@context, entities..., @continuation]`` as JSON lines.

Entity lines are written by Spark as part files, in the table's order where it has
one; the context and continuation lines are two small sidecar files, so no task
ever holds the whole feed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitylake.model import CONTEXT_ID, CONTINUATION_ID
from entitylake.operators.outgoing import entity_json
from entitylake.sinks import fs

HEAD, TAIL = "_feed_context.json", "_feed_continuation.json"


def context_line(namespaces: dict[str, str] | None = None) -> str:
    return json.dumps({"id": CONTEXT_ID, "namespaces": namespaces or {}}, separators=(",", ":"))


def continuation_line(token: str) -> str:
    return json.dumps({"id": CONTINUATION_ID, "token": token}, separators=(",", ":"))


def write_feed(entities: DataFrame, token: str, path: str, order_by: tuple[str, ...] = ()) -> None:
    """Write a feed directory; re-running overwrites it.

    With ``order_by`` the entities are range partitioned and sorted by those
    columns, so the files by number, and the lines in them, are in that order.
    """
    spark = entities.sparkSession
    if order_by:
        entities = entities.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    entities.select(entity_json(entities).alias("value")).write.mode("overwrite").text(path)
    fs.write_text_exclusive(spark, f"{path}/{HEAD}", context_line())
    fs.write_text_exclusive(spark, f"{path}/{TAIL}", continuation_line(token))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """All feed lines with their position class (0 context, 1 entity, 2 continuation) and gap-free ``position``.

    Lines are numbered without bringing them together: a row counter rises along
    each split of a file, the splits' first counters and sizes are one small row
    each, and the lines before a split are a running sum over those.
    """
    head = fs.read_text(spark, f"{path}/{HEAD}")
    tail = fs.read_text(spark, f"{path}/{TAIL}")
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.regexp_extract(F.element_at(F.split("_metadata.file_path", "/"), -1), r"^part-([0-9]{1,18})", 1).cast("bigint").alias("_part"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_ix"),
    )
    split = ("_part", "_file", "_blk")
    ahead = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)  # one row for each split
    sizes = lines.groupBy(*split).agg(F.min("_ix").alias("_first"), F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    body = lines.join(F.broadcast(sizes.drop("_n", "_part")), ["_file", "_blk"]).select(
        F.lit(1).alias("section"), "line", (F.col("_before") + F.col("_ix") - F.col("_first") + 1).alias("position")
    )
    ends = spark.createDataFrame([(0, head), (2, tail)], "section int, line string")
    last = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    ends = ends.crossJoin(F.broadcast(last)).select("section", "line", F.when(F.col("section") == 0, 0).otherwise(F.col("n") + 1).alias("position"))
    return ends.unionByName(body)
