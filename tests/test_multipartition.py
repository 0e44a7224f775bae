"""Arrival order survives inputs spread over many, shuffled partitions."""

from collections import Counter

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from entitylake import workloads as w
from entitylake.lake import Lake
from entitylake.model import DatasetDefinition
from entitylake.operators.dedup import newest_per_id
from entitylake.session import scratch_dir
from entitylake.sinks.stage import write_stage
from entitylake.sources.entity_files import STAGE_ORDER, read_stage
from tests.conftest import SF
from tools.check_oracle import rows_of


def _oracle(name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    res = con.execute(entry.oracle_sql()[name])
    return [d[0] for d in res.description], res.fetchall()


def _shuffled_events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").repartition(7)  # arbitrary partition order


def test_upsert_with_shuffled_multi_partition_batches(spark):
    lake = Lake(spark, scratch_dir(spark, "mp-upsert"), latest_default=True, buckets=8)
    lake.define(DatasetDefinition("events_latest", incoming=w._events_mapping()))
    ev = w.event_entities(_shuffled_events(spark))
    assert ev.rdd.getNumPartitions() > 1
    split = F.lit(w.SPLIT_TS).cast("timestamp_ntz")
    lake.write_incremental("events_latest", ev.where(F.col("_ts") < split), w.LOAD_NS_1, "b1", ("_arrival",))
    lake.write_incremental("events_latest", ev.where(F.col("_ts") >= split), w.LOAD_NS_2, "b2", ("_arrival",))
    got = lake.latest("events_latest")
    cols, rows = _oracle("upsert_latest")
    assert Counter(rows_of(got.columns, [tuple(r) for r in got.collect()])) == Counter(rows_of(cols, rows))


def test_dedup_with_shuffled_multi_partition_batch(spark):
    path = scratch_dir(spark, "mp-dedup")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep many part files
    try:
        write_stage(w.event_entities(_shuffled_events(spark)), path, order_by=("_arrival",), per_file=50)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.text(path).inputFiles()
    assert len(files) > 8 and len({f.split("-c0")[0] for f in files}) > 1  # several tasks, several rollovers
    staged = read_stage(spark, path).select(
        F.variant_get("entity", "$.id", "string").alias("id"),
        F.try_variant_get("entity", "$.recorded", "bigint").alias("recorded"),
        F.variant_get("entity", f'$.props["{w.EVENT}event_id"]', "bigint").alias("event_id"),
        *STAGE_ORDER,
    )
    got = newest_per_id(staged, "recorded", STAGE_ORDER).select("id", "recorded", "event_id")
    cols, rows = _oracle("dedup_batch")
    assert Counter(rows_of(got.columns, [tuple(r) for r in got.collect()])) == Counter(rows_of(cols, rows))
