"""Workloads over the given tables: one function per operator family.

Each function takes ``(spark, sf_dir)``, runs the operator's real Spark path
over the whole input tables and returns a flat DataFrame that a relational
oracle can reproduce (variants are flattened to text).  Intermediate tables go
to a fresh folder under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.functions.tokens import encode_token
from entitylake.functions.variants import flatten_entities, variant_object
from entitylake.lake import Lake
from entitylake.model import (
    DatasetDefinition,
    IncomingMapping,
    IncomingPropertyMapping,
    OutgoingMapping,
    OutgoingPropertyMapping,
    SourceConfig,
    Construction,
)
from entitylake.plans.read import EntityPage, all_pages, footer_rows, high_water_mark, newest_value, read_entities, since_window
from entitylake.session import scratch_dir
from entitylake.sinks import fs
from entitylake.sinks.feed import read_feed
from entitylake.sinks.payload import write_payloads
from entitylake.sinks.stage import write_stage
from entitylake.sources.entity_files import STAGE_ORDER, payload_entities, read_stage

# --- fixed values shared with the oracle SQL ---------------------------------
BASE = "http://data.example/"
EVENT = BASE + "event/"
USER = BASE + "user/"
CUSTOMER = BASE + "customer/"
NATION = BASE + "nation/"
ORDER = BASE + "order/"
PART = BASE + "part/"
LOAD_NS_1 = 1_700_000_000_000_000_000
LOAD_NS_2 = 1_700_000_100_000_000_000
STREAM_LOAD_NS = 1_700_001_000_000_000_000  # + micro-batch id
SPLIT_TS = "2024-01-16 00:00:00"  # two-batch split of events
LOG_LOAD1_END = "2024-01-20 00:00:00"  # log loads overlap between these
LOG_LOAD2_START = "2024-01-10 00:00:00"
RUN_SPLIT = ("2024-01-28 00:00:00", "2024-01-30 00:00:00")  # the second batch starts, the first one ends
WINDOW_FROM = "2024-01-15T00:00:00.000000"
PAGE_ROWS = 500
CHANGES_PAGE_ROWS = 5000
STREAM_FILE_EVENTS = 2000  # events of one landing file
PAYLOAD_ENTITIES = 1000


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows dealt over all tasks: else a table of few splits is mapped, staged and compressed by as many tasks."""
    return rows.repartition(*rows.columns)


def _week(events: DataFrame, wk: int, last: bool = False) -> DataFrame:
    """Events of a week since 2024-01-01 (``last``: and all after it), chosen in the scan."""
    lo, hi = (F.lit(datetime(2024, 1, 1) + timedelta(days=7 * k)).cast("timestamp_ntz") for k in (wk, wk + 1))
    since = events.where(F.col("ts") >= lo)
    return since if last else since.where(F.col("ts") < hi)


def _epoch_ns(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})") * F.lit(1000)


def event_entities(events: DataFrame, id_of: str = "user", prefix: bool = False) -> DataFrame:
    """Entities made from events; ``recorded`` is left unset for signups, errors are deleted."""
    ev, us = ("e:", "u:") if prefix else (EVENT, USER)
    ident = F.concat(F.lit(us), F.col("user_id")) if id_of == "user" else F.concat(F.lit(ev), F.col("event_id"))
    return events.select(
        ident.alias("id"),
        F.when(F.col("event_type") != "signup", _epoch_ns("ts")).alias("recorded"),
        (F.col("event_type") == "error").alias("deleted"),
        variant_object([(ev + "user", F.concat(F.lit(us), F.col("user_id")))]).alias("refs"),
        variant_object(
            [
                (ev + "event_id", F.col("event_id")),
                (ev + "type", F.col("event_type")),
                (ev + "k", F.get_json_object("props", "$.k").cast("bigint")),
                (ev + "value", F.col("value")),
            ]
        ).alias("props"),
        F.col("event_id").alias("_arrival"),
        F.col("ts").alias("_ts"),
    )


def _events_mapping() -> IncomingMapping:
    return IncomingMapping(
        property_mappings=(
            IncomingPropertyMapping("event_id", EVENT + "event_id", "integer"),
            IncomingPropertyMapping("event_type", EVENT + "type", "string"),
            IncomingPropertyMapping("k", EVENT + "k", "integer"),
            IncomingPropertyMapping("value", EVENT + "value", "float"),
            IncomingPropertyMapping("user_ref", EVENT + "user", "", is_reference=True),
            IncomingPropertyMapping("rec", is_recorded=True),
            IncomingPropertyMapping("del", is_deleted=True),
            IncomingPropertyMapping("ident", "", "string", is_identity=True),
        )
    )


def _lake(spark: SparkSession, purpose: str, **kw) -> Lake:
    return Lake(spark, scratch_dir(spark, purpose), database="DB", schema="PUBLIC", **kw)


# --- S1 ----------------------------------------------------------------------
def _raw_events(spark: SparkSession, sf_dir: str) -> EntityPage:
    """Events as raw JSON text: some behind white space, error events malformed."""
    ents = event_entities(_t(spark, sf_dir, "events"))
    text = F.to_json(F.struct("id", "recorded", "deleted", "refs", "props"))
    lead = F.when(F.col("_arrival") % 3 == 1, "\r\n\t").otherwise("")
    broken = F.concat(F.lit("{"), text)  # the whole entity text behind a stray brace: not JSON
    raw = ents.select(F.when(F.col("deleted"), broken).otherwise(F.concat(lead, text)).alias("ENTITY"))
    return read_entities(raw, DatasetDefinition("events_raw", SourceConfig(raw_column="ENTITY")))


def raw_entity_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON column -> entities."""
    e = _raw_events(spark, sf_dir).entities
    return e.select(
        "id",
        "recorded",
        "deleted",
        F.variant_get("props", f'$["{EVENT}event_id"]', "bigint").alias("event_id"),
        F.variant_get("props", f'$["{EVENT}type"]', "string").alias("event_type"),
        F.variant_get("props", f'$["{EVENT}k"]', "bigint").alias("k"),
        F.variant_get("refs", f'$["{EVENT}user"]', "string").alias("user_ref"),
    )


def raw_entity_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 (D9): what the raw scan rejects, with the reason and the id in the malformed text."""
    bad = _raw_events(spark, sf_dir).rejects
    return bad.select(F.regexp_extract("raw", '^[{][{]"id":"([^"]*)"', 1).alias("id_text"), "reason")


# --- S2, P1-P5 ---------------------------------------------------------------
CUSTOMER_MAPPING = OutgoingMapping(
    base_uri=CUSTOMER,
    constructions=(Construction("c_name", "replace", ("c_name", "Customer#", "")),),
    property_mappings=(
        OutgoingPropertyMapping("c_custkey", "id", "string", is_identity=True, uri_value_pattern=CUSTOMER + "id/{value}", required=True),
        OutgoingPropertyMapping("c_name", "name"),
        OutgoingPropertyMapping("c_mktsegment", "segment"),
        OutgoingPropertyMapping("c_nationkey", "nationkey"),
        OutgoingPropertyMapping("c_nationkey", "nation", is_reference=True, uri_value_pattern=NATION + "{value}"),
    ),
)


def mapped_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = DatasetDefinition("customer", SourceConfig(path=f"{sf_dir}/customer.parquet"), outgoing=CUSTOMER_MAPPING)
    lake = Lake(spark, scratch_dir(spark, "unused"))
    return flatten_entities(read_entities(lake.table(ds), ds).entities)


# --- S3, P6, P7 --------------------------------------------------------------
PART_MAPPING = OutgoingMapping(
    base_uri=PART,
    constructions=(Construction("p_brand", "replace", ("p_brand", "Brand#", "")),),
    property_mappings=(
        OutgoingPropertyMapping("p_partkey", "id", "string", is_identity=True, uri_value_pattern=PART + "id/{value}"),
        OutgoingPropertyMapping("p_brand", "brand", is_reference=True, uri_value_pattern=BASE + "brand/{value}"),
        OutgoingPropertyMapping("p_size", "size_text", "string"),
        OutgoingPropertyMapping("p_type", "kind", "string", default_value="UNKNOWN", required=True),
    ),
    map_all=True,
)


def map_all_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = DatasetDefinition("part", SourceConfig(path=f"{sf_dir}/part.parquet"), outgoing=PART_MAPPING)
    return flatten_entities(read_entities(_t(spark, sf_dir, "part"), ds).entities)


def null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 over real nulls: a default replaces them, a required column with a default is never null, others are left out."""
    part = _t(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("p_type"),
        F.when(F.col("p_partkey") % 4 != 0, F.col("p_size")).alias("p_size"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("p_name"),
    )
    mapping = OutgoingMapping(
        base_uri=PART,
        property_mappings=(
            OutgoingPropertyMapping("p_partkey", is_identity=True, uri_value_pattern=PART + "id/{value}"),
            OutgoingPropertyMapping("p_type", "kind", default_value="unknown kind", required=True),
            OutgoingPropertyMapping("p_size", "size", "varchar(10)", default_value="-1"),
            OutgoingPropertyMapping("p_name", "name"),
        ),
    )
    return flatten_entities(read_entities(part, DatasetDefinition("part_nulls", outgoing=mapping)).entities)


# --- A1, A2, X4-X6 -----------------------------------------------------------
def high_water_mark_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    after_id = "5000"
    after_ts = WINDOW_FROM

    def one(col: str, after: str | None) -> DataFrame:
        footers = footer_rows(spark, f"{sf_dir}/events.parquet", col)  # answers integers, here event_id
        hw = high_water_mark(ev, col, after, newest_value(footers, col) if footers is not None else None)
        return hw.select(
            F.lit(col).alias("since_column"), F.lit(after or "").alias("after"), "literal", "token"
        )

    return one("event_id", None).unionByName(one("event_id", after_id)).unionByName(one("ts", None)).unionByName(
        one("ts", after_ts)
    )


# --- F1, F2, I1, I2, L1 ------------------------------------------------------
EVENTS_OUT = OutgoingMapping(
    base_uri=EVENT,
    property_mappings=(
        OutgoingPropertyMapping("event_id", "id", is_identity=True, uri_value_pattern=EVENT + "{value}"),
        OutgoingPropertyMapping("event_type", "type"),
        OutgoingPropertyMapping("user_id", "user", is_reference=True, uri_value_pattern=USER + "{value}"),
    ),
)


def _events_ds(sf_dir: str) -> DatasetDefinition:
    return DatasetDefinition(
        "events", SourceConfig(path=f"{sf_dir}/events.parquet", since_column="ts"), outgoing=EVENTS_OUT
    )


def _page_out(page: EntityPage) -> DataFrame:
    return page.entities.select("id", F.lit(page.token).alias("token"))


def since_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = _events_ds(sf_dir)
    token = encode_token(f"'{WINDOW_FROM}'")
    return _page_out(read_entities(_t(spark, sf_dir, "events"), ds, token))


def since_nothing_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    first = since_window(ev, "ts")  # token of the current high-water mark
    page = read_entities(ev, _events_ds(sf_dir), first.token)
    return page.entities.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(page.token).alias("token"))


def limited_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = _events_ds(sf_dir)
    token = encode_token(f"'{WINDOW_FROM}'")
    return _page_out(read_entities(_t(spark, sf_dir, "events"), ds, token, limit=PAGE_ROWS))


ORDERS_OUT = OutgoingMapping(
    base_uri=ORDER,
    property_mappings=(
        OutgoingPropertyMapping("o_orderkey", "id", is_identity=True, uri_value_pattern=ORDER + "{value}"),
        OutgoingPropertyMapping("o_orderstatus", "status"),
        OutgoingPropertyMapping("o_custkey", "customer", is_reference=True, uri_value_pattern=CUSTOMER + "id/{value}"),
    ),
)


def changes_paged_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 + L1: all pages of a feed with their tokens."""
    ds = DatasetDefinition(
        "orders", SourceConfig(path=f"{sf_dir}/orders.parquet", since_column="O_ORDERDATE"), outgoing=ORDERS_OUT
    )
    return all_pages(_t(spark, sf_dir, "orders"), ds, CHANGES_PAGE_ROWS).select("id", "page", "token")


def log_pages_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 over ties: a log read by ``recorded``, which all rows of a load share, so a page is a load however small the limit."""
    lake = _lake(spark, "log-pages")
    lake.define(DatasetDefinition("events_loads"))
    feed = SourceConfig(database="DB", schema="PUBLIC", table_name="EVENTS_LOADS", raw_column="entity", since_column="RECORDED")
    lake.define(DatasetDefinition("events_loads_feed", feed))
    _two_batches(spark, sf_dir, lake, "events_loads")
    first = lake.entities("events_loads_feed", limit=PAGE_ROWS)
    second = lake.entities("events_loads_feed", since=first.token, limit=PAGE_ROWS)
    event_id = F.variant_get("props", f'$["{EVENT}event_id"]', "bigint").alias("event_id")
    pages = [p.entities.select(event_id, F.lit(p.token).alias("token")) for p in (first, second)]
    return pages[0].unionByName(pages[1])


# --- S5, P16 ----------------------------------------------------------------
ORDER_NS = {"o": ORDER, "c": CUSTOMER}


def _order_payloads(spark: SparkSession, sf_dir: str, path: str) -> None:
    o = _t(spark, sf_dir, "orders")
    ents = o.select(
        F.concat(F.lit("o:"), F.col("o_orderkey")).alias("id"),
        F.lit(None).cast("bigint").alias("recorded"),
        F.lit(False).alias("deleted"),
        variant_object([("o:customer", F.concat(F.lit("c:id/"), F.col("o_custkey")))]).alias("refs"),
        variant_object(
            [("o:status", F.col("o_orderstatus")), ("o:priority", F.col("o_orderpriority")), ("o:key", F.col("o_orderkey"))]
        ).alias("props"),
        F.floor(F.col("o_orderkey") / PAYLOAD_ENTITIES).alias("file_no"),
        F.col("o_orderkey").alias("pos"),
    )
    lead = F.when(F.col("file_no") % 3 == 1, "\n\t").when(F.col("file_no") % 3 == 2, "\r\n ").otherwise("")
    write_payloads(ents, path, "file_no", "pos", ORDER_NS, lead)


def expand_namespaces_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "payloads")
    _order_payloads(spark, sf_dir, path)
    return flatten_entities(payload_entities(spark, path))  # the folder: Spark lists its files in one step


# --- K1, S6, S7 -------------------------------------------------------------
def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    ents = read_entities(o, DatasetDefinition("orders", SourceConfig(), outgoing=ORDERS_OUT)).entities
    path = scratch_dir(spark, "stage")
    write_stage(ents, path)
    staged = read_stage(spark, path)
    back = staged.select(
        F.variant_get("entity", "$.id", "string").alias("id"),
        F.try_variant_get("entity", "$.recorded", "bigint").alias("recorded"),
        F.coalesce(F.try_variant_get("entity", "$.deleted", "boolean"), F.lit(False)).alias("deleted"),
        F.variant_get("entity", "$.refs", "variant").alias("refs"),
        F.variant_get("entity", "$.props", "variant").alias("props"),
    )
    return flatten_entities(back)


# --- K2, K3, P8-P15 ----------------------------------------------------------
def ingest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "ingest-raw")
    lake.define(DatasetDefinition("events_raw"))
    lake.write_incremental("events_raw", event_entities(_t(spark, sf_dir, "events")), LOAD_NS_1, "b1", ("_arrival",))
    log = lake.log("events_raw")
    return log.select(
        "id",
        "recorded",
        "deleted",
        "dataset",
        F.try_variant_get("entity", "$.recorded", "bigint").alias("entity_recorded"),
        F.variant_get("entity", f'$.props["{EVENT}event_id"]', "bigint").alias("event_id"),
        F.variant_get("entity", f'$.props["{EVENT}k"]', "bigint").alias("k"),
        F.variant_get("entity", f'$.refs["{EVENT}user"]', "string").alias("user_ref"),
    )


def ingest_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "ingest-mapped")
    lake.define(DatasetDefinition("events_mapped", incoming=_events_mapping()))
    lake.write_incremental("events_mapped", event_entities(_t(spark, sf_dir, "events")), LOAD_NS_1, "b1", ("_arrival",))
    return lake.log("events_mapped")


def custom_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = IncomingMapping(
        property_mappings=(
            IncomingPropertyMapping("event_id", EVENT + "event_id", "integer"),
            IncomingPropertyMapping(
                "type_upper",
                datatype="string",
                custom_expression=f"upper(variant_get(entity, '$.props[\"{EVENT}type\"]', 'string'))",
            ),
            IncomingPropertyMapping(
                "k_scaled",
                datatype="integer",
                custom_expression=f"variant_get(entity, '$.props[\"{EVENT}k\"]', 'bigint') * 10 + 1",
            ),
        )
    )
    lake = _lake(spark, "custom")
    lake.define(DatasetDefinition("events_custom", incoming=mapping))
    lake.write_incremental("events_custom", event_entities(_t(spark, sf_dir, "events")), LOAD_NS_1, "b1", ("_arrival",))
    return lake.log("events_custom")


def record_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 in the documented form (``$1``), parameterised datatypes."""
    mapping = IncomingMapping(
        property_mappings=(
            IncomingPropertyMapping("event_id", EVENT + "event_id", "number(38,0)"),
            IncomingPropertyMapping("kind", datatype="varchar(255)", custom_expression=f'$1:props:"{EVENT}type"::string'),
            IncomingPropertyMapping("k_price", EVENT + "k", "NUMBER(12, 2)"),
            IncomingPropertyMapping("at", EVENT + "at", "timestamp_ntz(9)"),
            IncomingPropertyMapping("label", datatype="text", custom_expression=f"""concat('$1 ', $1:props:"{EVENT}type"::string)"""),
        )
    )
    ents = event_entities(_t(spark, sf_dir, "events")).withColumn("_at", F.date_format("_ts", "yyyy-MM-dd HH:mm:ss"))
    props = F.map_concat(F.col("props").cast("map<string,variant>"), F.create_map(F.lit(EVENT + "at"), F.col("_at").cast("variant")))
    lake = _lake(spark, "record")
    lake.define(DatasetDefinition("events_record", incoming=mapping))
    lake.write_incremental("events_record", ents.withColumn("props", F.to_variant_object(props)), LOAD_NS_1, "b1")
    text = [F.col(c).cast("string").alias(c) for c in ("event_id", "k_price")]
    return lake.log("events_record").select("id", *text, "kind", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), "label")


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls in a required column and values that cannot be cast are rejected with their reasons, the rest is loaded."""
    mapping = IncomingMapping(
        property_mappings=(
            IncomingPropertyMapping("event_id", EVENT + "event_id", "integer"),
            IncomingPropertyMapping("amount", EVENT + "value", "float"),
            IncomingPropertyMapping("own_time", is_recorded=True, required=True),
        )
    )
    ents = event_entities(_t(spark, sf_dir, "events"), id_of="event")
    spoiled = F.when(F.col("_arrival") % 5 == 0, F.lit("n/a").cast("variant")).otherwise(F.variant_get("props", f'$["{EVENT}value"]', "variant"))
    props = F.map_filter(F.col("props").cast("map<string,variant>"), lambda k, v: k != EVENT + "value")
    ents = ents.withColumn("props", F.to_variant_object(F.map_concat(props, F.create_map(F.lit(EVENT + "value"), spoiled))))
    lake = _lake(spark, "rejects", latest_default=True)
    lake.define(DatasetDefinition("events_checked", incoming=mapping))
    lake.write_incremental("events_checked", ents, LOAD_NS_1, "b1", ("_arrival",), strict=False)
    bad = lake.rejects("events_checked")
    event_id = F.get_json_object("raw", f"$.props['{EVENT}event_id']").cast("bigint")
    frames = [bad.select(F.lit("rejects").alias("tbl"), "id", "recorded", event_id.alias("event_id"), F.lit(None).cast("double").alias("amount"), "reason")]
    for tbl, rows in (("log", lake.log("events_checked")), ("latest", lake.latest("events_checked"))):
        frames.append(rows.select(F.lit(tbl).alias("tbl"), "id", "recorded", "event_id", "amount", F.lit(None).cast("string").alias("reason")))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def array_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References that are arrays keep all their URIs, as JSON text in a string column and as elements in a variant."""
    c = _t(spark, sf_dir, "customer")
    uris = F.array(F.concat(F.lit(NATION), F.col("c_nationkey")), F.concat(F.lit(CUSTOMER + "segment/"), F.col("c_mktsegment")))
    several = F.when(F.col("c_custkey") % 2 == 0, uris.cast("variant")).otherwise(F.get(uris, F.lit(0)).cast("variant"))
    ents = c.select(
        F.concat(F.lit(CUSTOMER + "id/"), F.col("c_custkey")).alias("id"),
        F.lit(None).cast("bigint").alias("recorded"),
        F.lit(False).alias("deleted"),
        F.to_variant_object(F.create_map(F.lit(CUSTOMER + "links"), several)).alias("refs"),
        variant_object([]).alias("props"),
    )
    mapping = IncomingMapping(
        property_mappings=(
            IncomingPropertyMapping("links", CUSTOMER + "links", "string", is_reference=True),
            IncomingPropertyMapping("links_raw", CUSTOMER + "links", "variant", is_reference=True),
        )
    )
    lake = _lake(spark, "array-refs")
    lake.define(DatasetDefinition("customer_links", incoming=mapping))
    lake.write_incremental("customer_links", ents, LOAD_NS_1, "b1")
    return lake.log("customer_links").select("id", "links", F.try_variant_get("links_raw", "$[1]", "string").alias("second"))


# --- W1, W2, J1, I4 ----------------------------------------------------------
def dedup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 over a staged batch: newest per user (NULL recorded wins, then arrival)."""
    from entitylake.operators.dedup import newest_per_id

    path = scratch_dir(spark, "dedup-stage")
    write_stage(event_entities(_t(spark, sf_dir, "events")), path, order_by=("_arrival",))
    staged = read_stage(spark, path).select(
        F.variant_get("entity", "$.id", "string").alias("id"),
        F.try_variant_get("entity", "$.recorded", "bigint").alias("recorded"),
        F.variant_get("entity", f'$.props["{EVENT}event_id"]', "bigint").alias("event_id"),
        *STAGE_ORDER,
    )
    return newest_per_id(staged, "recorded", STAGE_ORDER).select("id", "recorded", "event_id")


def latest_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + F3: newest version of each event over two overlapping loads."""
    lake = _lake(spark, "log2")
    lake.define(DatasetDefinition("events_log", incoming=_events_mapping()))
    ev = event_entities(_t(spark, sf_dir, "events"), id_of="event")
    lake.write_incremental("events_log", ev.where(F.col("_ts") < F.lit(LOG_LOAD1_END).cast("timestamp_ntz")), LOAD_NS_1, "b1")
    lake.write_incremental("events_log", ev.where(F.col("_ts") >= F.lit(LOG_LOAD2_START).cast("timestamp_ntz")), LOAD_NS_2, "b2")
    return lake.newest("events_log", live_only=True)


def newest_of_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 where a load holds an id many times: by load, own ``recorded``, arrival; the same after compaction."""
    lake = _lake(spark, "log-ties", log_compact_batches=2)
    lake.define(DatasetDefinition("events_ties", incoming=_events_mapping()))
    _two_batches(spark, sf_dir, lake, "events_ties")
    return lake.newest("events_ties")


def _two_batches(spark: SparkSession, sf_dir: str, lake: Lake, name: str) -> None:
    ev = event_entities(_t(spark, sf_dir, "events"))
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    lake.write_incremental(name, ev.where(F.col("_ts") < split), LOAD_NS_1, "b1", ("_arrival",))
    lake.write_incremental(name, ev.where(F.col("_ts") >= split), LOAD_NS_2, "b2", ("_arrival",))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: two incremental batches into log + latest."""
    lake = _lake(spark, "upsert", latest_default=True)
    lake.define(DatasetDefinition("events_latest", incoming=_events_mapping()))
    _two_batches(spark, sf_dir, lake, "events_latest")
    return lake.latest("events_latest")


def upsert_latest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 through copy-on-write compaction after every batch (delta bound of one row)."""
    lake = _lake(spark, "upsert-compacted", latest_default=True, delta_rows_max=1)
    lake.define(DatasetDefinition("events_latest", incoming=_events_mapping()))
    _two_batches(spark, sf_dir, lake, "events_latest")
    assert not lake.state("events_latest").deltas
    return lake.latest("events_latest")


def log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 over weekly batches with tiered log compaction every two batches."""
    lake = _lake(spark, "log-weekly", log_compact_batches=2)
    lake.define(DatasetDefinition("events_weekly", incoming=_events_mapping()))
    events = _t(spark, sf_dir, "events")
    week0 = datetime(2024, 1, 1)
    span = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()  # one batch per week: a handful
    for wk in range((span["lo"] - week0).days // 7, (span["hi"] - week0).days // 7 + 1):
        ev = event_entities(_dealt(_week(events, wk)), id_of="event")
        lake.write_incremental("events_weekly", ev, LOAD_NS_1 + wk, f"w{wk}", ("_arrival",))
    return lake.log("events_weekly")


def staged_row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S7: staged files keep arrival order and hold at most ``per_file`` rows."""
    from pyspark.sql import Window

    per_file = 1000
    o = _t(spark, sf_dir, "orders")
    ents = o.select(
        F.concat(F.lit(ORDER), F.col("o_orderkey")).alias("id"),
        F.lit(None).cast("bigint").alias("recorded"),
        F.lit(False).alias("deleted"),
        variant_object([]).alias("refs"),
        variant_object([(ORDER + "key", F.col("o_orderkey"))]).alias("props"),
        F.col("o_orderkey").alias("_arrival"),
    )
    path = scratch_dir(spark, "stage-order")
    write_stage(ents, path, order_by=("_arrival",), per_file=per_file)
    st = read_stage(spark, path).select(
        F.variant_get("entity", "$.id", "string").alias("id"),
        F.variant_get("entity", f'$.props["{ORDER}key"]', "bigint").alias("key"),
        "_file",
        "_fts",
        "_blk",
        "_ix",
    )
    in_file = Window.partitionBy("_file")  # a file holds at most ``per_file`` rows
    row = F.row_number().over(in_file.orderBy("_blk", "_ix"))
    return st.select(
        "id",
        (F.col("key") - F.min("key").over(in_file) + 1 - row).alias("key_gap"),
        (F.count(F.lit(1)).over(in_file) <= per_file).alias("within_cap"),
        (F.col("_fts") == F.max("_fts").over(in_file)).alias("one_time"),  # a file has one modification time
    )


# --- I5, I6, K4 --------------------------------------------------------------
CUSTOMER_IN = IncomingMapping(
    property_mappings=(
        IncomingPropertyMapping("name", CUSTOMER + "name", "string"),
        IncomingPropertyMapping("segment", CUSTOMER + "segment", "string"),
        IncomingPropertyMapping("nation", CUSTOMER + "nation", "string", is_reference=True),
    )
)
SYNC_BATCHES = 3


def _customer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit(CUSTOMER + "id/"), F.col("c_custkey")).alias("id"),
        F.lit(None).cast("bigint").alias("recorded"),
        F.lit(False).alias("deleted"),
        variant_object([(CUSTOMER + "nation", F.concat(F.lit(NATION), F.col("c_nationkey")))]).alias("refs"),
        variant_object([(CUSTOMER + "name", F.col("c_name")), (CUSTOMER + "segment", F.col("c_mktsegment"))]).alias("props"),
        F.pmod(F.xxhash64("c_custkey"), F.lit(SYNC_BATCHES)).alias("_batch"),
        F.col("c_custkey").alias("_arrival"),
    )


def _nation_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _t(spark, sf_dir, "nation")
    return n.select(
        F.concat(F.lit(NATION), F.col("n_nationkey")).alias("id"),
        F.lit(None).cast("bigint").alias("recorded"),
        F.lit(False).alias("deleted"),
        variant_object([]).alias("refs"),
        variant_object([(CUSTOMER + "name", F.col("n_name"))]).alias("props"),
        F.col("n_nationkey").alias("_arrival"),
    )


def _tables_out(lake: Lake, name: str) -> DataFrame:
    log = lake.log(name).withColumn("tbl", F.lit("log"))
    latest = lake.latest(name).withColumn("tbl", F.lit("latest"))
    return log.unionByName(latest)


def full_sync_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "fullsync", latest_default=True)
    lake.define(DatasetDefinition("customers", incoming=CUSTOMER_IN))
    older = _customer_entities(spark, sf_dir).drop("_batch").unionByName(_nation_entities(spark, sf_dir))
    lake.write_incremental("customers", older, LOAD_NS_1, "older", ("_arrival",))
    sync = lake.full_sync("customers", "sync-1")
    sync.start()
    cust = _customer_entities(spark, sf_dir)
    for i in range(SYNC_BATCHES):
        sync.add(cust.where(F.col("_batch") == i), seq=i, order_by=("_arrival",))
    sync.commit(LOAD_NS_2)
    return _tables_out(lake, "customers")


def full_sync_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "fullsync-restart", latest_default=True)
    lake.define(DatasetDefinition("customers", incoming=CUSTOMER_IN))
    abandoned = lake.full_sync("customers", "sync-a")
    abandoned.start()
    abandoned.add(_nation_entities(spark, sf_dir), seq=0)
    fresh = lake.full_sync("customers", "sync-b")
    fresh.start()
    try:
        abandoned.add(_nation_entities(spark, sf_dir), seq=1)
        raise AssertionError("a voided sync accepted a batch")
    except RuntimeError:
        pass
    fresh.add(_customer_entities(spark, sf_dir).drop("_batch"), seq=0, order_by=("_arrival",))
    fresh.commit(LOAD_NS_2)
    return _tables_out(lake, "customers")


def full_sync_same_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 + I6 with one sync id throughout: abandoned, restarted, committed, and used for a second sync."""
    lake = _lake(spark, "fullsync-same", latest_default=True)
    lake.define(DatasetDefinition("customers", incoming=CUSTOMER_IN))
    cust, nations = _customer_entities(spark, sf_dir).drop("_batch"), _nation_entities(spark, sf_dir)
    for wanted, load in ((nations, LOAD_NS_1), (cust, LOAD_NS_2)):
        abandoned = lake.full_sync("customers", "sync-1")
        abandoned.start()
        abandoned.add(wanted, seq=0)
        abandoned.add(nations, seq=1)
        again = lake.full_sync("customers", "sync-1")
        again.start()
        again.add(wanted, seq=0, order_by=("_arrival",))
        again.commit(load)
    return _tables_out(lake, "customers")


def full_sync_latest_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 with latest switched off: the log is replaced, the latest table stays; a repeated commit changes nothing."""
    lake = _lake(spark, "fullsync-off", latest_default=True)
    lake.define(DatasetDefinition("customers", incoming=CUSTOMER_IN))
    cust, nations = _customer_entities(spark, sf_dir).drop("_batch"), _nation_entities(spark, sf_dir)
    lake.write_incremental("customers", cust.unionByName(nations), LOAD_NS_1, "older", ("_arrival",))
    lake.define(DatasetDefinition("customers", SourceConfig(latest_table=False), incoming=CUSTOMER_IN))
    sync = lake.full_sync("customers", "sync-1")
    sync.start()
    sync.add(cust, seq=0, order_by=("_arrival",))
    done = sync.commit(LOAD_NS_2)
    assert sync.commit(LOAD_NS_2).version == done.version
    return _tables_out(lake, "customers")


# --- K5 ---------------------------------------------------------------------
CUSTOMER_FEED_OUT = OutgoingMapping(
    base_uri=CUSTOMER,
    property_mappings=(
        OutgoingPropertyMapping("c_custkey", "id", is_identity=True, uri_value_pattern=CUSTOMER + "id/{value}"),
        OutgoingPropertyMapping("c_name", "name"),
        OutgoingPropertyMapping("c_custkey", "key"),
        OutgoingPropertyMapping("c_nationkey", "nation", is_reference=True, uri_value_pattern=NATION + "{value}"),
    ),
)


def entity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the whole customer table as a feed in its order: context, entity lines, continuation."""
    lake = _lake(spark, "feed")
    lake.define(DatasetDefinition("customer", SourceConfig(path=f"{sf_dir}/customer.parquet"), outgoing=CUSTOMER_FEED_OUT))
    path = scratch_dir(spark, "feed")
    lake.feed("customer", path)
    return read_feed(spark, path)


# --- S4 ---------------------------------------------------------------------
def convention_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write by convention (entity column), read back by ``DB.PUBLIC.<TABLE>``."""
    lake = _lake(spark, "convention")
    lake.write_incremental("events_conv", event_entities(_t(spark, sf_dir, "events")), LOAD_NS_1, "b1", ("_arrival",))
    page = lake.entities("DB.PUBLIC.EVENTS_CONV")
    return flatten_entities(page.entities)


def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the session's catalog, named in the definition."""
    view = f"customer_{uuid.uuid4().hex[:8]}"
    _t(spark, sf_dir, "customer").createOrReplaceTempView(view)
    lake = _lake(spark, "catalog")
    lake.define(DatasetDefinition("catalog_customers", SourceConfig(catalog_table=view), outgoing=CUSTOMER_MAPPING))
    return flatten_entities(lake.entities("catalog_customers").entities)


def catalog_convention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table of JSON entities found by name alone: ``database.schema.table``, without a definition."""
    schema = f"events_{uuid.uuid4().hex[:8]}"
    ents = event_entities(_t(spark, sf_dir, "events"))
    spark.sql(f"CREATE SCHEMA {schema}")
    try:
        text = F.to_json(F.struct("id", "recorded", "deleted", "refs", "props")).alias("ENTITY")
        ents.select(text).write.option("path", scratch_dir(spark, "catalog-table")).saveAsTable(f"{schema}.raw_events")
        lake = Lake(spark, scratch_dir(spark, "catalog-lake"), database="DB", schema=schema)
        pages = [lake.entities(name).entities for name in (f"DB.{schema}.RAW_EVENTS", "raw.events")]
        both = pages[0].withColumn("by", F.lit("full name")).unionByName(pages[1].withColumn("by", F.lit("short name")))
        flat = both.select("by", "id", "recorded", F.variant_get("props", f'$["{EVENT}event_id"]', "bigint").alias("event_id"))
    finally:  # the files stay, and the frame has found them
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return flat


def log_since_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 over a log table: a consumer reads after each load and follows the token."""
    lake = _lake(spark, "log-since")
    lake.define(DatasetDefinition("events_log_raw"))
    lake.define(
        DatasetDefinition(
            "events_log_feed",
            SourceConfig(database="DB", schema="PUBLIC", table_name="EVENTS_LOG_RAW", raw_column="entity", since_column="recorded"),
        )
    )
    ev = event_entities(_t(spark, sf_dir, "events"))
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    lake.write_incremental("events_log_raw", ev.where(F.col("_ts") < split), LOAD_NS_1, "b1", ("_arrival",))
    first = lake.entities("events_log_feed")  # everything so far, token = first load time
    lake.write_incremental("events_log_raw", ev.where(F.col("_ts") >= split), LOAD_NS_2, "b2", ("_arrival",))
    second = lake.entities("events_log_feed", since=first.token)  # only the second load
    return second.entities.select(
        "id",
        F.variant_get("props", f'$["{EVENT}event_id"]', "bigint").alias("event_id"),
        F.lit(first.token).alias("after_token"),
        F.lit(second.token).alias("token"),
    )


def log_since_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 / F2 over a log by a mapped column: the event time, in weekly batches; older batches are not opened."""
    lake = _lake(spark, "log-event-time")
    mapping = IncomingMapping(
        property_mappings=(
            IncomingPropertyMapping("event_id", EVENT + "event_id", "integer"),
            IncomingPropertyMapping("at", EVENT + "at", "timestamp_ntz"),
        )
    )
    lake.define(DatasetDefinition("events_timed", incoming=mapping))
    feed = SourceConfig(table_name="EVENTS_TIMED", since_column="AT")
    out = OutgoingMapping(property_mappings=(OutgoingPropertyMapping("event_id", is_identity=True, uri_value_pattern=EVENT + "{value}"),))
    lake.define(DatasetDefinition("events_timed_feed", feed, outgoing=out))
    events = _t(spark, sf_dir, "events")
    at = F.create_map(F.lit(EVENT + "at"), F.date_format("_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").cast("variant"))
    props = F.to_variant_object(F.map_concat(F.col("props").cast("map<string,variant>"), at))
    for wk in range(5):
        ents = event_entities(_dealt(_week(events, wk, last=wk == 4)), id_of="event").withColumn("props", props)
        lake.write_incremental("events_timed", ents, LOAD_NS_1 + wk, f"w{wk}")
    token = encode_token(f"'{WINDOW_FROM}'")  # the first day of the third week
    page = lake.entities("events_timed_feed", since=token)
    opened = {f.rsplit("/", 2)[1] for f in lake.table(lake.dataset("events_timed_feed"), token).inputFiles()}
    assert all(folder[:2] in ("w2", "w3", "w4") for folder in opened), opened
    return page.entities.select("id", F.lit(page.token).alias("token"))


def upsert_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 where few ids change: the second batch becomes a bucketed run beside the base."""
    lake = _lake(spark, "upsert-run", latest_default=True, delta_rows_max=1)
    lake.define(DatasetDefinition("events_run", incoming=_events_mapping()))
    ev = event_entities(_t(spark, sf_dir, "events"), id_of="event")
    lake.write_incremental("events_run", ev.where(F.col("_ts") < F.lit(RUN_SPLIT[1]).cast("timestamp_ntz")), LOAD_NS_1, "b1")
    lake.write_incremental("events_run", ev.where(F.col("_ts") >= F.lit(RUN_SPLIT[0]).cast("timestamp_ntz")), LOAD_NS_2, "b2")
    return lake.latest("events_run")


# --- I4 via Structured Streaming ----------------------------------------------
def _landing_files(spark: SparkSession, sf_dir: str, landing: str) -> list[str]:
    """Payload files of the events in arrival order, one minute apart."""
    def file_no(event_id: str) -> Column:
        return F.floor(F.col(event_id) / STREAM_FILE_EVENTS).cast("bigint")  # files of a bounded size

    # dealt by file before they are mapped: else a table of few splits is mapped by as many tasks
    events = _t(spark, sf_dir, "events").repartition(file_no("event_id"))
    ev = event_entities(events, prefix=True).withColumn("file_no", file_no("_arrival"))
    write_payloads(ev, landing, "file_no", "_arrival", {"e": EVENT, "u": USER})
    files = sorted(fs.files_below(spark, landing), key=lambda f: (int(f.rsplit("/", 2)[1].split("=")[1]), f))
    fs.set_mtimes(spark, landing, {f: 1_700_000_000_000 + i * 60_000 for i, f in enumerate(files)})  # arrival order = file number
    return files


def _stream(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int) -> DataFrame:
    from entitylake.streaming.landing import ingest_stream

    landing = scratch_dir(spark, "landing")
    _landing_files(spark, sf_dir, landing)
    lake = _lake(spark, "stream", latest_default=True)
    lake.define(DatasetDefinition(name, incoming=_events_mapping()))
    ingest_stream(lake, name, landing, scratch_dir(spark, "stream-ckpt"), STREAM_LOAD_NS, files_per_batch)
    return lake.latest(name)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 as a stream, eight files in a micro-batch."""
    return _stream(spark, sf_dir, "events_stream", 8)


def stream_ingest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 as a stream, one file in a micro-batch: the same result."""
    return _stream(spark, sf_dir, "events_stream", 1)


def stream_resized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 as a stream restarted with another batch size: the last file arrives after the others were loaded, four at a time."""
    from entitylake.streaming.landing import ingest_stream

    ready, landing, checkpoint = (scratch_dir(spark, p) for p in ("ready", "landing", "stream-ckpt"))
    files = _landing_files(spark, sf_dir, ready)
    lake = _lake(spark, "stream-resized", latest_default=True)
    lake.define(DatasetDefinition("events_stream", incoming=_events_mapping()))
    for names, files_per_batch in ((files[:-1], 4), (files[-1:], 1)):
        fs.move_into(spark, {f: f"{f.rsplit('/', 2)[1]}.json" for f in names}, landing)
        ingest_stream(lake, "events_stream", landing, checkpoint, STREAM_LOAD_NS, files_per_batch)
    return lake.latest("events_stream")
