"""

Every query runs the library's real Spark path over whole input tables.  The
oracle SQL restates the expected result relationally; URIs, load times and
split points are the fixed values of ``entitylake.workloads``.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # also when loaded by file path

from entitylake import workloads as w  # noqa: E402
from entitylake.session import ensure_checkpoint_dir  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: two incremental batches into log + latest, latest table returned."""
    ensure_checkpoint_dir(spark)
    return w.upsert_latest(spark, SF_SMOKE)


def _q(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _optional(module: str, name: str) -> dict:
    """``module.name`` if the module is there at all; an error inside a module that is there is raised."""
    try:
        found = importlib.util.find_spec(module)
    except ModuleNotFoundError:  # its package is not there
        found = None
    return getattr(importlib.import_module(module), name) if found else {}


def _pipeline(name: str) -> dict:
    """``corpus_pipeline.name`` if both the pipeline and the operators it is made of are there."""
    return _optional("corpus_pipeline", name) if importlib.util.find_spec("entitylake.llm") else {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    extra = _optional("entitylake.llm.queries", "QUERIES") | _pipeline("QUERIES")
    return library_queries() | {name: _q(fn) for name, fn in extra.items()}


def oracle_sql() -> dict[str, str]:
    return library_oracle_sql() | _optional("entitylake.llm.queries", "ORACLE_SQL") | _pipeline("ORACLES")


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "raw_entity_scan": _q(w.raw_entity_scan),
        "raw_entity_rejects": _q(w.raw_entity_rejects),
        "catalog_scan": _q(w.catalog_scan),
        "null_defaults": _q(w.null_defaults),
        "record_expression": _q(w.record_expression),
        "array_references": _q(w.array_references),
        "log_pages_by_load": _q(w.log_pages_by_load),
        "newest_of_repeated_ids": _q(w.newest_of_repeated_ids),
        "full_sync_same_id": _q(w.full_sync_same_id),
        "stream_ingest_single": _q(w.stream_ingest_single),
        "mapped_entities": _q(w.mapped_entities),
        "map_all_entities": _q(w.map_all_entities),
        "high_water_mark": _q(w.high_water_mark_q),
        "since_window": _q(w.since_window_q),
        "since_nothing_new": _q(w.since_nothing_new),
        "limited_page": _q(w.limited_page),
        "changes_paged_all": _q(w.changes_paged_all),
        "expand_namespaces": _q(w.expand_namespaces_q),
        "stage_roundtrip": _q(w.stage_roundtrip),
        "ingest_raw": _q(w.ingest_raw),
        "ingest_mapped": _q(w.ingest_mapped),
        "custom_expression": _q(w.custom_expression),
        "dedup_batch": _q(w.dedup_batch),
        "latest_from_log": _q(w.latest_from_log),
        "upsert_latest": _q(w.upsert_latest),
        "upsert_latest_compacted": _q(w.upsert_latest_compacted),
        "log_compacted": _q(w.log_compacted),
        "staged_row_order": _q(w.staged_row_order),
        "full_sync_replace": _q(w.full_sync_replace),
        "full_sync_restart": _q(w.full_sync_restart),
        "entity_feed": _q(w.entity_feed),
        "convention_roundtrip": _q(w.convention_roundtrip),
        "log_since_read": _q(w.log_since_read),
        "stream_ingest": _q(w.stream_ingest),
        "stream_resized": _q(w.stream_resized),
        "full_sync_latest_off": _q(w.full_sync_latest_off),
        "log_since_event_time": _q(w.log_since_event_time),
        "ingest_rejects": _q(w.ingest_rejects),
        "catalog_convention": _q(w.catalog_convention),
        "upsert_latest_run": _q(w.upsert_latest_run),
    }


# --- oracle building blocks ------------------------------------------------------
B = "http://data.example/"
EV, US, CU, NA, OR, PA = B + "event/", B + "user/", B + "customer/", B + "nation/", B + "order/", B + "part/"


def _tok(expr: str) -> str:
    """URL-safe base64 of a text expression."""
    return f"replace(replace(to_base64(encode({expr})), '+', '-'), '/', '_')"


def _ts_lit(expr: str) -> str:
    return f"'''' || strftime({expr}, '%Y-%m-%dT%H:%M:%S.%f') || ''''"


K = "cast(json_extract_string(props, '$.k') as bigint)"
REC = "case when event_type <> 'signup' then epoch_us(ts) * 1000 end"
DEL = "case when event_type = 'error' then true end"
JSON_NUM = "case when {0} = floor({0}) then cast(cast({0} as bigint) as varchar) else cast({0} as varchar) end"
STREAM_FILE = "dense_rank() over (order by event_id // 2000) - 1"
L1, L2 = "cast(1700000000000000000 as bigint)", "cast(1700000100000000000 as bigint)"


def _events_log_cols(ident: str, dataset: str, recorded: str) -> str:
    return (
        f"{ident} as id, {recorded} as recorded, event_type = 'error' as deleted, '{dataset}' as dataset, "
        f"event_id, event_type, {K} as k, value, concat('{US}', user_id) as user_ref, "
        f"{REC} as rec, {DEL} as del, {ident} as ident"
    )


def _flat(id_expr: str, branches: list[tuple[str, str, str, str, str | None]], table: str) -> str:
    parts = []
    for kind, key, value, vtype, where in branches:
        cond = f" where {where}" if where else ""
        parts.append(
            f"select {id_expr} as id, '{kind}' as kind, '{key}' as key, {value} as value, '{vtype}' as value_type from {table}{cond}"
        )
    return "\nunion all\n".join(parts)


def _order_flat(with_priority: bool) -> str:
    br = [("prop", OR + "status", "o_orderstatus", "string", "o_orderstatus is not null")]
    if with_priority:
        br += [
            ("prop", OR + "priority", "o_orderpriority", "string", "o_orderpriority is not null"),
            ("prop", OR + "key", "cast(o_orderkey as varchar)", "number", None),
        ]
    br += [("ref", OR + "customer", f"concat('{CU}id/', o_custkey)", "string", "o_custkey is not null")]
    return _flat(f"concat('{OR}', o_orderkey)", br, "orders")


def _customer_flat() -> str:
    return _flat(
        f"concat('{CU}id/', c_custkey)",
        [
            ("prop", CU + "name", "replace(c_name, 'Customer#', '')", "string", "c_name is not null"),
            ("prop", CU + "segment", "c_mktsegment", "string", "c_mktsegment is not null"),
            ("prop", CU + "nationkey", "cast(c_nationkey as varchar)", "number", "c_nationkey is not null"),
            ("ref", CU + "nation", f"concat('{NA}', c_nationkey)", "string", "c_nationkey is not null"),
        ],
        "customer",
    )


_CUSTOMER_ROWS = (
    f"select concat('{CU}id/', c_custkey) as id, {L2} as recorded, false as deleted, 'customers' as dataset, "
    f"c_name as name, c_mktsegment as segment, concat('{NA}', c_nationkey) as nation from customer"
)


def _customers(tbl_rows: bool = True) -> str:
    return f"with c as ({_CUSTOMER_ROWS}) select *, 'log' as tbl from c union all select *, 'latest' as tbl from c"


def _two_level_latest(batch_expr: str, dataset: str, recorded: str) -> str:
    return f"""
with e as (select *, {REC} as rec_, {batch_expr} as b from events),
wb as (select * from e qualify row_number() over (partition by b, user_id order by rec_ desc nulls first, event_id desc) = 1),
x as (select * from wb qualify row_number() over (partition by user_id order by b desc) = 1)
select {_events_log_cols(f"concat('{US}', user_id)", dataset, recorded)} from x"""


def library_oracle_sql() -> dict[str, str]:
    win_from = "timestamp '2024-01-15 00:00:00'"
    return {
        "raw_entity_scan": f"""
select concat('{US}', user_id) as id, {REC} as recorded, false as deleted, event_id, event_type, {K} as k,
       concat('{US}', user_id) as user_ref
from events where event_type <> 'error'""",
        "mapped_entities": _customer_flat(),
        "map_all_entities": _flat(
            f"concat('{PA}id/', p_partkey)",
            [
                ("prop", PA + "p_partkey", "cast(p_partkey as varchar)", "number", None),
                ("prop", PA + "p_name", "p_name", "string", "p_name is not null"),
                ("prop", PA + "p_brand", "replace(p_brand, 'Brand#', '')", "string", "p_brand is not null"),
                ("prop", PA + "p_type", "p_type", "string", "p_type is not null"),
                ("prop", PA + "p_size", "cast(p_size as varchar)", "number", "p_size is not null"),
                ("prop", PA + "p_retailprice", "cast(p_retailprice as varchar)", "number", "p_retailprice is not null"),
                ("prop", PA + "size_text", "cast(p_size as varchar)", "string", "p_size is not null"),
                ("prop", PA + "kind", "coalesce(p_type, 'UNKNOWN')", "string", None),
                ("ref", PA + "brand", f"concat('{B}brand/', replace(p_brand, 'Brand#', ''))", "string", "p_brand is not null"),
            ],
            "part",
        ),
        "high_water_mark": f"""
select 'event_id' as since_column, '' as after, cast(max(event_id) as varchar) as literal,
       {_tok("cast(max(event_id) as varchar)")} as token from events
union all
select 'event_id', '5000', cast(max(event_id) as varchar), {_tok("cast(max(event_id) as varchar)")}
from events where event_id > 5000
union all
select 'ts', '', {_ts_lit("max(ts)")}, {_tok(_ts_lit("max(ts)"))} from events
union all
select 'ts', '2024-01-15T00:00:00.000000', {_ts_lit("max(ts)")}, {_tok(_ts_lit("max(ts)"))}
from events where ts > {win_from}""",
        "since_window": f"""
select concat('{EV}', event_id) as id,
       (select {_tok(_ts_lit("max(ts)"))} from events where ts > {win_from}) as token
from events where ts > {win_from} and ts <= (select max(ts) from events)""",
        "since_nothing_new": f"""
select count(*) as n_rows, (select {_tok(_ts_lit("max(ts)"))} from events) as token
from events where ts > (select max(ts) from events)""",
        "limited_page": f"""
with b as (select max(ts) as m from (select ts from events where ts > {win_from} order by ts limit 500))
select concat('{EV}', event_id) as id, (select {_tok(_ts_lit("m"))} from b) as token
from events where ts > {win_from} and ts <= (select m from b)""",
        "changes_paged_all": f"""
with d as (select o_orderdate as v, count(*) as c from orders where o_orderdate is not null group by 1),
r as (select v, cast(floor(coalesce(sum(c) over (order by v rows between unbounded preceding and 1 preceding), 0) / 5000) as bigint) as page from d),
p as (select v, page, max(v) over (partition by page) as m from r)
select concat('{OR}', o_orderkey) as id, page, {_tok(_ts_lit("m"))} as token from orders join p on o_orderdate = v""",
        "log_pages_by_load": f"""
select event_id, case when ts < timestamp '2024-01-16 00:00:00' then {_tok("'1700000000000000000'")} else {_tok("'1700000100000000000'")} end as token
from events""",
        "raw_entity_rejects": f"""
select concat('{US}', user_id) as id_text, 'malformed entity json' as reason from events where event_type = 'error'""",
        "catalog_scan": _customer_flat(),
        "null_defaults": _flat(
            f"concat('{PA}id/', p_partkey)",
            [
                ("prop", PA + "kind", "case when p_partkey % 3 <> 0 then p_type else 'unknown kind' end", "string", None),
                ("prop", PA + "size", "case when p_partkey % 4 <> 0 then cast(p_size as varchar) else '-1' end", "string", None),
                ("prop", PA + "name", "p_name", "string", "p_partkey % 5 <> 0"),
            ],
            "part",
        ),
        "record_expression": f"""
select concat('{US}', user_id) as id, cast(event_id as varchar) as event_id, cast(cast({K} as decimal(12,2)) as varchar) as k_price,
       event_type as kind, strftime(ts, '%Y-%m-%d %H:%M:%S') as at, concat('$1 ', event_type) as label from events""",
        "array_references": f"""
select concat('{CU}id/', c_custkey) as id,
       case when c_custkey % 2 = 0 then concat('["{NA}', c_nationkey, '","{CU}segment/', c_mktsegment, '"]') else concat('{NA}', c_nationkey) end as links,
       case when c_custkey % 2 = 0 then concat('{CU}segment/', c_mktsegment) end as second
from customer""",
        "newest_of_repeated_ids": _two_level_latest(
            "case when ts < timestamp '2024-01-16 00:00:00' then 1 else 2 end",
            "events_ties",
            f"case b when 1 then {L1} else {L2} end",
        ),
        "full_sync_same_id": _customers(),
        "stream_ingest_single": _two_level_latest(STREAM_FILE, "events_stream", "cast(1700001000000000000 + b as bigint)"),
        "expand_namespaces": _order_flat(True),
        "stage_roundtrip": _order_flat(False),
        "ingest_raw": f"""
select concat('{US}', user_id) as id, {L1} as recorded, event_type = 'error' as deleted, 'events_raw' as dataset,
       {REC} as entity_recorded, event_id, {K} as k, concat('{US}', user_id) as user_ref
from events""",
        "ingest_mapped": f"select {_events_log_cols(f'concat({chr(39)}{US}{chr(39)}, user_id)', 'events_mapped', L1)} from events",
        "custom_expression": f"""
select concat('{US}', user_id) as id, {L1} as recorded, event_type = 'error' as deleted, 'events_custom' as dataset,
       event_id, upper(event_type) as type_upper, {K} * 10 + 1 as k_scaled
from events""",
        "dedup_batch": f"""
select id, recorded, event_id from (
  select concat('{US}', user_id) as id, {REC} as recorded, event_id from events)
qualify row_number() over (partition by id order by recorded desc nulls first, event_id desc) = 1""",
        "latest_from_log": f"""
with l as (
  select *, {L1} as recorded_ from events where ts < timestamp '2024-01-20 00:00:00'
  union all
  select *, {L2} as recorded_ from events where ts >= timestamp '2024-01-10 00:00:00'),
x as (select * from l qualify row_number() over (partition by event_id order by recorded_ desc) = 1)
select {_events_log_cols(f"concat('{EV}', event_id)", 'events_log', 'recorded_')} from x where event_type <> 'error'""",
        "upsert_latest": _two_level_latest(
            "case when ts < timestamp '2024-01-16 00:00:00' then 1 else 2 end",
            "events_latest",
            f"case b when 1 then {L1} else {L2} end",
        ),
        "upsert_latest_compacted": _two_level_latest(
            "case when ts < timestamp '2024-01-16 00:00:00' then 1 else 2 end",
            "events_latest",
            f"case b when 1 then {L1} else {L2} end",
        ),
        "log_compacted": f"""
select {_events_log_cols(f"concat('{EV}', event_id)", 'events_weekly',
                         "cast(1700000000000000000 as bigint) + cast(floor(datediff('day', date '2024-01-01', cast(ts as date)) / 7) as bigint)")}
from events""",
        "staged_row_order": f"select concat('{OR}', o_orderkey) as id, cast(0 as bigint) as key_gap, true as within_cap, true as one_time from orders",
        "full_sync_replace": _customers(),
        "full_sync_restart": _customers(),
        "entity_feed": f"""
select 0 as section, '{{"id":"@context","namespaces":{{}}}}' as line, cast(0 as bigint) as position
union all
select 2, '{{"id":"@continuation","token":""}}', count(*) + 1 from customer
union all
select 1, concat('{{"id":"{CU}id/', c_custkey, '","refs":{{"{CU}nation":"{NA}', c_nationkey,
                 '"}},"props":{{"{CU}key":', c_custkey, ',"{CU}name":', to_json(c_name), '}}}}'),
       row_number() over (order by c_custkey)  -- the table stands in this order
from customer""",
        "convention_roundtrip": _flat(
            f"concat('{US}', user_id)",
            [
                ("prop", EV + "event_id", "cast(event_id as varchar)", "number", None),
                ("prop", EV + "type", "event_type", "string", "event_type is not null"),
                ("prop", EV + "k", f"cast({K} as varchar)", "number", f"{K} is not null"),
                # a JSON number keeps no int/float distinction: 27.0 is written 27
                ("prop", EV + "value", JSON_NUM.format("value"), "number", "value is not null"),
                ("ref", EV + "user", f"concat('{US}', user_id)", "string", None),
            ],
            "events",
        ),
        "log_since_read": f"""
select concat('{US}', user_id) as id, event_id, {_tok("'1700000000000000000'")} as after_token,
       {_tok("'1700000100000000000'")} as token
from events where ts >= timestamp '2024-01-16 00:00:00'""",
        "stream_ingest": _two_level_latest(STREAM_FILE, "events_stream", "cast(1700001000000000000 + b as bigint)"),
        "stream_resized": _two_level_latest(STREAM_FILE, "events_stream", "cast(1700001000000000000 + b as bigint)"),
        "log_since_event_time": f"""
select concat('{EV}', event_id) as id, (select {_tok(_ts_lit("max(ts)"))} from events) as token from events where ts > {win_from}""",
        "catalog_convention": f"""
select "by", concat('{US}', user_id) as id, {REC} as recorded, event_id from events, (values ('full name'), ('short name')) t("by")""",
        "ingest_rejects": f"""
with e as (select concat('{EV}', event_id) as id, {L1} as recorded, event_id, value as amount,
  concat_ws('; ', case when event_id % 5 = 0 then 'column amount is not double' end,
            case when event_type = 'signup' then 'required column own_time is null' end) as reason from events)
select 'rejects' as tbl, id, recorded, event_id, cast(null as double) as amount, reason from e where reason <> ''
union all select t.tbl, id, recorded, event_id, amount, null from e, (values ('log'), ('latest')) t(tbl) where reason = ''""",
        "upsert_latest_run": f"""
select {_events_log_cols(f"concat('{EV}', event_id)", 'events_run', f"case when ts >= timestamp '2024-01-28 00:00:00' then {L2} else {L1} end")} from events""",
        "full_sync_latest_off": f"""
with c as ({_CUSTOMER_ROWS}), n as (
  select concat('{NA}', n_nationkey) as id, {L1} as recorded, false as deleted, 'customers' as dataset,
         n_name as name, cast(null as varchar) as segment, cast(null as varchar) as nation from nation)
select *, 'log' as tbl from c
union all select * replace ({L1} as recorded), 'latest' as tbl from c
union all select *, 'latest' as tbl from n""",
    }
