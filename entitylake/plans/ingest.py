"""Incremental ingest (I4) and full sync.

Incremental: batch -> stage (K1) -> staged scan (S6/S7) -> log append (K3)
-> newest per id (W1) written as a latest-table delta -> one manifest commit.
A stream's micro-batch writes its rows once: its folder of the log is its delta,
and W1 runs when the pending ones are read or folded.  The folders of coming micro-batches
can be written before their turn, many in one job (``write_ahead``); no state names one
until its own micro-batch commits it.
Deltas are applied on read (J1, merge-on-read) until their rows exceed the
store's bound; then they are folded into the bucketed run beside the base, now
and then into the base itself, in the same commit.  A batch is keyed: replaying a key that
was ever loaded is a no-op.  Every attempt writes to directories of its own, so
a retry (task, job or ``foreachBatch`` replay) never touches what a committed
state names.

Full sync: ``start`` opens a fresh stage for the sync id (voiding whatever was
open), ``add`` stages batches, ``commit`` builds a fresh log and latest table
from that stage alone and switches both with one manifest commit (K4).
"""

from __future__ import annotations

import logging
import time
import uuid
from contextlib import contextmanager
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from entitylake.functions.tokens import literal_for, value_text
from entitylake.model import ENTITY_COLUMN, DatasetDefinition
from entitylake.operators.dedup import newest_per_id
from entitylake.operators.incoming import entities_to_rows, table_schema
from entitylake.operators.outgoing import entity_json
from entitylake.operators.upsert import fold_deltas
from entitylake.sinks import fs
from entitylake.sinks.stage import write_stage
from entitylake.sinks.store import CommitConflict, LoadOrderConflict, TableState, TableStore, joined_ranges, newest_load, ranged_fields
from entitylake.sources.entity_files import STAGE_ORDER, read_stage

RUN_SHARE = 4  # a run and deltas of more than 1/RUN_SHARE of the base's bytes are folded into it
MAX_DELTAS = 64  # pending latest deltas before a compaction, bounds the read-side union
COMMIT_ATTEMPTS = 5
log = logging.getLogger("entitylake.ingest")


@contextmanager
def _step(name: str):
    t0 = time.perf_counter()
    yield
    log.info("%s %.3fs", name, time.perf_counter() - t0)


def _attempt() -> str:
    return uuid.uuid4().hex[:12]


@lru_cache(maxsize=1)
def _erec() -> Column:
    return F.try_variant_get(F.col(ENTITY_COLUMN), "$.recorded", "bigint")


def _own_recorded(staged: DataFrame) -> DataFrame:
    return staged.withColumn("_erec", _erec())


def _staged_rows(store: TableStore, ds: DatasetDefinition, stage: str, load_ns: int, strict: bool) -> DataFrame:
    return entities_to_rows(_own_recorded(read_stage(store.spark, stage)), ds, load_ns, ("_erec", *STAGE_ORDER), strict)


def _direct_rows(ds: DatasetDefinition, entities: DataFrame, load_ns: int | Column, arrival: tuple[str, ...], strict: bool) -> DataFrame:
    """Rows straight from an entity frame whose source is already durable.

    The entity goes through the same JSON form the stage would hold, so the
    mapping sees exactly what a staged load sees.
    """
    load = load_ns if isinstance(load_ns, Column) else F.lit(int(load_ns))
    entity = F.parse_json(entity_json(entities)).alias(ENTITY_COLUMN)
    staged = entities.select(entity, load.cast("bigint").alias("_load"), *_direct_order(*arrival))
    return entities_to_rows(_own_recorded(staged), ds, F.col("_load"), ("_erec", *STAGE_ORDER), strict)


@lru_cache(maxsize=16)
def _direct_order(f: str, pos: str) -> tuple[Column, ...]:
    """``STAGE_ORDER`` of rows that no stage holds, from file and position: built once, a stream needs it for every batch."""
    return (
        F.col(f).cast("string").alias("_dir"),
        F.lit(0).cast("bigint").alias("_part"),
        F.lit(0).cast("bigint").alias("_roll"),
        F.lit(0).cast("bigint").alias("_blk"),
        F.col(pos).cast("bigint").alias("_ix"),
        F.lit(0).alias("_elem"),
    )


def _log_columns(cols: list[str]) -> list:
    return [*cols, F.col("_erec"), F.struct(*STAGE_ORDER).alias("_arrival")]


@lru_cache(maxsize=64)
def _log_projection(schema: StructType, strict: bool) -> tuple[Column, list[Column], list[Column]]:
    """Which rows are good, the log's columns, and what is measured of the good rows; built once for a table."""
    good = F.lit(True) if strict else F.col("_reason").isNull()
    measures = [F.count_if(good).alias("rows"), F.count_if(~good).alias("rejected")]
    measures.append(F.coalesce(F.sum(F.when(good, F.octet_length("id"))), F.lit(0)).alias("id_bytes"))
    for k, f in enumerate([schema["recorded"], *ranged_fields(schema)]):
        value = F.when(good, F.col(f"`{f.name}`"))
        measures += [value_text(F.min(value), f.dataType).alias(f"lo{k}"), value_text(F.max(value), f.dataType).alias(f"hi{k}")]
    return good, [F.col(f"`{f.name}`") for f in schema] + _log_columns([]), measures


def _log_fields(schema: StructType, path: str, got: dict) -> dict:
    """Fields of the log entry of a folder, from what was measured of its good rows."""
    ranged = enumerate(ranged_fields(schema), 1)
    entry = {"path": path, "ranges": {f.name: [x if x is None else literal_for(x) for x in (got[f"lo{k}"], got[f"hi{k}"])] for k, f in ranged}}
    if got["rows"]:
        entry["load_ns_max"] = int(got["hi0"])
    return entry


def _write_log(store: TableStore, rows: DataFrame, schema: StructType, path: str, key: str, strict: bool) -> tuple[dict, dict, dict | None]:
    """K3 in one pass: what was seen, fields of the log entry, and the entry of the rejects, if there are any.

    Row counts and the range of each column that since-reads can be pruned by
    ride along with the write.  Not strict: good and rejected rows are two
    folders of the same write.
    """
    seen = Observation(f"log-{_attempt()}")
    good, cols, measures = _log_projection(schema, strict)
    if strict:
        rows.select(*cols).observe(seen, *measures).write.parquet(path)
    else:
        parted = rows.select(*cols, "_reason", "_raw", (~good).alias("_rejected"))
        parted.observe(seen, *measures).write.partitionBy("_rejected").parquet(path)
    got = seen.get
    entry = _log_fields(schema, path if strict else f"{path}/_rejected=false", got)
    rejects = {"key": key, "path": f"{path}/_rejected=true", "rows": got["rejected"]} if got["rejected"] else None
    return got, entry, rejects


def write_ahead(
    store: TableStore, ds: DatasetDefinition, path: str, entities: DataFrame, load: Column, arrival: tuple[str, str], first: int, per_batch: int
) -> dict[int, tuple[dict, dict]]:
    """Write the rows of coming micro-batches below ``path`` in one job, a folder each; what was seen of each and fields of its log entry.

    A micro-batch has the rows of ``per_batch`` load numbers, the first of all being ``first``; one without rows is left out.
    """
    schema = table_schema(ds)
    rows = _direct_rows(ds, entities, load, arrival, True)
    _, cols, measures = _log_projection(schema, True)
    rows.select(*cols, F.expr(f"(recorded - {int(first)}L) div {int(per_batch)}L").alias("_ahead")).write.partitionBy("_ahead").parquet(path)
    written = store.spark.read.schema(StructType([*schema.fields, StructField("_ahead", LongType())])).parquet(path)
    seen = {r["_ahead"]: r.asDict() for r in written.groupBy("_ahead").agg(*measures).collect()}  # a row for each micro-batch
    if None in seen:
        raise ValueError(f"rows without a load number below {path}")
    return {k: (got, _log_fields(schema, f"{path}/_ahead={k}", got)) for k, got in seen.items()}


def ingest_incremental(
    store: TableStore,
    ds: DatasetDefinition,
    entities: DataFrame,
    load_ns: int | Column,
    batch_key: str,
    latest: bool = False,
    order_by: tuple[str, ...] | None = None,
    stage: bool = True,
    rising: bool = False,
    strict: bool = True,
    known: TableState | None = None,
    written: tuple[dict, dict] | None = None,
) -> TableState:
    """I4: load one batch of entities into the log (and latest) table.

    ``stage=False`` skips K1/S6 for sources that are durable and replayable on
    their own (streaming landing files); ``order_by`` must then name the
    (file, position) arrival columns, and ``load_ns`` may be a column: the load
    time of each row's request.  ``rising`` demands load numbers above every one
    that is committed when this batch is; otherwise ``LoadOrderConflict``.  Not
    ``strict``: rows that cannot be loaded go to the table's rejects (D15)
    instead of failing the batch.  ``known`` is a state the caller has just read,
    which saves reading it again: one that is superseded by now fails to commit
    and is read anew, as after any other writer's commit.  ``written``: the batch's
    rows stand in a folder of their own already (``write_ahead``), ``entities`` is not read.
    """
    spark = store.spark
    loc = store.location(ds)
    schema = table_schema(ds)
    st = store.open(loc, schema, latest, known)
    if store.loaded(loc, st, batch_key):
        return st  # committed before: replay is a no-op
    attempt = f"{batch_key}-{_attempt()}"
    entry = {"key": batch_key, "path": f"{loc}/log/{attempt}", "level": 0}
    if written is not None:
        rows = None
    elif stage:
        entry["stage"] = f"{loc}/_stage/inc/{attempt}"
        with _step("stage"):  # arrival only matters where the newest of an id is chosen
            write_stage(entities, entry["stage"], order_by=order_by)  # K1
        rows = _staged_rows(store, ds, entry["stage"], load_ns, strict)
    else:
        if not order_by or len(order_by) != 2:
            raise ValueError("an unstaged batch needs (file, position) arrival columns")
        rows = _direct_rows(ds, entities, load_ns, tuple(order_by), strict)
    cols = [f.name for f in schema]
    with _step("log"):
        seen, fields, rejects = (*written, None) if rows is None else _write_log(store, rows, schema, entry["path"], batch_key, strict)
    entry |= fields
    if not seen["rows"] and not rejects:  # empty batch loads nothing
        return st
    delta_entry = None
    if st.latest and seen["rows"] and rising:
        # the batch's folder of the log is the delta: W1 runs once, where pending deltas are read or folded together
        delta_entry = {"key": batch_key, "path": entry["path"], "rows": seen["rows"], "id_bytes": int(seen["id_bytes"]), "in_log": True}
        delta_entry["bytes"] = fs.size_of(spark, entry["path"])
    elif st.latest and seen["rows"]:
        delta_path = f"{loc}/latest/deltas/{attempt}"
        sized = Observation(f"delta-{attempt}")  # rows and id bytes bound the read-side broadcast
        size_cols = (F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("id")), F.lit(0)).alias("id_bytes"))
        with _step("delta"):  # W1 over the log files just written: no second parse of the batch
            source = store.read_ordered(schema, [entry["path"]])
            newest = newest_per_id(source, "_erec", ("_arrival",), load="recorded").select(*cols)
            newest.observe(sized, *size_cols).write.parquet(delta_path)
        delta_entry = {"key": batch_key, "path": delta_path, "rows": int(sized.get["rows"]), "id_bytes": int(sized.get["id_bytes"]), "bytes": fs.size_of(spark, delta_path)}
    for _ in range(COMMIT_ATTEMPTS):
        if rising and seen["rows"] and (newest := st.newest_load()) is not None and newest >= int(seen["lo0"]):
            raise LoadOrderConflict(f"batch {batch_key} of {loc} starts at {seen['lo0']}, {newest} is committed")
        new = replace(st, version=st.version + 1, dropped=[], load_max=st.newest_load())
        new.log = [*st.log, *([entry] if seen["rows"] else [])]
        new.rejects = [*st.rejects, *([rejects] if rejects else [])]
        if delta_entry is not None:
            seq = max([d["seq"] for d in st.deltas], default=0) + 1
            new.deltas = [*st.deltas, {**delta_entry, "seq": seq}]
        if store.needs_compaction(new, MAX_DELTAS):
            new = _compacted(store, loc, new)
        new = _log_compacted(store, loc, new, batch_key)
        try:
            done = store.commit(loc, new)
            store.mark_loaded(loc, [batch_key])
            return done
        except CommitConflict:
            # another writer committed first: our directories are our own, so
            # re-apply the entries on top of the newer state
            st = store.open(loc, schema, latest)
            if store.loaded(loc, st, batch_key):
                return st
    raise CommitConflict(f"gave up committing batch {batch_key} of {loc} after {COMMIT_ATTEMPTS} attempts")


def _log_compacted(store: TableStore, loc: str, st: TableState, batch_key: str) -> TableState:
    """Merge log directories of one level into a segment of the next, once there are enough of them.

    Rows are rewritten as they are, with their order columns; small files are
    packed by the scan's split planning.  A row is rewritten once per level.
    """
    for level in range(64):
        same = [b for b in st.log if b.get("level", 0) == level]
        if len(same) < store.log_compact_batches:
            return st
        seg = f"{loc}/log/seg-{_attempt()}"
        store.mark_loaded(loc, {b["key"] for b in same if not level} - {batch_key})
        with _step("log-compact"):
            ordered = store.read_log(loc, replace(st, log=same), ordered=True)
            ordered.write.parquet(seg)
        loads = [newest_load(b) for b in same]
        load_max = None if any(x is None for x in loads) else max(loads)  # lets since-reads skip the segment
        entry = {"key": seg.rpartition("/")[2], "path": seg, "load_ns_max": load_max, "level": level + 1, "ranges": joined_ranges(st.schema, same)}
        st = replace(st, log=[*[b for b in st.log if b not in same], entry], dropped=[*st.dropped, *[b["path"] for b in same]])
    return st


def _compacted(store: TableStore, loc: str, st: TableState, whole: bool = False) -> TableState:
    """Fold pending deltas into the run, or run and deltas into a new base once they pass a share of it (or ``whole``).

    So a row of the base is rewritten once for some 1/RUN_SHARE of the base that
    changed, not for every set of deltas that a read can broadcast.  Only delta
    rows are shuffled.  The first base of a table fixes its bucket count; a base
    that has outgrown it by far is dealt to more buckets.
    """
    if not st.deltas and not (whole and st.run):
        return st
    new_bytes = sum(d["bytes"] if "bytes" in d else fs.size_of(store.spark, d["path"]) for d in st.deltas)
    changed = new_bytes + (st.run["bytes"] if st.run else 0)
    total = changed + (st.base["bytes"] if st.base else 0)
    dropped = [*st.dropped, *[d["path"] for d in st.deltas if not d.get("in_log")]]
    buckets, wanted = st.buckets, store.bucket_count(total)
    if st.base is None:
        buckets = wanted

    def folded(rows: DataFrame | None) -> DataFrame:
        return fold_deltas(rows, store.read_deltas(st), buckets, store.can_broadcast(st)) if st.deltas else rows

    with _step("compact"):
        if st.base is not None and not whole and changed * RUN_SHARE <= st.base["bytes"]:
            run = store.write_bucketed(folded(store.read_run(st)), f"{loc}/latest/run-{_attempt()}", buckets)
            return replace(st, run=run, deltas=[], dropped=dropped)
        rows = folded(store.read_compacted(st))
        if "paths" in (st.base or {}) or wanted >= 4 * buckets:
            buckets, rows = wanted, rows.repartition(wanted, "id")
        base = store.write_bucketed(rows, f"{loc}/latest/base-{_attempt()}", buckets)
    return replace(st, base=base, run=None, buckets=buckets, deltas=[], dropped=dropped)


def compact(store: TableStore, ds: DatasetDefinition) -> TableState | None:
    """Compact the latest table now: everything into a new base (one manifest commit)."""
    loc = store.location(ds)
    st = store.state(loc)
    if st is None or not (st.deltas or st.run):
        return st
    return store.commit(loc, _compacted(store, loc, replace(st, version=st.version + 1, dropped=[]), whole=True))


class FullSync:
    """A multi-batch replacement of a dataset's log and latest tables.

    Each ``start`` is an attempt with a stage and target directories of its
    own, named in the manifest; using a sync id again starts from nothing.
    """

    def __init__(self, store: TableStore, ds: DatasetDefinition, sync_id: str, latest: bool = False, strict: bool = True):
        if not sync_id:
            raise ValueError("a full sync needs a sync id")  # D13
        self.store, self.ds, self.latest, self.strict = store, ds, latest, strict
        self.sync_id = sync_id.replace("-", "_")
        self.loc = store.location(ds)
        self.schema = table_schema(ds)
        self.attempt: str | None = None  # set by ``start``; another object may go on with an open sync

    def start(self) -> TableState:
        """Open the sync; whatever sync of the dataset is unfinished becomes void."""
        sync = {"id": self.sync_id, "attempt": f"{self.sync_id}-{_attempt()}"}
        for _ in range(COMMIT_ATTEMPTS):
            st = self.store.open(self.loc, self.schema, self.latest)
            try:
                done = self.store.commit(self.loc, replace(st, version=st.version + 1, sync=sync, dropped=[]))
                self.attempt = sync["attempt"]
                return done
            except CommitConflict:
                continue
        raise CommitConflict(f"gave up opening sync {self.sync_id} of {self.loc}")

    def _check_open(self) -> TableState:
        st = self.store.state(self.loc)
        if st is None or not st.sync or st.sync.get("id") != self.sync_id:
            raise RuntimeError(f"full sync {self.sync_id} is not open for {self.ds.name}")
        st.latest = self.latest
        return st

    def _stage(self, st: TableState) -> str:
        return f"{self.loc}/_stage/fs/{st.sync['attempt']}"

    def add(self, entities: DataFrame, seq: int | None = None, order_by: tuple[str, ...] | None = None) -> str:
        """Stage one batch of the sync (a retried ``seq`` overwrites itself)."""
        stage = self._stage(self._check_open())
        if seq is None:
            seq = len([n for n in fs.list_names(self.store.spark, stage) if n.isdigit()])
        path = f"{stage}/{seq:08d}"
        write_stage(entities, path, order_by=order_by)
        return path

    def _build(self, st: TableState, load_ns: int) -> TableState:
        """Log and latest of this attempt's stage, in new directories."""
        spark, stage = self.store.spark, self._stage(st)
        kept = {} if not st.latest else {"base": None, "run": None, "deltas": []}  # latest off: that table stays as it is
        done = {"sync": None, "synced": st.sync["attempt"], "dropped": [], "load_max": st.newest_load(), "rejects": []}
        if not any(b.isdigit() for b in fs.list_names(spark, stage)):
            return replace(st, log=[], **kept, **done)
        cols = [f.name for f in self.schema]
        base, key = f"{self.loc}/fs/{st.sync['attempt']}-{_attempt()}", f"fs-{st.sync['attempt']}"
        rows = _staged_rows(self.store, self.ds, stage, load_ns, self.strict)
        seen, fields, rejects = _write_log(self.store, rows, self.schema, f"{base}/log", key, self.strict)
        done["rejects"] = [rejects] if rejects else []
        if not seen["rows"]:
            return replace(st, log=[], **kept, **done)
        log_path = fields["path"]
        if st.latest:
            buckets = self.store.bucket_count(fs.size_of(spark, log_path))
            # at most one row per id and task is shuffled to choose the newest, then each once to its bucket
            newest = newest_per_id(self.store.read_ordered(self.schema, [log_path]), "_erec", ("_arrival",)).select(*cols)
            kept["base"] = self.store.write_bucketed(newest.repartition(buckets, "id"), f"{base}/latest", buckets)
            kept["buckets"] = buckets
        entry = {"key": key, **fields, "load_ns_max": int(load_ns), "level": 1}
        return replace(st, log=[entry], **kept, **done)

    def commit(self, load_ns: int) -> TableState:
        """Build log + latest from this sync alone and switch both at once (K4).

        The table holds this sync's rows only, also when batches were loaded
        meanwhile: a concurrent commit makes the switch repeat on the newer
        state, not the build.  Keys of replaced batches stay marked as loaded.
        With latest off the latest table stays as it is, whatever it holds by
        then.  A commit that is repeated after it succeeded returns the state.
        """
        if (st := self._committed()) is not None:
            return st
        st = self._check_open()
        built = self._build(st, load_ns)
        attempt = st.sync["attempt"]
        for _ in range(COMMIT_ATTEMPTS):
            self.store.mark_loaded(self.loc, st.keys())
            new = replace(built, version=st.version + 1, load_max=st.newest_load())
            if not st.latest:
                new = replace(new, base=st.base, run=st.run, deltas=st.deltas, buckets=st.buckets)
            try:
                return self.store.commit(self.loc, new)
            except CommitConflict:
                if (done := self._committed(attempt)) is not None:  # ours, and its answer was lost
                    return done
                st = self._check_open()
                if st.sync["attempt"] != attempt:
                    raise RuntimeError(f"full sync {self.sync_id} of {self.ds.name} was started again") from None
        raise CommitConflict(f"gave up committing sync {self.sync_id} of {self.loc}")

    def _committed(self, attempt: str | None = None) -> TableState | None:
        """The state, when this attempt (else the last one of this sync id) is the sync that was committed last."""
        st = self.store.state(self.loc)
        if st is None or not st.synced or (st.sync or {}).get("id") == self.sync_id:
            return None
        attempt = attempt or self.attempt
        mine = st.synced == attempt if attempt else st.synced.rpartition("-")[0] == self.sync_id
        return st if mine else None
