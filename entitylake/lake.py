"""The user-facing entry point: datasets by name, reads, writes, full syncs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.model import LATEST_SUFFIX, DatasetDefinition
from entitylake.plans.ingest import FullSync, compact, ingest_incremental
from entitylake.plans.read import EntityPage, all_pages, changes, footer_rows, newest_value, read_entities, resolve_column
from entitylake.functions.tokens import decode_token, typed_literal
from entitylake.operators.dedup import newest_from_log
from entitylake.sinks import fs
from entitylake.sinks.feed import write_feed
from entitylake.sinks.store import TableState, TableStore, largest_literal, normalise
from entitylake.sources.tables import resolve


def catalog_name(spark: SparkSession, database: str, schema: str, table: str) -> str:
    """Catalog name of a table outside the lake's folders: catalog.schema.table, else schema.table, else table."""
    parts = [p for p in (database, schema, table) if p]
    for k in range(len(parts)):
        name = ".".join(f"`{p}`" for p in parts[k:])
        try:
            if spark.catalog.tableExists(name):
                return name
        except AnalysisException:  # no such catalog or schema
            continue
    raise FileNotFoundError(f"no table {'.'.join(parts)} in the lake or the catalog")


class Lake:
    """Datasets stored under ``root`` (``<root>/<DATABASE>/<SCHEMA>/<TABLE>``)."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        database: str = "DB",
        schema: str = "PUBLIC",
        definitions: dict[str, DatasetDefinition] | None = None,
        latest_default: bool = False,
        buckets: int | None = None,
        delta_rows_max: int = 2_000_000,
        log_compact_batches: int = 256,
        broadcast_bytes_max: int | None = None,
    ):
        self.spark = spark
        self.database, self.schema = database, schema
        self.definitions = dict(definitions or {})
        self.latest_default = latest_default
        self.store = TableStore(spark, root, buckets, delta_rows_max, log_compact_batches)
        if broadcast_bytes_max is not None:
            self.store.broadcast_bytes_max = broadcast_bytes_max

    # -- definitions ----------------------------------------------------------
    def define(self, ds: DatasetDefinition) -> DatasetDefinition:
        self.definitions[ds.name] = ds
        return ds

    def dataset(self, name: str) -> DatasetDefinition:
        return resolve(name, self.definitions, self.database, self.schema)

    def latest_active(self, ds: DatasetDefinition) -> bool:
        """Dataset flag, else the lake-wide default."""
        return ds.source.latest_table if ds.source.latest_table is not None else self.latest_default

    # -- reading tables -------------------------------------------------------
    def _managed_log(self, ds: DatasetDefinition) -> str | None:
        """Location of the managed log a dataset reads, if it reads one."""
        sc = ds.source
        if sc.path or sc.catalog_table:
            return None
        loc = f"{self.store.root}/{normalise(sc.database)}/{normalise(sc.schema)}/{normalise(sc.table_name or ds.name)}"
        return loc if fs.exists(self.spark, f"{loc}/_manifest") else None

    def table(self, ds: DatasetDefinition, since: str = "") -> DataFrame:
        """Rows of the dataset's source table.

        For a managed log read after a token, batches whose since values all lie
        at or before the token are pruned through the manifest.
        """
        sc = ds.source
        if sc.path:
            return self.spark.read.parquet(sc.path)
        if sc.catalog_table:
            return self.spark.table(sc.catalog_table)
        name = normalise(sc.table_name or ds.name)
        base = f"{self.store.root}/{normalise(sc.database)}/{normalise(sc.schema)}"
        if name.endswith(LATEST_SUFFIX) and fs.exists(self.spark, f"{base}/{name[: -len(LATEST_SUFFIX)]}/_manifest"):
            return self.store.read_latest(f"{base}/{name[: -len(LATEST_SUFFIX)]}")
        if (loc := self._managed_log(ds)) is not None:
            after = decode_token(since) if sc.since_column else None
            return self.store.read_log(loc, since=None if after is None else (sc.since_column, after))
        if fs.exists(self.spark, f"{base}/{name}"):
            return self.spark.read.parquet(f"{base}/{name}")
        return self.spark.table(catalog_name(self.spark, sc.database, sc.schema, sc.table_name or ds.name))

    def newest_of(self, ds: DatasetDefinition, rows: DataFrame) -> DataFrame | None:
        """One row ``_m``, the MAX of the dataset's since column without opening a data file, where that can be had:
        from a managed log's manifest, or from the footers of the files at a path."""
        column = ds.source.since_column
        if not column:
            return None
        if ds.source.path:
            footers = footer_rows(self.spark, ds.source.path, column)
            return None if footers is None else newest_value(footers, column)
        if (loc := self._managed_log(ds)) is None or (st := self.store.state(loc)) is None:
            return None
        known, literal = largest_literal(st, column)
        dtype = resolve_column(rows, column).dataType
        bound = F.lit(None).cast(dtype) if literal is None else typed_literal(literal, dtype)
        return self.spark.range(1).select(bound.alias("_m")) if known else None

    def entities(self, name: str, since: str = "", limit: int = 0) -> EntityPage:
        ds = self.dataset(name)
        rows = self.table(ds, since)
        return read_entities(rows, ds, since, limit, None if limit else self.newest_of(ds, rows))

    def changes(self, name: str, since: str = "", limit: int = 0, latest_only: bool = False) -> EntityPage:
        ds = self.dataset(name)
        rows = self.table(ds, since)
        return changes(rows, ds, since, limit, latest_only, None if limit else self.newest_of(ds, rows))

    def ordered_table(self, ds: DatasetDefinition, since: str = "") -> tuple[DataFrame, tuple[str, ...]]:
        """The source table with columns that give its natural order (none for a view or a latest table).

        Files of a path are ordered by name and their rows as they stand; rows of a
        managed log by load, then arrival, so an entity's newest version comes last.
        """
        if (loc := self._managed_log(ds)) is not None:
            after = decode_token(since) if since and ds.source.since_column else None
            rows = self.store.read_log(loc, since=None if after is None else (ds.source.since_column, after), ordered=True)
            own = [f"`{f.name}`" for f in self.store.state(loc).schema]
            rank = [F.col("recorded"), F.coalesce("_erec", F.lit(2**63 - 1)), F.col("_arrival")]  # as newest_from_log ranks
            return rows.select(*own, *[c.alias(f"_order{k}") for k, c in enumerate(rank)]), ("_order0", "_order1", "_order2")
        rows = self.table(ds, since)
        if not ds.source.path:
            return rows, ()
        place = [F.col("_metadata.file_path").alias("_order0"), F.col("_metadata.row_index").alias("_order1")]
        return rows.select("*", *place), ("_order0", "_order1")

    def feed(self, name: str, path: str, since: str = "", limit: int = 0) -> str:
        """K5: write the entities after ``since`` as a feed in the table's natural order; the next token."""
        ds = self.dataset(name)
        rows, order = self.ordered_table(ds, since)
        page = read_entities(rows, ds, since, limit, None if limit else self.newest_of(ds, rows), keep=order)
        write_feed(page.entities, page.token, path, order)
        return page.token

    def all_pages(self, name: str, page_rows: int, since: str = "") -> DataFrame:
        """Every page of a feed after ``since`` in one frame: entities with ``page`` and its ``token``."""
        ds = self.dataset(name)
        return all_pages(self.table(ds, since), ds, page_rows, since)

    # -- writing --------------------------------------------------------------
    def _write_ds(self, name: str) -> DatasetDefinition:
        ds = self.dataset(name)
        if ds.source.path or ds.source.catalog_table:
            raise ValueError("path and catalog sources are read-only")
        return ds

    def write_incremental(
        self,
        name: str,
        entities: DataFrame,
        load_ns: int | Column,
        batch_key: str,
        order_by: tuple[str, ...] | None = None,
        stage: bool = True,
        rising: bool = False,
        strict: bool = True,
        known: TableState | None = None,
        written: tuple[dict, dict] | None = None,
    ) -> TableState:
        """I4; not ``strict``: rows that cannot be loaded go to ``rejects`` instead of failing the batch."""
        ds = self._write_ds(name)
        return ingest_incremental(
            self.store, ds, entities, load_ns, batch_key, self.latest_active(ds), order_by, stage, rising, strict, known, written
        )

    def full_sync(self, name: str, sync_id: str, strict: bool = True) -> FullSync:
        ds = self._write_ds(name)
        return FullSync(self.store, ds, sync_id, self.latest_active(ds), strict)

    def rejects(self, name: str) -> DataFrame:
        """Rows that could not be loaded: id, recorded (load time), reason, raw."""
        return self.store.read_rejects(self.store.location(self.dataset(name)))

    def compact(self, name: str) -> TableState | None:
        """Fold pending latest-table deltas into the base buckets."""
        return compact(self.store, self._write_ds(name))

    def vacuum(self, name: str, keep_versions: int = 10, older_than_s: float = 7 * 86400) -> list[str]:
        """Delete superseded data directories and old manifests of a dataset."""
        return self.store.vacuum(self.store.location(self.dataset(name)), keep_versions, older_than_s)

    def log(self, name: str) -> DataFrame:
        return self.store.read_log(self.store.location(self.dataset(name)))

    def newest(self, name: str, live_only: bool = False) -> DataFrame:
        """Newest row per id of the log, by the rule that also fills the latest table."""
        return newest_from_log(self.store.read_log(self.store.location(self.dataset(name)), ordered=True), live_only)

    def latest(self, name: str) -> DataFrame:
        return self.store.read_latest(self.store.location(self.dataset(name)))

    def state(self, name: str) -> TableState | None:
        return self.store.state(self.store.location(self.dataset(name)))

    def schema_of(self, name: str) -> T.StructType | None:
        st = self.state(name)
        return st.schema if st else None
