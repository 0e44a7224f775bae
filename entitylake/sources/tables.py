"""Dataset resolution (S4) and table scans.

Naming rules: an explicit definition wins; otherwise ``a.b.c`` is
database / schema / table with raw column ``ENTITY``; otherwise ``.`` becomes
``_`` and the configured database and schema are prefixed.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from entitylake.model import RAW_ENTITY_COLUMN, DatasetDefinition, SourceConfig
from entitylake.operators.outgoing import decode_raw_entities, rows_to_entities


def resolve(
    name: str,
    definitions: dict[str, DatasetDefinition],
    database: str,
    schema: str,
) -> DatasetDefinition:
    """Definition for ``name`` (explicit, three-part convention, or implicit)."""
    if name in definitions:
        ds = definitions[name]
        sc = ds.source
        if not sc.path and not sc.table_name:
            sc = replace(sc, table_name=name.replace(".", "_"))
        if not sc.path and not sc.database:
            sc = replace(sc, database=database)
        if not sc.path and not sc.schema:
            sc = replace(sc, schema=schema)
        return replace(ds, source=sc)
    parts = name.split(".")
    if len(parts) == 3:
        if parts[0].upper() != database.upper() or parts[1].upper() != schema.upper():
            raise PermissionError(f"dataset {name!r} is outside the configured database and schema")
        return DatasetDefinition(
            name=name,
            source=SourceConfig(database=parts[0], schema=parts[1], table_name=parts[2], raw_column=RAW_ENTITY_COLUMN),
        )
    return DatasetDefinition(
        name=f"{database}.{schema}.{name}",
        source=SourceConfig(
            database=database, schema=schema, table_name=name.replace(".", "_"), raw_column=RAW_ENTITY_COLUMN
        ),
    )


def to_entities(
    rows: DataFrame, ds: DatasetDefinition, strict: bool = False, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame | None]:
    """S1 when a raw column is configured (it takes priority), else S2/S3 + P1-P7; ``keep`` columns stay beside the entity."""
    if ds.source.raw_column:
        return decode_raw_entities(rows, ds.source.raw_column, strict=strict, keep=keep)
    return rows_to_entities(rows, ds.outgoing, keep), None
