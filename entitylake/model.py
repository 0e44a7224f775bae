"""Data model: dataset definitions, mappings, the entity frame and type aliases.

A dataset definition names a table (``source_config``), how rows become
entities (``outgoing_mapping_config``, read side) and how entities become rows
(``incoming_mapping_config``, write side).  Definitions are frozen dataclasses
parsed from the same JSON layout the service configuration uses.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

# --- fixed values: system columns of log and latest tables -------------------
SYSTEM_COLUMNS = ("id", "recorded", "deleted", "dataset")
RAW_ENTITY_COLUMN = "ENTITY"  # convention read: raw JSON column name
ENTITY_COLUMN = "entity"  # convention write: whole entity as one variant column
LATEST_SUFFIX = "_LATEST"
ENTITIES_PER_FILE = 50_000  # staged entities per file
CONTEXT_ID = "@context"
CONTINUATION_ID = "@continuation"

# The canonical in-memory entity frame.  refs/props are variant objects.
ENTITY_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("recorded", T.LongType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("refs", T.VariantType()),
        T.StructField("props", T.VariantType()),
    ]
)


# --- fixed values: warehouse type names accepted in mappings -> Spark DDL -----
TYPE_ALIASES = {
    "": "string",
    "string": "string",
    "varchar": "string",
    "text": "string",
    "char": "string",
    "integer": "bigint",
    "int": "bigint",
    "bigint": "bigint",
    "number": "bigint",
    "long": "bigint",
    "smallint": "bigint",
    "boolean": "boolean",
    "bool": "boolean",
    "float": "double",
    "double": "double",
    "real": "double",
    "variant": "variant",
    "object": "variant",
    "array": "variant",
    "timestamp": "timestamp",
    "timestamp_ltz": "timestamp",
    "timestamp_tz": "timestamp",
    "timestamp_ntz": "timestamp_ntz",
    "datetime": "timestamp_ntz",
    "date": "date",
    "time": "string",
    "binary": "binary",
    "varbinary": "binary",
    "decimal": "decimal(38,0)",
    "numeric": "decimal(38,0)",
}
DECIMAL_NAMES = ("number", "decimal", "numeric")


_TYPE_NAME = re.compile(r"([a-z_ ]+?)\s*(?:\(\s*([0-9]+)\s*(?:,\s*([0-9]+)\s*)?\))?")


def spark_type(name: str | None) -> str:
    """Map a configured datatype to a Spark DDL type.

    A length or a time precision is accepted and not enforced; a number with
    a precision keeps its scale.  Any other name must be a Spark type.
    """
    key = (name or "").strip().lower()
    m = _TYPE_NAME.fullmatch(key)
    base, precision, scale = (m[1], m[2], m[3]) if m else (key, None, None)
    if base in DECIMAL_NAMES and precision:
        if not 1 <= int(precision) <= 38 or int(scale or 0) > int(precision):
            raise ValueError(f"unsupported datatype {name!r}")
        return f"decimal({precision},{scale or 0})"
    if base in TYPE_ALIASES:
        return TYPE_ALIASES[base]
    try:
        T._parse_datatype_string(key)  # a type that only Spark knows
    except Exception as exc:  # noqa: BLE001 - the parser's error types differ by client
        raise ValueError(f"unsupported datatype {name!r}") from exc
    return key


@dataclass(frozen=True)
class Construction:
    """A derived value that overrides the same-named column before mapping."""

    property: str
    operation: str
    args: tuple[str, ...]

    def __post_init__(self) -> None:
        if self.operation != "replace":
            raise ValueError(f"unsupported construction operation {self.operation!r}")
        if len(self.args) != 3:
            raise ValueError("replace takes (source column, old, new)")


@dataclass(frozen=True)
class OutgoingPropertyMapping:
    """Column -> entity property / reference / identity (read side)."""

    property: str
    entity_property: str = ""
    datatype: str = ""
    is_reference: bool = False
    is_identity: bool = False
    uri_value_pattern: str = ""
    required: bool = False
    default_value: Any = None


@dataclass(frozen=True)
class OutgoingMapping:
    base_uri: str = ""
    constructions: tuple[Construction, ...] = ()
    property_mappings: tuple[OutgoingPropertyMapping, ...] = ()
    map_all: bool = False


@dataclass(frozen=True)
class IncomingPropertyMapping:
    """Entity property -> column (write side)."""

    property: str
    entity_property: str = ""
    datatype: str = ""
    is_reference: bool = False
    is_identity: bool = False
    is_deleted: bool = False
    is_recorded: bool = False
    required: bool = False
    custom_expression: str | None = None


@dataclass(frozen=True)
class IncomingMapping:
    # base_uri / map_named are accepted and ignored: keys are full URIs.
    base_uri: str = ""
    property_mappings: tuple[IncomingPropertyMapping, ...] = ()


@dataclass(frozen=True)
class SourceConfig:
    table_name: str = ""
    schema: str = ""
    database: str = ""
    raw_column: str | None = None
    since_column: str | None = None
    latest_table: bool | None = None
    path: str | None = None  # explicit location of a plain Parquet source
    catalog_table: str | None = None  # any table the session's catalog knows


@dataclass(frozen=True)
class DatasetDefinition:
    name: str
    source: SourceConfig = field(default_factory=SourceConfig)
    incoming: IncomingMapping | None = None
    outgoing: OutgoingMapping | None = None

    def column_mappings(self) -> tuple[IncomingPropertyMapping, ...]:
        return self.incoming.property_mappings if self.incoming else ()


def _b(v: Any) -> bool:
    return bool(v) if v is not None else False


def _outgoing(d: dict | None) -> OutgoingMapping | None:
    if d is None:
        return None
    cons = tuple(
        Construction(c["property"], c.get("operation", ""), tuple(c.get("args", ())))
        for c in d.get("constructions") or ()
    )
    pms = tuple(
        OutgoingPropertyMapping(
            property=p.get("property", ""),
            entity_property=p.get("entity_property", "") or "",
            datatype=p.get("datatype", "") or "",
            is_reference=_b(p.get("is_reference")),
            is_identity=_b(p.get("is_identity")),
            uri_value_pattern=p.get("uri_value_pattern", "") or "",
            required=_b(p.get("required")),
            default_value=p.get("default_value"),
        )
        for p in d.get("property_mappings") or ()
    )
    return OutgoingMapping(d.get("base_uri", "") or "", cons, pms, _b(d.get("map_all")))


def _incoming(d: dict | None) -> IncomingMapping | None:
    if d is None:
        return None
    pms = []
    for p in d.get("property_mappings") or ():
        custom = p.get("custom") or p.get("Custom") or {}
        pms.append(
            IncomingPropertyMapping(
                property=p.get("property", ""),
                entity_property=p.get("entity_property", "") or "",
                datatype=p.get("datatype", "") or "",
                is_reference=_b(p.get("is_reference")),
                is_identity=_b(p.get("is_identity")),
                is_deleted=_b(p.get("is_deleted")),
                is_recorded=_b(p.get("is_recorded")),
                required=_b(p.get("required")),
                custom_expression=custom.get("expression"),
            )
        )
    return IncomingMapping(d.get("base_uri", "") or "", tuple(pms))


def definition_from_dict(d: dict) -> DatasetDefinition:
    sc = d.get("source_config") or {}
    source = SourceConfig(
        table_name=sc.get("table_name", "") or "",
        schema=sc.get("schema", "") or "",
        database=sc.get("database", "") or "",
        raw_column=sc.get("raw_column"),
        since_column=sc.get("since_column"),
        latest_table=sc.get("latest_table"),
        path=sc.get("path"),
        catalog_table=sc.get("catalog_table"),
    )
    return DatasetDefinition(
        name=d["name"],
        source=source,
        incoming=_incoming(d.get("incoming_mapping_config")),
        outgoing=_outgoing(d.get("outgoing_mapping_config")),
    )


def load_definitions(text_or_obj: str | dict) -> dict[str, DatasetDefinition]:
    """Parse ``{"dataset_definitions": [...]}`` (optionally wrapped in ``data``)."""
    obj = json.loads(text_or_obj) if isinstance(text_or_obj, str) else text_or_obj
    if "data" in obj and "dataset_definitions" not in obj:
        obj = obj["data"]
    defs = [definition_from_dict(d) for d in obj.get("dataset_definitions") or ()]
    return {d.name: d for d in defs}
