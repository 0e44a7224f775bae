"""Entity -> row mapping (write side, P8-P15).

Input is a staged entity frame with one variant column ``entity``.  Output is
the log/latest row: system columns, then one column per mapping, or the whole
entity as one variant column when no mappings exist.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.variants import get, json_path
from entitylake.model import ENTITY_COLUMN, SYSTEM_COLUMNS, DatasetDefinition, IncomingPropertyMapping, spark_type


def _check(ds: DatasetDefinition) -> None:
    seen = set()
    for pm in ds.column_mappings():
        name = pm.property.lower()
        if not name:
            raise ValueError("mapping without a column name")
        if name in SYSTEM_COLUMNS:
            raise ValueError(f"column {pm.property!r} clashes with a system column")
        if name in seen:
            raise ValueError(f"column {pm.property!r} mapped twice")
        seen.add(name)


def column_type(pm: IncomingPropertyMapping) -> str:
    if pm.custom_expression:
        return spark_type(pm.datatype)
    if pm.is_recorded:
        return "bigint"
    if pm.is_deleted:
        return "boolean"
    return spark_type(pm.datatype)


@lru_cache(maxsize=256)
def _parsed_type(ddl: str) -> T.DataType:
    """A column's type, parsed by the JVM once: a stream needs it for every batch."""
    return T._parse_datatype_string(ddl)


def table_schema(ds: DatasetDefinition) -> T.StructType:
    """K2: columns of the log / latest table, derived from the mapping."""
    _check(ds)
    fields = [
        T.StructField("id", T.StringType()),
        T.StructField("recorded", T.LongType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("dataset", T.StringType()),
    ]
    pms = ds.column_mappings()
    if not pms:
        fields.append(T.StructField(ENTITY_COLUMN, T.VariantType()))
    for pm in pms:
        fields.append(T.StructField(pm.property, _parsed_type(column_type(pm))))
    return T.StructType(fields)


_STEP = r"""(?:"(?:[^"\\]|\\.)*"|[A-Za-z_][A-Za-z0-9_]*)"""
#: Text in quotes, or the staged record's token with the path that follows it.
_RECORD = re.compile(rf"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|(?P<record>\$1)(?![0-9A-Za-z_])(?P<path>(?:[:.](?!:){_STEP})*)""")


def entity_expression(sql: str) -> str:
    """Custom SQL with the staged record's column token ``$1`` read as column ``entity``.

    ``$1:props:"<key>"`` reads that path of the entity; text in quotes stays as it is.
    """

    def named(m: re.Match) -> str:
        if not m["record"]:
            return m[0]
        steps = [x[1:-1] if x[0] == '"' else x for x in re.findall(rf"[:.]({_STEP})", m["path"])]
        if not steps:
            return ENTITY_COLUMN
        path = "$" + "".join('["' + x + '"]' for x in steps)
        return f"variant_get({ENTITY_COLUMN}, '" + path.replace("\\", "\\\\").replace("'", "\\'") + "', 'variant')"

    return _RECORD.sub(named, sql)


def source_path(pm: IncomingPropertyMapping) -> str | None:
    """Where a mapped value stands in the entity (None: a custom expression)."""
    if pm.custom_expression:
        return None
    if pm.is_recorded:  # P12
        return "$.recorded"
    if pm.is_deleted:  # P13: no coalesce
        return "$.deleted"
    if pm.is_identity:  # P14
        return "$.id"
    return json_path("refs" if pm.is_reference else "props", pm.entity_property)  # P10 / P11


def mapped_value(pm: IncomingPropertyMapping, e: Column, strict: bool = True) -> Column:
    """P10-P15, in precedence custom > recorded > deleted > identity > property; not strict: a value that cannot be cast is null."""
    t, path = column_type(pm), source_path(pm)
    if path is None:  # P15: SQL over column ``entity``
        v = F.expr(entity_expression(pm.custom_expression))
        v = v.cast(t) if strict else v.try_cast(t)
    else:
        v = get(e, path, t, strict)
    if pm.required and strict:
        v = F.when(v.isNull(), F.raise_error(F.lit(f"required column {pm.property} is null"))).otherwise(v)
    return v.alias(pm.property)


def reject_reasons(ds: DatasetDefinition, e: Column) -> Column:
    """Why a row cannot be loaded (null: it can): what stands in the entity but cannot be cast, and nulls in required columns."""

    def uncast(path: str, t: str) -> Column:
        raw = F.try_variant_get(e, path, "variant")
        return raw.isNotNull() & ~F.is_variant_null(raw) & get(e, path, t, False).isNull()

    reasons = [F.when(uncast("$.deleted", "boolean"), "deleted is not boolean")]
    for pm in ds.column_mappings():
        path, t, null = source_path(pm), column_type(pm), mapped_value(pm, e, strict=False).isNull()
        reason = F.when(null, f"required column {pm.property} is null") if pm.required else F.lit(None).cast("string")
        if path is not None:
            reason = F.when(uncast(path, t), f"column {pm.property} is not {t}").otherwise(reason)
        reasons.append(reason)
    text = F.concat_ws("; ", *reasons)
    return F.when(text != "", text)


def system_columns(e: Column, load_ns: int | Column, dataset: str, strict: bool = True) -> list[Column]:
    """Id, recorded = load time of the request (not the entity's), deleted, dataset."""
    load = load_ns if isinstance(load_ns, Column) else F.lit(int(load_ns))
    return [
        get(e, "$.id", "string").alias("id"),
        load.cast("bigint").alias("recorded"),
        F.coalesce(get(e, "$.deleted", "boolean", strict), F.lit(False)).alias("deleted"),
        F.lit(dataset).alias("dataset"),
    ]


def entity_columns(ds: DatasetDefinition, e: Column, strict: bool = True) -> list[Column]:
    pms = ds.column_mappings()
    if not pms:
        return [e.alias(ENTITY_COLUMN)]  # P9
    return [mapped_value(pm, e, strict) for pm in pms]


@lru_cache(maxsize=64)
def _row_columns(ds: DatasetDefinition, load_ns: int, strict: bool) -> tuple[Column, ...]:
    """The projection of a mapping, built once: a stream needs it for every batch."""
    _check(ds)
    e = F.col(ENTITY_COLUMN)
    return (*system_columns(e, load_ns, ds.name, strict), *entity_columns(ds, e, strict))


def entities_to_rows(
    staged: DataFrame, ds: DatasetDefinition, load_ns: int | Column, keep: tuple[str, ...] = (), strict: bool = True
) -> DataFrame:
    """Staged frame (``entity`` variant + metadata) -> table rows (+ ``keep`` columns).

    Strict: a value that cannot be cast or a null in a required column fails the
    job.  Otherwise rows have ``_reason`` (null: good) and, with one, ``_raw``,
    the entity as JSON text.
    """
    e = F.col(ENTITY_COLUMN)
    try:
        cols = [*_row_columns(ds, load_ns, strict), *keep]
    except TypeError:  # a load time by row cannot be hashed: build its column alone
        ident, _, *others = _row_columns(ds, 0, strict)
        cols = [ident, load_ns.cast("bigint").alias("recorded"), *others, *keep]
    if strict:
        return staged.select(*cols)
    rows = staged.select(*cols, reject_reasons(ds, e).alias("_reason"), e.alias("_raw"))
    return rows.withColumn("_raw", F.when(F.col("_reason").isNotNull(), F.to_json("_raw")))
