"""Row -> entity mapping (read side, P1-P7) and raw-entity decoding.

Everything is one projection of native column expressions, so Catalyst prunes
the scan to the mapped columns and the mapping runs inside the scan's stage.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.uris import fill_template, property_uri
from entitylake.functions.variants import empty_object, json_starts_with, parse_whole_json, variant_object
from entitylake.model import OutgoingMapping, OutgoingPropertyMapping, spark_type

RAW_ENTITY_DDL = "id string, recorded bigint, deleted boolean, refs variant, props variant"


def apply_constructions(df: DataFrame, mapping: OutgoingMapping) -> DataFrame:
    """P1 as a frame: ``replace(source, old, new)`` overrides the same-named column."""
    exprs = construction_columns(df.columns, mapping)
    return df.select(*[exprs[n].alias(n) for n in exprs])


def construction_columns(columns: list[str], mapping: OutgoingMapping) -> dict[str, Column]:
    """Column expressions after P1, in source order plus new constructed names."""
    exprs: dict[str, Column] = {n: F.col(n) for n in columns}
    for c in mapping.constructions:
        src, old, new = c.args
        base = exprs.get(src, F.col(src))
        exprs[c.property] = F.replace(base.cast("string"), F.lit(old), F.lit(new))
    return exprs


def _value(pm: OutgoingPropertyMapping, exprs: dict[str, Column]) -> Column:
    v = exprs.get(pm.property, F.col(pm.property))
    if pm.datatype:
        v = v.cast(spark_type(pm.datatype))
    if pm.default_value is not None:
        v = F.coalesce(v, F.lit(pm.default_value))
    if pm.required:
        v = F.when(v.isNull(), F.raise_error(F.lit(f"required column {pm.property} is null"))).otherwise(v)
    return v


def mapped_columns(mapping: OutgoingMapping, columns: list[str]) -> list[str]:
    """The source columns a mapping reads, in mapping order.

    Informational: the mapping is one projection, so Catalyst prunes the scan
    to exactly these columns (``ReadSchema``) by itself.
    """
    if mapping.map_all or not mapping.property_mappings:
        return list(columns)
    needed: list[str] = []
    for pm in mapping.property_mappings:
        if pm.property not in needed:
            needed.append(pm.property)
    for c in mapping.constructions:
        if c.args[0] not in needed:
            needed.append(c.args[0])
    return needed


def rows_to_entities(df: DataFrame, mapping: OutgoingMapping | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project rows to the entity frame (id, recorded, deleted, refs, props).

    One ``select``: constructions are substituted into the value expressions.
    The projection only depends on the mapping and the input column names, so
    it is built once and reused by every request on the same dataset.
    """
    mapping = mapping or OutgoingMapping(map_all=True)
    if not mapping.property_mappings and not mapping.map_all:  # D7: an empty list reads `*`
        mapping = OutgoingMapping(mapping.base_uri, mapping.constructions, (), True)
    columns = tuple(c for c in df.columns if c not in keep)
    try:
        cols = _projection(mapping, columns)
    except TypeError:  # an unhashable default value: build without the cache
        cols = _projection.__wrapped__(mapping, columns)
    return df.select(*cols, *keep)


@lru_cache(maxsize=256)
def _projection(mapping: OutgoingMapping, columns: tuple[str, ...]) -> tuple[Column, ...]:
    exprs = construction_columns(list(columns), mapping)
    base = mapping.base_uri

    props: dict[str, Column] = {}
    refs: dict[str, Column] = {}
    ident: Column = F.lit(None).cast("string")
    if mapping.map_all:  # P6: every column, identity and reference columns too
        for name, expr in exprs.items():
            props[property_uri(base, name)] = expr
    for pm in mapping.property_mappings:  # explicit mappings on top
        v = _value(pm, exprs)
        if pm.uri_value_pattern:
            v = fill_template(pm.uri_value_pattern, v)
        if pm.is_identity:
            ident = v.cast("string")
            continue
        key = property_uri(base, pm.entity_property or pm.property)
        if pm.is_reference:
            refs[key] = v.cast("string")
        else:
            props[key] = v
    return (
        ident.alias("id"),
        F.lit(None).cast("bigint").alias("recorded"),
        F.lit(False).alias("deleted"),
        variant_object(refs.items()).alias("refs"),
        variant_object(props.items()).alias("props"),
    )


def decode_raw_entities(
    df: DataFrame, column: str, strict: bool = False, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Decode a raw JSON entity column.

    Returns ``(entities, rejects)``.  Malformed or null JSON goes to ``rejects``
    (the source row's column text plus a reason) instead of silently becoming an
    empty entity; with ``strict=True`` a malformed row fails the job instead.
    """
    field = next((f for f in df.schema.fields if f.name.lower() == column.lower()), None)
    if field is not None and isinstance(field.dataType, T.VariantType):  # stored entities: already parsed
        staged = df.select(F.lit(None).cast("string").alias("_raw"), F.col(column).alias("_v"), *keep)
        is_object = F.schema_of_variant("_v").startswith("OBJECT")
    else:
        raw = df.select(F.col(column).cast("string").alias("_raw"), *keep)
        staged = parse_whole_json(raw, "_raw", "_v", strict, "malformed entity json")  # trailing text is malformed too
        is_object = json_starts_with(F.col("_raw"), "{")  # valid JSON starting with '{' is an object
    good = staged.where(F.col("_v").isNotNull() & is_object)
    bad = staged.where(F.col("_v").isNull() | ~is_object)
    v = F.col("_v")
    entities = good.select(
        F.try_variant_get(v, "$.id", "string").alias("id"),
        F.try_variant_get(v, "$.recorded", "bigint").alias("recorded"),
        F.coalesce(F.try_variant_get(v, "$.deleted", "boolean"), F.lit(False)).alias("deleted"),
        F.coalesce(F.try_variant_get(v, "$.refs", "variant"), empty_object()).alias("refs"),
        F.coalesce(F.try_variant_get(v, "$.props", "variant"), empty_object()).alias("props"),
        *keep,
    )
    rejects = bad.select(
        F.col("_raw").alias("raw"),
        F.when(F.col("_raw").isNull(), F.lit("null entity")).otherwise(F.lit("malformed entity json")).alias("reason"),
    )
    return entities, rejects


def entity_json(entities: DataFrame) -> Column:
    """K5 / K1 line: ``{"id","recorded","deleted","refs","props"}`` in that order.

    ``recorded`` is left out when unset (NULL or 0) and ``deleted`` when false.
    """
    return _entity_json()


@lru_cache(maxsize=1)
def _entity_json() -> Column:
    return F.to_json(
        F.struct(
            F.col("id").alias("id"),
            F.when(F.col("recorded") != 0, F.col("recorded")).alias("recorded"),
            F.when(F.col("deleted"), F.lit(True)).alias("deleted"),
            F.coalesce(F.col("refs"), empty_object()).alias("refs"),
            F.coalesce(F.col("props"), empty_object()).alias("props"),
        )
    )
