"""Variant helpers: build entity objects, read paths with casts, flatten.

``props`` and ``refs`` are variant objects.  Values keep their JSON type
(string / number / boolean / array).  Object keys serialise sorted.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def empty_object() -> Column:
    return F.parse_json(F.lit("{}"))


# Spark's JSON parsers stop after the first value and ignore what follows
# ('{"a":1} junk' parses as {"a":1}).  Text is therefore parsed inside a wrapper
# '[' text ',"<end>"]': it is exactly one JSON value when the wrapper parses to
# two elements and the second is the end marker.
_END = "\\u0001end of value"  # JSON escape in the wrapper text
_END_VALUE = "\x01end of value"  # the same string once parsed


def parse_whole_json(df: DataFrame, text: str, out: str, strict: bool, error: str = "malformed JSON") -> DataFrame:
    """``df`` plus variant column ``out``: ``text`` parsed, rejecting anything after the value.

    NULL text gives NULL.  Not strict: malformed text gives NULL; strict: it
    fails the job with ``error``.  The wrapper is parsed once, in its own
    projection (an expensive column is not inlined into its three uses).
    """
    wrapped = F.concat(F.lit("["), F.col(text), F.lit(',"' + _END + '"]'))
    step = df.withColumn("_wjson", F.try_parse_json(wrapped))
    v = F.col("_wjson")
    whole = (F.try_variant_get(v, "$[1]", "string") == F.lit(_END_VALUE)) & F.try_variant_get(v, "$[2]", "variant").isNull()
    value = F.when(F.col(text).isNull(), F.lit(None).cast("variant")).when(whole, F.variant_get(v, "$[0]", "variant"))
    if strict:
        value = value.otherwise(F.raise_error(F.concat(F.lit(error + ": "), F.substring(F.col(text), 1, 200))))
    return step.withColumn(out, value).drop("_wjson")


# The characters JSON allows around a value (and a byte order mark).
JSON_SPACE = " \t\r\n\ufeff"


def json_starts_with(text: Column, opening: str) -> Column:
    """Whether JSON text is an array (``[``) or object (``{``): its first character after white space."""
    return F.ltrim(text, F.lit(JSON_SPACE)).startswith(opening)


def parse_json_elements(df: DataFrame, text: str, out: str, error: str) -> DataFrame:
    """``df`` plus ``out`` (array of variants): the elements of a JSON array, or the one top-level object.

    Every element is a variant of its own, so an array may be larger than the
    variant limit.  An end marker is put before the array's last bracket: text
    after the array, or a second value, leaves the parsed array without it and
    fails the job with ``error``, as malformed text does.  NULL text gives NULL.
    """
    body, marked, elements = _element_steps(text, error)
    step = df.withColumn("_jbody", body).withColumn("_jall", marked)
    return step.withColumn(out, elements).drop("_jbody", "_jall")


@lru_cache(maxsize=16)
def _element_steps(text: str, error: str) -> tuple[Column, Column, Column]:
    """The text without space around it, its array with the end marker, the elements without it."""
    trimmed = F.btrim(F.col(text), F.lit(JSON_SPACE))
    body = F.col("_jbody")
    end = F.lit('"' + _END + '"]')
    empty = body.rlike(r"^\[[ \t\r\n]*\]$")
    opened = F.expr("left(_jbody, length(_jbody) - 1)")
    marked = (
        F.when(empty, F.concat(F.lit("["), end))
        .when(body.startswith("[") & body.endswith("]"), F.concat(opened, F.lit(","), end))
        .when(body.startswith("{"), F.concat(F.lit("["), body, F.lit(","), end))
    )
    n = F.size("_jall")
    whole = F.try_variant_get(F.element_at("_jall", -1), "$", "string") == F.lit(_END_VALUE)
    whole = whole & (body.startswith("[") | (n == 2))
    elements = (
        F.when(F.col(text).isNull(), F.lit(None).cast("array<variant>"))
        .when(whole, F.slice("_jall", 1, n - 1))
        .otherwise(F.raise_error(F.concat(F.lit(error + ": "), F.substring(F.col(text), 1, 200))))
    )
    return trimmed, F.from_json(marked, "array<variant>"), elements


def to_variant(c: Column) -> Column:
    return c.cast("variant")


def variant_object(pairs: Iterable[tuple[str, Column]]) -> Column:
    """Variant object from (key, value) pairs; NULL values leave their key out."""
    pairs = list(pairs)
    if not pairs:
        return empty_object()
    m = F.create_map(*[x for k, v in pairs for x in (F.lit(k), to_variant(v))])
    return F.to_variant_object(F.map_filter(m, lambda k, v: v.isNotNull()))


def json_path(section: str | None, key: str) -> str:
    """``$.props["<key>"]`` style path; quotes in keys are escaped."""
    esc = key.replace("\\", "\\\\").replace('"', '\\"')
    return f'$.{section}["{esc}"]' if section else f'$["{esc}"]'


def get(v: Column, path: str, ddl_type: str, strict: bool = True) -> Column:
    """Typed read at a JSON path.  Strict casts fail the job on bad input."""
    fn = F.variant_get if strict else F.try_variant_get
    return fn(v, path, ddl_type)


def value_kind(v: Column) -> Column:
    """JSON kind of a variant value: string, number, boolean, array, object, null."""
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit("null"))
        .when(s == "STRING", F.lit("string"))
        .when(s == "BOOLEAN", F.lit("boolean"))
        .when(s.startswith("ARRAY"), F.lit("array"))
        .when(s.startswith("OBJECT"), F.lit("object"))
        .otherwise(F.lit("number"))
    )


def value_text(v: Column) -> Column:
    """Scalar as plain text, arrays / objects as JSON text."""
    return F.variant_get(v, "$", "string")


def flatten_entities(entities) -> "DataFrame":  # noqa: F821
    """Entity frame -> (id, kind, key, value, value_type) rows; one per prop / ref.

    Used to compare entities with relational oracles (variants cannot be hashed).
    One scan: the entries of both objects are tagged and exploded together.
    """

    rows = entities.select("id", _tagged_entries().alias("e"))
    return rows.select("id", "e.kind", "e.key", value_text(F.col("e.v")).alias("value"), value_kind(F.col("e.v")).alias("value_type"))


@lru_cache(maxsize=1)
def _tagged_entries() -> Column:
    """One row for each prop and ref, built once (lambdas are costly to construct)."""

    def tagged(kind: str) -> Column:
        entries = F.map_entries(F.coalesce(F.col(f"{kind}s"), empty_object()).cast("map<string,variant>"))
        return F.transform(entries, lambda e: F.struct(F.lit(kind).alias("kind"), e["key"].alias("key"), e["value"].alias("v")))

    return F.explode(F.concat(tagged("prop"), tagged("ref")))
