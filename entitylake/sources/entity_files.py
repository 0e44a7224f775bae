"""Entity-batch payloads (S5), namespace expansion (P16), staged files.

Payload files are JSON arrays whose first element is ``{"id": "@context",
"namespaces": {...}}`` followed by entities with prefixed ids and keys.  Each
file is one batch, read by one task; many moderate files parallelise.  A file
is parsed element by element, so its size is bounded by Spark's 2 GB limit for
one text value only, and the same rules hold for files of every size.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.functions.uris import expand
from entitylake.functions.variants import empty_object, json_starts_with, parse_json_elements, parse_whole_json
from entitylake.model import CONTEXT_ID, ENTITY_COLUMN

ARRIVAL = ("_file", "_pos")


def read_payloads(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Payload elements of files: see ``payload_elements``."""
    files = spark.read.format("binaryFile").load(paths)
    return payload_elements(files.select(F.col("content").cast("string").alias("value"), F.col("_metadata.file_path").alias("_file")))


def payload_elements(files: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Elements of payload files ``(value, _file)``: entity columns, ``_ns``, ``_file``, ``_pos``.

    Each file is one row (a payload file is never split anyway) and is parsed
    once.  Its first element, when it is the ``@context``, gives ``_ns`` to
    every element of the same file in the same projection, with no join,
    shuffle or broadcast.  A top-level object is a one-element batch.  A
    malformed file, or text after its JSON value, fails.
    """
    parsed = parse_json_elements(files, "value", "_all", "malformed payload file")
    ns, exploded, element = _element_columns()
    per_file = parsed.select("_file", *keep, ns, "_all")
    return per_file.select("_file", *keep, "_ns", exploded).where("_pos is not null").select(*element, *keep)


@lru_cache(maxsize=1)
def _element_columns() -> tuple[Column, Column, tuple[Column, ...]]:
    """A file's namespaces, its elements in rows, and an element's columns: built once, a stream needs them for every batch."""
    head = F.get("_all", F.lit(0))
    first_is_context = F.try_variant_get(head, "$.id", "string") == F.lit(CONTEXT_ID)
    ns = F.when(first_is_context, F.variant_get(head, "$.namespaces", "map<string,string>"))
    # outer: no filter is inferred on the array, which would parse the file again for it
    exploded = F.posexplode_outer("_all").alias("_pos", "_e")
    element = (
        F.variant_get("_e", "$.id", "string").alias("id"),
        F.variant_get("_e", "$.recorded", "bigint").alias("recorded"),
        F.variant_get("_e", "$.deleted", "boolean").alias("deleted"),
        F.variant_get("_e", "$.refs", "variant").alias("refs"),
        F.variant_get("_e", "$.props", "variant").alias("props"),
        F.col("_ns"),
        F.col("_file"),
        F.col("_pos").cast("bigint").alias("_pos"),
    )
    return ns.alias("_ns"), exploded, element


def payload_entities(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """S5 + P16: entity frame of payload files, expanded, with arrival columns."""
    return expanded_payloads(read_payloads(spark, paths))


def expanded_payloads(elements: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Entities of payload elements (context elements dropped), namespaces expanded."""
    entities = elements.where(f"id is null or id != '{CONTEXT_ID}'")
    return expand_namespaces(entities, "_ns").select("id", "recorded", "deleted", "refs", "props", *ARRIVAL, *keep)


def _expand_refs(refs: Column, ns: Column) -> Column:
    m = F.coalesce(refs, empty_object()).cast("map<string,variant>")
    m = F.transform_keys(m, lambda k, v: expand(k, ns))

    def value(k: Column, v: Column) -> Column:
        kind = F.schema_of_variant(v)
        as_array = F.transform(v.cast("array<string>"), lambda x: expand(x, ns)).cast("variant")
        as_string = expand(v.cast("string"), ns).cast("variant")
        return F.when(kind.startswith("ARRAY"), as_array).when(kind == "STRING", as_string).otherwise(v)

    return F.to_variant_object(F.transform_values(m, value))


def _expand_props(props: Column, ns: Column) -> Column:
    m = F.coalesce(props, empty_object()).cast("map<string,variant>")
    return F.to_variant_object(F.transform_keys(m, lambda k, v: expand(k, ns)))


@lru_cache(maxsize=16)
def _expansion(ns_column: str) -> tuple[Column, ...]:
    """The P16 projection, built once (its lambdas are costly to construct)."""
    ns = F.coalesce(F.col(ns_column), F.create_map().cast("map<string,string>"))
    return (
        expand(F.col("id"), ns).alias("id"),
        F.col("recorded"),
        F.col("deleted"),
        _expand_refs(F.col("refs"), ns).alias("refs"),
        _expand_props(F.col("props"), ns).alias("props"),
    )


def expand_namespaces(entities: DataFrame, ns_column: str) -> DataFrame:
    """Expand prefixes in id, prop keys, ref keys and ref values.

    ``ns_column`` holds each row's prefix -> URI map (NULL = no context).
    """
    extra = [c for c in entities.columns if c.startswith("_") and c != ns_column]
    return entities.select(*_expansion(ns_column), *extra)


#: Arrival columns of staged rows, in order: folder, part number and rollover number of the file (as
#: numbers, from its name), split offset, row, array element.
STAGE_ORDER = ("_dir", "_part", "_roll", "_blk", "_ix", "_elem")


def read_stage(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """S6 + S7: staged NDJSON(.gz) -> ``entity`` variant + file metadata.

    ``paths`` are files or stage folders (read recursively).

    Malformed lines abort the read; a line holding a JSON array is unpacked
    into its elements (outer array stripped).  A row's position in its file is
    ``(_blk, _ix)``: the split's start offset, then a counter that rises along
    the split (gzip files are never split; plain files may be).  Files of one
    folder are ordered by the numbers in their names, as numbers.
    """
    text = spark.read.option("mode", "FAILFAST").option("recursiveFileLookup", True).text(paths)
    parsed = parse_whole_json(text, "value", "_v", True, "malformed staged line")  # trailing text aborts too
    scanned = parsed.select(
        "_v",
        json_starts_with(F.col("value"), "[").alias("_arr"),  # cheap: no walk over the value
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_fts"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_ix"),
    )
    elems = F.when(F.col("_arr"), F.col("_v").cast("array<variant>")).otherwise(F.array(F.col("_v")))
    name = F.element_at(F.split("_file", "/"), -1)
    return scanned.select(
        F.posexplode(elems).alias("_elem", ENTITY_COLUMN),
        "_file",
        F.regexp_replace("_file", "/[^/]*$", "").alias("_dir"),
        F.regexp_extract(name, r"^part-([0-9]{1,18})", 1).try_cast("bigint").alias("_part"),
        F.regexp_extract(name, r"-c([0-9]{1,18})\.", 1).try_cast("bigint").alias("_roll"),
        "_fts",
        "_blk",
        "_ix",
    )
