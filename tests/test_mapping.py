"""Row -> entity mapping with nulls and mixed types, raw entities and feeds."""

import json

import pytest
from pyspark.sql import functions as F

from entitylake.model import Construction, DatasetDefinition, OutgoingMapping, OutgoingPropertyMapping, SourceConfig
from entitylake.operators.outgoing import entity_json
from entitylake.plans.read import read_entities
from entitylake.sinks.feed import read_feed, write_feed

SHIPS = [("imo/91", "Aurora", 1998, 12.5, None, "oslo fjord"), ("imo/92", None, None, 0.0, True, None), ("imo/93", "Ægir: two", 2020, None, False, "a b c")]
SHIPS_DDL = "ship string, label string, built int, draught double, laid_up boolean, berth string"
B = "urn:fleet:"
CONS = (Construction("ship", "replace", ("ship", "imo/", "")), Construction("quay", "replace", ("berth", " ", "-")))
IDENT = OutgoingPropertyMapping("ship", is_identity=True, uri_value_pattern=B + "ship/{value}", required=True)
BERTH = OutgoingPropertyMapping("quay", "moored", is_reference=True, uri_value_pattern=B + "quay/{value}")


def entities(spark, mapping, rows=SHIPS, ddl=SHIPS_DDL):
    ds = DatasetDefinition("ships", SourceConfig(), outgoing=mapping)
    out = read_entities(spark.createDataFrame(rows, ddl), ds).entities.select(entity_json(F.col("*")).alias("j")).collect()
    return {e.get("id"): e for e in (json.loads(r.j) for r in out)}


def test_selected_columns(spark):
    mapping = OutgoingMapping(
        base_uri=B,
        constructions=CONS,
        property_mappings=(
            IDENT,
            BERTH,
            OutgoingPropertyMapping("label", "name"),
            OutgoingPropertyMapping("built", "year"),
            OutgoingPropertyMapping("draught", "https://other.example/draught"),
            OutgoingPropertyMapping("laid_up", "idle"),
        ),
    )
    got = entities(spark, mapping)
    assert got[B + "ship/91"]["props"] == {B + "name": "Aurora", B + "year": 1998, "https://other.example/draught": 12.5}
    assert got[B + "ship/91"]["refs"] == {B + "moored": B + "quay/oslo-fjord"}
    assert got[B + "ship/92"] == {"id": B + "ship/92", "refs": {}, "props": {"https://other.example/draught": 0, B + "idle": True}}
    assert got[B + "ship/93"]["props"] == {B + "name": "Ægir: two", B + "year": 2020, B + "idle": False}
    assert got[B + "ship/93"]["refs"] == {B + "moored": B + "quay/a-b-c"}


def test_map_all_adds_every_column_that_is_not_null(spark):
    got = entities(spark, OutgoingMapping(base_uri=B, constructions=CONS, property_mappings=(IDENT, BERTH), map_all=True))
    assert set(got[B + "ship/91"]["props"]) == {B + c for c in ("ship", "label", "built", "draught", "berth", "quay")}
    assert got[B + "ship/91"]["props"][B + "ship"] == "91"  # the construction goes before the mapping
    assert set(got[B + "ship/92"]["props"]) == {B + c for c in ("ship", "draught", "laid_up")}


def test_defaults_datatypes_and_required(spark):
    mapping = OutgoingMapping(
        base_uri=B,
        property_mappings=(
            OutgoingPropertyMapping("ship", is_identity=True),
            OutgoingPropertyMapping("label", "name", default_value="unnamed", required=True),
            OutgoingPropertyMapping("built", "year", "varchar(8)"),
            OutgoingPropertyMapping("draught", "depth", "number(6,1)", default_value=-1),
        ),
    )
    got = entities(spark, mapping)
    assert got["imo/92"]["props"] == {B + "name": "unnamed", B + "depth": 0}
    assert got["imo/91"]["props"] == {B + "name": "Aurora", B + "year": "1998", B + "depth": 12.5}
    assert got["imo/93"]["props"][B + "depth"] == -1
    needed = OutgoingMapping(property_mappings=(OutgoingPropertyMapping("label", "name", required=True),))
    with pytest.raises(Exception, match="required column label"):
        entities(spark, needed)


def test_raw_feed(spark, tmp):
    texts = ['{"props":{"b":[1,"two"],"a":null},"id":"first"}', '\n\t{"id":"second","deleted":true,"recorded":5,"refs":{"r":"u"}}']
    df = spark.createDataFrame([(t,) for t in texts], "ENTITY string")
    page = read_entities(df, DatasetDefinition("raw", SourceConfig(raw_column="entity")))
    assert page.token == ""
    write_feed(page.entities, page.token, tmp + "/feed")
    lines = sorted((r.section, r.line) for r in read_feed(spark, tmp + "/feed").collect())
    assert lines == [
        (0, '{"id":"@context","namespaces":{}}'),
        (1, '{"id":"first","refs":{},"props":{"a":null,"b":[1,"two"]}}'),
        (1, '{"id":"second","recorded":5,"deleted":true,"refs":{"r":"u"},"props":{}}'),
        (2, '{"id":"@continuation","token":""}'),
    ]


def test_feeds_follow_the_table(spark, tmp):
    from entitylake.lake import Lake
    from entitylake.model import IncomingMapping, IncomingPropertyMapping
    from entitylake.session import scratch_dir

    lake = Lake(spark, tmp + "/lake")
    path = scratch_dir(spark, "feed-table")
    spark.range(3_000).selectExpr("cast(id * 7919 % 3000 as string) as k").repartition(5).write.parquet(path)
    out = OutgoingMapping(property_mappings=(OutgoingPropertyMapping("k", is_identity=True),))
    lake.define(DatasetDefinition("t", SourceConfig(path=path), outgoing=out))
    assert lake.feed("t", tmp + "/feed") == ""
    rows = sorted((r.position, r.section, r.line) for r in read_feed(spark, tmp + "/feed").collect())
    assert [p for p, _, _ in rows] == list(range(3_002)) and [s for _, s, _ in rows] == [0] + [1] * 3_000 + [2]
    table = spark.read.parquet(path).select("k", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index")
    assert [json.loads(x)["id"] for _, _, x in rows[1:-1]] == [r.k for r in table.collect()]
    lake.define(DatasetDefinition("log", incoming=IncomingMapping(property_mappings=(IncomingPropertyMapping("k", "k", "integer"),))))
    versions = SourceConfig(table_name="LOG", since_column="recorded")
    lake.define(DatasetDefinition("versions", versions, outgoing=OutgoingMapping(property_mappings=(OutgoingPropertyMapping("k", is_identity=True), OutgoingPropertyMapping("recorded", "load")))))
    none = F.lit(None).cast("bigint")
    for load in (2, 3):
        props = F.to_variant_object(F.create_map(F.lit("k"), (F.col("id") * load).cast("variant")))
        ents = spark.range(200).select(F.lit("x").alias("id"), none.alias("recorded"), F.lit(False).alias("deleted"), F.parse_json(F.lit("{}")).alias("refs"), props.alias("props"), (-F.col("id")).alias("_at"))
        lake.write_incremental("log", ents, load, f"b{load}", ("_at",))
    token = lake.feed("versions", tmp + "/log-feed")
    got = [json.loads(r.line)["id"] for r in read_feed(spark, tmp + "/log-feed").where("section = 1").orderBy("position").collect()]
    assert got == [str(k * load) for load in (2, 3) for k in range(199, -1, -1)]
    assert lake.feed("versions", tmp + "/later", since=token) == token and read_feed(spark, tmp + "/later").count() == 2


def test_malformed_raw_json_goes_to_rejects(spark):
    df = spark.createDataFrame([('{"id": "1"}',), ("{bad",), (None,), ("[1,2]",), ("7",), ("",)], "ENTITY string")
    page = read_entities(df, DatasetDefinition("raw", SourceConfig(raw_column="ENTITY")))
    assert [r.id for r in page.entities.collect()] == ["1"]
    assert page.rejects.count() == 5


def test_trailing_text_after_raw_json_is_rejected(spark):
    # Spark's JSON parsers stop after the first value; the trailing text must not be dropped silently
    texts = ['{"id": "ok"} ', '{"id": "1"} junk', '{"id": "2"}{"id": "3"}', '{"id": "4"},', '{"id": "5"}}']
    df = spark.createDataFrame([(t,) for t in texts], "ENTITY string")
    page = read_entities(df, DatasetDefinition("raw", SourceConfig(raw_column="ENTITY")))
    assert [r.id for r in page.entities.collect()] == ["ok"]
    assert sorted(r.raw for r in page.rejects.collect()) == sorted(texts[1:])


def test_empty_mapping_list_reads_every_column(spark):
    got = entities(spark, OutgoingMapping(), [("1", "x:y")], "a string, b string")
    assert got == {None: {"refs": {}, "props": {"a": "1", "b": "x:y"}}}  # values with ':' stay as they are
