"""Definitions: every documented field, defaults, errors; dataset name resolution (S4); datatypes."""

import json

import pytest

from entitylake.model import load_definitions, spark_type
from entitylake.sources.tables import resolve

LIBRARY = {
    "dataset_definitions": [
        {"name": "shelf", "source_config": {"schema": "stock", "raw_column": "doc", "latest_table": False}},
        {
            "name": "loan.desk",
            "source_config": {"table_name": "loans_2024", "since_column": "changed_at", "latest_table": True},
            "outgoing_mapping_config": {
                "base_uri": "urn:library:",
                "constructions": [{"property": "isbn", "operation": "replace", "args": ["isbn", "-", ""]}],
                "property_mappings": [
                    {"property": "loan_no", "is_identity": True, "uri_value_pattern": "urn:library:loan/{value}"},
                    {"property": "isbn", "entity_property": "book", "is_reference": True, "uri_value_pattern": "urn:isbn:{value}"},
                    {"property": "days", "datatype": "number(5,1)", "default_value": 14, "required": True},
                ],
            },
        },
        {
            "name": "members",
            "source_config": {"path": "/data/members", "database": "people"},
            "incoming_mapping_config": {
                "property_mappings": [
                    {"property": "member_no", "is_identity": True},
                    {"property": "left", "is_deleted": True},
                    {"property": "seen", "is_recorded": True},
                    {"property": "home", "entity_property": "urn:library:branch", "is_reference": True, "required": True},
                    {"property": "initials", "datatype": "varchar(4)", "custom": {"expression": "$1:props:\"urn:library:initials\"::string"}},
                ]
            },
        },
    ]
}


def test_source_fields():
    defs = load_definitions(json.dumps(LIBRARY))
    shelf, desk, members = defs["shelf"].source, defs["loan.desk"].source, defs["members"].source
    assert (shelf.schema, shelf.raw_column, shelf.latest_table, shelf.since_column) == ("stock", "doc", False, None)
    assert (desk.table_name, desk.since_column, desk.latest_table, desk.raw_column) == ("loans_2024", "changed_at", True, None)
    assert (members.path, members.database, members.latest_table) == ("/data/members", "people", None)


def test_outgoing_fields():
    out = load_definitions(LIBRARY)["loan.desk"].outgoing
    assert (out.base_uri, out.map_all, out.constructions[0].args) == ("urn:library:", False, ("isbn", "-", ""))
    ident, book, days = out.property_mappings
    assert ident.is_identity and not ident.is_reference and ident.uri_value_pattern == "urn:library:loan/{value}"
    assert book.is_reference and book.entity_property == "book" and not book.required and book.default_value is None
    assert (days.datatype, days.default_value, days.required) == ("number(5,1)", 14, True)


def test_incoming_fields():
    ident, left, seen, home, initials = load_definitions(LIBRARY)["members"].column_mappings()
    assert ident.is_identity and left.is_deleted and seen.is_recorded and home.is_reference and home.required
    assert initials.custom_expression.startswith("$1:props") and initials.datatype == "varchar(4)"


def test_definitions_may_be_wrapped_or_missing():
    assert list(load_definitions({"id": "cfg", "data": LIBRARY})) == ["shelf", "loan.desk", "members"]
    assert load_definitions({"data": {}}) == {} and load_definitions("{}") == {}


def test_unknown_construction_is_an_error():
    bad = {"name": "x", "outgoing_mapping_config": {"constructions": [{"property": "p", "operation": "concat", "args": ["a", "b", "c"]}]}}
    with pytest.raises(ValueError, match="concat"):
        load_definitions({"dataset_definitions": [bad]})


def test_resolution():
    defs = load_definitions(LIBRARY)
    assert resolve("shelf", defs, "CITY", "PUBLIC").source.schema == "stock"
    assert resolve("shelf", defs, "CITY", "PUBLIC").source.table_name == "shelf"
    assert resolve("loan.desk", defs, "CITY", "PUBLIC").source.database == "CITY"  # a definition goes before the three-part rule
    three = resolve("city.public.visits", defs, "CITY", "PUBLIC")
    assert (three.source.table_name, three.source.raw_column, three.name) == ("visits", "ENTITY", "city.public.visits")
    two = resolve("night.visits", defs, "CITY", "PUBLIC")
    assert (two.source.table_name, two.source.schema, two.name) == ("night_visits", "PUBLIC", "CITY.PUBLIC.night.visits")
    with pytest.raises(PermissionError):
        resolve("TOWN.PUBLIC.visits", defs, "CITY", "PUBLIC")


@pytest.mark.parametrize(
    ("name", "ddl"),
    [
        (None, "string"), ("VARCHAR(255)", "string"), ("char(1)", "string"), (" Text ", "string"), ("Integer", "bigint"), ("number", "bigint"),
        ("number(38, 2)", "decimal(38,2)"), ("NUMERIC(10)", "decimal(10,0)"), ("decimal(9,9)", "decimal(9,9)"), ("timestamp_ntz(9)", "timestamp_ntz"),
        ("timestamp_tz(3)", "timestamp"), ("time(0)", "string"), ("binary(16)", "binary"), ("array<string>", "array<string>"), ("tinyint", "tinyint"),
    ],
)
def test_types(spark, name, ddl):
    assert spark_type(name) == ddl


@pytest.mark.parametrize("name", ["geography", "number(40,2)", "decimal(5,6)", "varchar("])
def test_unknown_types_are_errors(spark, name):
    with pytest.raises(ValueError):
        spark_type(name)
