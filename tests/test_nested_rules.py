"""Rules of every kind, on elements of arrays within arrays."""

import json

import pytest

from ironsift.operators.nested_rules import load_schema, nested_violations

CITED = {"type": "object", "required": ["file", "line"], "additionalProperties": False, "properties": {"file": {"type": "string", "minLength": 1}, "line": {"type": "integer", "minimum": 1}}}
SCHEMA = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "required": ["findings", "gone"],
    "properties": {
        "gone": {"type": "string"},
        "findings": {
            "maxItems": 12,
            "items": {
                "required": ["id", "chain", "code"],
                "properties": {
                    "id": {"pattern": r"^F-\d{3,}$"},
                    "code": {"oneOf": [{"pattern": "^0x[a-f0-9]{1,8}$"}, {"type": "null"}]},
                    "chain": {"minItems": 1, "uniqueItems": True, "items": {"$ref": "#/$defs/cited"}},
                    "tags": {"type": ["array", "null"], "items": {"enum": ["a", "b", None]}},
                },
            },
        },
    },
    "$defs": {"cited": CITED},
}
KIND = "key long, findings array<struct<id: string, code: string, chain: array<struct<file: string, line: int, more: string>>, tags: array<string>>>"


def violations(spark, rows, schema=None):
    return [(r.key, r.n, r.path, r.rule, r.value) for r in nested_violations(spark.createDataFrame(rows, KIND), "key", schema or SCHEMA).orderBy("key", "n").collect()]


def test_paths_and_order(spark):
    good = ("F-001", None, [("x", 1, None)], None)
    bad = ("f", "0xG", [("x", 0, None), ("", None, "m"), ("x", 0, None)], ["a", "c", None])
    got = violations(spark, [(1, [good] * 11 + [bad]), (2, None), (3, [("F-1", "0x1", [], [])]), (4, [None, good])])
    assert got == [
        (1, 0, "findings/11/chain", "uniqueItems", '[{"file":"x","line":0},{"file":"","more":"m"},{"file":"x","line":0}]'),
        (1, 1, "findings/11/chain/0/line", "minimum", "0"),
        (1, 2, "findings/11/chain/1/file", "minLength", ""),
        (1, 3, "findings/11/chain/1/line", "required", None),
        (1, 4, "findings/11/chain/1/more", "additionalProperties", "m"),
        (1, 5, "findings/11/chain/2/line", "minimum", "0"),
        (1, 6, "findings/11/code", "pattern", "0xG"),
        (1, 7, "findings/11/id", "pattern", "f"),
        (1, 8, "findings/11/tags/1", "enum", "c"),
        (1, 9, "gone", "required", None),
        (2, 0, "findings", "required", None),
        (2, 1, "gone", "required", None),
        (3, 0, "findings/0/chain", "minItems", "[]"),
        (3, 1, "findings/0/id", "pattern", "F-1"),
        (3, 2, "gone", "required", None),
        (4, 0, "gone", "required", None),
    ]


def test_elements_sort_by_number(spark):
    rows = [(1, [("bad", "0x1", [("x", 1, None)], None)] * 13)]
    got = [path for _, _, path, rule, _ in violations(spark, rows) if rule == "pattern"]
    assert got == [f"findings/{k}/id" for k in range(13)]
    assert (1, 0, "findings") == violations(spark, rows)[0][:3]  # maxItems


def test_empty_table_and_plan(spark):
    df = spark.createDataFrame([], KIND)
    assert nested_violations(df, "key", SCHEMA).collect() == []
    plan = nested_violations(df, "key", SCHEMA)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and plan.split("Physical Plan")[-1].count("Generate") == 1


def test_schema_file(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(SCHEMA))
    assert violations(spark, [(2, None)], load_schema(spark, f"{tmp_path}/s.json")) == violations(spark, [(2, None)])


def test_unsupported_rules(spark):
    df = spark.createDataFrame([], KIND)
    for spec in ({"multipleOf": 2}, {"oneOf": [{"type": "string"}, {"type": "integer"}]}):
        with pytest.raises(ValueError):
            nested_violations(df, "key", {"properties": {"findings": {"items": {"properties": {"id": spec}}}}})
