"""Validation of nested rows against a declared schema: each broken rule is a row with the path of its element.

A schema is a document in the form of JSON Schema. It is compiled into one column: arrays are walked by higher-order
functions, so that a row is validated where it stands, with one explode for its violations and no shuffle. Columns are
typed, so a missing field and a null one are the same: null breaks `required` unless the schema allows null, and no other rule.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

Schema = Mapping[str, object]

UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"
ROOT = "<root>"
_ENTRY = "array<struct<place: string, path: string, rule: string, value: string>>"
_SUPPORTED = {"const", "enum", "pattern", "minimum", "maximum", "minLength", "maxLength", "format", "minItems", "maxItems", "uniqueItems", "items", "properties", "required", "additionalProperties", "type", "oneOf", "anyOf", "$ref"}
_SILENT = {"description", "title", "default", "examples", "$schema", "$id", "$defs", "$comment", "nullable"}


def load_schema(spark: SparkSession, path: str) -> Schema:
    """A schema from a JSON file."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _resolved(spec: Schema, root: Schema) -> Schema:
    """The schema that a reference within the document stands for; a choice between one schema and null is that schema, nullable."""
    while "$ref" in spec:
        target: object = root
        for part in str(spec["$ref"]).removeprefix("#/").split("/"):
            target = target[part]  # type: ignore[index]
        spec = target  # type: ignore[assignment]
    for choice in ("oneOf", "anyOf"):
        if choice in spec:
            real = [x for x in spec[choice] if x.get("type") != "null"]  # type: ignore[attr-defined]
            if len(real) != 1:
                raise ValueError(f"{choice} of several schemas isn't supported")
            return {**_resolved(real[0], root), "nullable": True}
    kind = spec.get("type")
    if isinstance(kind, list):
        return {**spec, "nullable": "null" in kind}
    if "enum" in spec and None in spec["enum"]:  # type: ignore[operator]
        return {**spec, "nullable": True}
    unknown = spec.keys() - _SUPPORTED - _SILENT
    if unknown:
        raise ValueError(f"unsupported rules: {sorted(unknown)}")
    return spec


def _text(value: Column, kind: DataType) -> Column:
    return F.to_json(value) if isinstance(kind, (ArrayType, StructType, MapType, VariantType)) else value.cast("string")


def _own(spec: Schema, value: Column, kind: DataType) -> dict[str, Column]:
    """When each rule of one element is broken; null where it is null."""
    text = value.cast("string")
    tests = {
        "const": lambda a: value != F.lit(a),
        "enum": lambda a: ~value.isin(*[x for x in a if x is not None]),
        "pattern": lambda a: ~text.rlike(a),
        "minimum": lambda a: value < F.lit(a),
        "maximum": lambda a: value > F.lit(a),
        "minLength": lambda a: F.char_length(text) < a,
        "maxLength": lambda a: F.char_length(text) > a,
        "format": lambda a: ~text.rlike(UTC) if a == "date-time" else F.lit(False),
        "minItems": lambda a: F.size(value) < a,
        "maxItems": lambda a: F.size(value) > a,
        "uniqueItems": lambda a: (F.size(F.array_distinct(value)) < F.size(value)) & F.lit(bool(a)),
    }
    return {name: test(spec[name]) for name, test in tests.items() if name in spec}


def _entry(broken: Column, place: Column, path: Column, rule: str, value: Column) -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.struct(place.alias("place"), path.alias("path"), F.lit(rule).alias("rule"), value.alias("value")))


def _below(path: Column | None, name: str | Column) -> Column:
    """The path of an element below another; each path occurs once in it, so that its size is that of the depth."""
    name = F.lit(name) if isinstance(name, str) else name
    return name if path is None else F.concat(path, F.lit("/"), name)


def _checked(spec: Schema, root: Schema, kind: DataType, value: Column, place: Column | None, path: Column | None) -> Column:
    """The violations of an element and all below it, as an array. The row as a whole has no place and no path."""
    spec = _resolved(spec, root)
    own = [_entry(test, F.lit("") if place is None else place, F.lit(ROOT) if path is None else path, rule, _text(value, kind)) for rule, test in _own(spec, value, kind).items()]
    nested: list[Column] = []
    if isinstance(kind, StructType):
        known: Mapping[str, Schema] = spec.get("properties", {})  # type: ignore[assignment]
        types = {f.name: f.dataType for f in kind.fields}
        for name in spec.get("required", ()):  # type: ignore[attr-defined]
            if not _resolved(known.get(name, {}), root).get("nullable"):
                missing = value[name].isNull() if name in types else F.lit(True)
                own.append(_entry(value.isNotNull() & missing, _below(place, name), _below(path, name), "required", F.lit(None).cast("string")))
        for name, own_kind in types.items():
            if name in known:
                nested.append(_checked(known[name], root, own_kind, value[name], _below(place, name), _below(path, name)))
            elif spec.get("additionalProperties") is False:
                own.append(_entry(value[name].isNotNull(), _below(place, name), _below(path, name), "additionalProperties", _text(value[name], own_kind)))
    elif isinstance(kind, ArrayType) and "items" in spec:
        each = lambda x, i: _checked(spec["items"], root, kind.elementType, x, _below(place, F.lpad(i.cast("string"), 10, "0")), _below(path, i.cast("string")))
        nested.append(F.flatten(F.transform(value, each)))
    none = F.array().cast(_ENTRY)
    lists = ([F.array_compact(F.array(*own)).cast(_ENTRY)] if own else []) + [F.coalesce(x, none) for x in nested]
    return F.concat(*lists) if lists else none


def nested_violations(df: DataFrame, key: str, schema: Schema, severity: str = "error") -> DataFrame:
    """key, n (from 0, in the order of paths, elements by number), path, rule, value and severity of every broken rule of every row.

    Paths go down to elements, as in orders/3/lines/0/qty; a rule of the row as a whole has the path <root>. The key is no part of the row unless
    the schema declares it. A row without violations has no rows here; an empty table gives an empty one.
    """
    root = {**schema, "properties": schema.get("properties", {})}
    fields = [f for f in df.schema.fields if f.name != key or key in root["properties"]]  # type: ignore[operator]
    row = F.struct(*(F.col(f"`{f.name}`") for f in fields))
    found = _checked(root, root, StructType(fields), row, None, None)
    listed = df.select(F.col(key).alias("key"), F.posexplode(F.array_sort(found)).alias("n", "v"))
    return listed.select("key", "n", "v.path", "v.rule", "v.value", F.lit(severity).alias("severity"))
