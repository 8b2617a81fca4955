"""JSON schemas compiled to columns against a plain recursive validator on generated documents."""

import json
import random
import re

import pytest

from annoforge.operators import schemas as S

SCHEMA = {
    "$schema": "any", "type": "object", "required": ["id", "state"], "additionalProperties": False,
    "definitions": {"tag": {"type": "string", "minLength": 1, "maxLength": 3, "pattern": "^[a-c]*$"}, "point": {"type": "array", "items": {"type": "number", "minimum": 0, "exclusiveMaximum": 10}, "minItems": 1, "maxItems": 2}},
    "properties": {
        "id": {"type": "integer", "minimum": 1, "multipleOf": 2}, "state": {"enum": ["open", "done", None, 3, True]}, "tags": {"type": "array", "items": {"$ref": "#/definitions/tag"}, "maxItems": 3},
        "at": {"$ref": "#/definitions/point"}, "kind": {"const": "x"}, "more": {"type": "object", "additionalProperties": {"type": ["integer", "null"]}, "minProperties": 1, "maxProperties": 2},
        "any": {"anyOf": [{"type": "string"}, {"type": "integer", "maximum": 5}]}, "one": {"oneOf": [{"type": "number"}, {"type": "integer"}, {"minLength": 2}]}, "no": {"not": {"type": "string"}},
        "all": {"allOf": [{"type": "integer"}, {"exclusiveMinimum": 1}]}, "deep": {"properties": {"a": {"properties": {"b": {"type": "boolean"}}, "required": ["b"]}}},
        "list": {"enum": [[1, 2], {"k": "v"}]},
    },
}


def kind(v):
    if isinstance(v, bool):
        return {"boolean"}
    if isinstance(v, (int, float)):
        return {"number", "integer"} if v == int(v) else {"number"}
    return {{dict: "object", list: "array", str: "string", type(None): "null"}[type(v)]}


def same(a, b):
    return type(a) is type(b) and a == b if isinstance(a, (bool, str, type(None), list, dict)) or isinstance(b, (bool, str, type(None), list, dict)) else a == b


def check(schema, v, path, root):
    if schema is True:
        return []
    if schema is False:
        return [(path, "not allowed")]
    if "$ref" in schema:
        target = root
        for part in schema["$ref"][2:].split("/"):
            target = target[part]
        return check(target, v, path, root)
    out, k = [], kind(v)

    def bad(cond, rule, at=path):
        if cond:
            out.append((at, rule))

    if "type" in schema:
        bad(not k & set([schema["type"]] if isinstance(schema["type"], str) else schema["type"]), "type")
    if "enum" in schema:
        bad(not any(same(v, x) for x in schema["enum"]), "enum")
    if "const" in schema:
        bad(not same(v, schema["const"]), "const")
    if "string" in k:
        bad("minLength" in schema and len(v) < schema["minLength"], "minLength")
        bad("maxLength" in schema and len(v) > schema["maxLength"], "maxLength")
        bad("pattern" in schema and not re.search(schema["pattern"], v), "pattern")
    if "number" in k:
        bad("minimum" in schema and v < schema["minimum"], "minimum")
        bad("maximum" in schema and v > schema["maximum"], "maximum")
        bad("exclusiveMinimum" in schema and v <= schema["exclusiveMinimum"], "exclusiveMinimum")
        bad("exclusiveMaximum" in schema and v >= schema["exclusiveMaximum"], "exclusiveMaximum")
        bad("multipleOf" in schema and v % schema["multipleOf"] != 0, "multipleOf")
    if "array" in k:
        bad("minItems" in schema and len(v) < schema["minItems"], "minItems")
        bad("maxItems" in schema and len(v) > schema["maxItems"], "maxItems")
        for i, x in enumerate(v if "items" in schema else []):
            out += check(schema["items"], x, f"{path}[{i}]", root)
    if "object" in k:
        bad("minProperties" in schema and len(v) < schema["minProperties"], "minProperties")
        bad("maxProperties" in schema and len(v) > schema["maxProperties"], "maxProperties")
        for name in schema.get("required", []):
            bad(name not in v, "required", f"{path}.{name}")
        for name, x in v.items():
            part = schema.get("properties", {}).get(name, schema.get("additionalProperties", True))
            out += check(part, x, f"{path}.{name}", root)
    for part in schema.get("allOf", []):
        out += check(part, v, path, root)
    bad("anyOf" in schema and all(check(p, v, path, root) for p in schema.get("anyOf", [])), "anyOf")
    bad("oneOf" in schema and sum(not check(p, v, path, root) for p in schema.get("oneOf", [])) != 1, "oneOf")
    bad("not" in schema and not check(schema.get("not"), v, path, root), "not")
    return out


def value(rng, depth=0):
    kinds = [lambda: rng.randint(-2, 12), lambda: rng.choice([0.5, 2.0, 9.75, -1.5]), lambda: rng.choice(["", "a", "ab", "abcd", "z", "x", "open"]), lambda: rng.choice([True, False]), lambda: None]
    if depth < 3:
        kinds += [lambda: [value(rng, depth + 1) for _ in range(rng.randint(0, 4))], lambda: {rng.choice("abkv"): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}]
    return rng.choice(kinds)()


def document(rng):
    good = {"id": 2, "state": "open", "tags": ["a", "abc"], "at": [1, 2.5], "kind": "x", "more": {"a": 1}, "any": "s", "one": 1.5, "no": 1, "all": 3, "deep": {"a": {"b": True}}, "list": [1, 2]}
    d = {k: v if rng.random() < 0.5 else value(rng) for k, v in good.items() if rng.random() < 0.8}
    if rng.random() < 0.2:
        d["extra"] = value(rng)
    return d if rng.random() < 0.95 else value(rng)


def test_violations_equal_a_plain_validator(spark):
    rng = random.Random(11)
    docs = [document(rng) for _ in range(400)]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(1000, "{not json"), (1001, None), (1002, json.dumps({"id": 2, "state": None}))]
    got = sorted((r["id"], r["path"], r["rule"]) for r in S.violations(spark.createDataFrame(rows, "id int, doc string"), "doc", SCHEMA, "id").collect())
    want = sorted((i, *e) for i, d in enumerate(docs) for e in check(SCHEMA, d, "$", SCHEMA))
    assert got == sorted([*want, (1000, "$", "json"), (1001, "$", "json")]) and len(want) > 300


def test_schemas_that_cannot_be_compiled_are_refused(spark):
    rows = spark.createDataFrame([(1, "{}")], "id int, doc string")
    for schema, message in [({"dependencies": {}}, "unsupported: dependencies"), ({"type": "thing"}, "no such type"), ({"$ref": "#"}, "refers to itself"), ({"$ref": "other.json"}, "not in the schema"), ({"$ref": "#/definitions/x"}, "not in the schema"), ({"items": [True]}, "one schema")]:
        with pytest.raises(S.SchemaError, match=message):
            S.violations(rows, "doc", schema, "id")
    assert S.violations(rows, "doc", {"properties": {"a": False}, "title": "t"}, "id").count() == 0
