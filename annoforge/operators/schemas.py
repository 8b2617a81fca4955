"""JSON documents against a JSON schema, compiled to column expressions over VARIANT.

A schema becomes one expression that gives the violations of a document as (path, rule): no row leaves the JVM and no
document is parsed twice. Supported: type, enum, const, required, properties, additionalProperties, minProperties,
maxProperties, items, minItems, maxItems, minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum,
exclusiveMaximum, multipleOf, allOf, anyOf, oneOf, not, and $ref to the schema's own definitions where these do not
refer to themselves. A keyword that is not supported fails the compilation: nothing is passed over in silence.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keywords that say nothing about validity.
NOTES = {"$schema", "$id", "title", "description", "default", "examples", "definitions", "$defs", "$comment", "format"}
TYPES = ("object", "array", "string", "number", "integer", "boolean", "null")
FOUND = "array<struct<path:string,rule:string>>"


class SchemaError(ValueError):
    """A schema that cannot be compiled."""


def kind(v: Column) -> Column:
    """JSON type of a variant: one of TYPES, integer for whole numbers."""
    name = F.schema_of_variant(v)
    whole = F.try_variant_get(v, "$", "decimal(38,18)")
    return (
        F.when(F.is_variant_null(v) | v.isNull(), "null")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name == "BIGINT", "integer")
        .when(whole.isNotNull() & (whole == F.floor(whole)), "integer")
        .otherwise("number")
    )


class Compiler:
    def __init__(self, schema: dict | bool):
        self.root = schema

    def errors(self, schema: dict | bool, v: Column, path: Column, seen: tuple[str, ...] = ()) -> Column:
        """Violations of a value that is there, as an array of (path, rule)."""
        if schema is True:
            return empty()
        if schema is False:
            return failed(F.lit(True), path, "not allowed")
        unknown = set(schema) - NOTES - set(self.rules())
        if unknown:
            raise SchemaError("unsupported: " + ", ".join(sorted(unknown)))
        if "$ref" in schema:
            return self.referred(schema["$ref"], v, path, seen)
        found = [rule(self, schema, v, path, seen) for name, rule in self.rules().items() if name in schema and rule]
        if schema.get("additionalProperties") is not None and "properties" not in schema:
            found.append(Compiler.properties(self, schema, v, path, seen))
        return F.concat(*found) if found else empty()

    def referred(self, ref: str, v: Column, path: Column, seen: tuple[str, ...]) -> Column:
        if ref in seen:
            raise SchemaError(f"{ref} refers to itself")
        if not ref.startswith("#"):
            raise SchemaError(f"{ref} is not in the schema")
        target = self.root
        for part in ref[1:].strip("/").split("/") if ref != "#" else []:
            part = part.replace("~1", "/").replace("~0", "~")
            if not isinstance(target, dict) or part not in target:
                raise SchemaError(f"{ref} is not in the schema")
            target = target[part]
        return self.errors(target, v, path, (*seen, ref))

    def type(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        wanted = [schema["type"]] if isinstance(schema["type"], str) else list(schema["type"])
        if set(wanted) - set(TYPES):
            raise SchemaError(f"no such type: {wanted}")
        more = ["integer"] if "number" in wanted else []
        return failed(~kind(v).isin(*wanted, *more), path, "type")

    def enum(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        values = schema["enum"] if "enum" in schema else [schema["const"]]
        return failed(~any_of([equals(v, x) for x in values]), path, "enum" if "enum" in schema else "const")

    def string(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        text, own = F.try_variant_get(v, "$", "string"), kind(v) == "string"
        checks = {"minLength": lambda n: F.char_length(text) < n, "maxLength": lambda n: F.char_length(text) > n, "pattern": lambda p: ~text.rlike(p)}
        return F.concat(*[failed(own & check(schema[k]), path, k) for k, check in checks.items() if k in schema])

    def number(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        value, own = F.try_variant_get(v, "$", "double"), kind(v).isin("number", "integer")
        exact = F.try_variant_get(v, "$", "decimal(38,18)")
        checks = {
            "minimum": lambda n: value < n, "maximum": lambda n: value > n, "exclusiveMinimum": lambda n: value <= n, "exclusiveMaximum": lambda n: value >= n,
            "multipleOf": lambda n: exact % F.lit(str(n)).cast("decimal(38,18)") != 0,
        }
        return F.concat(*[failed(own & F.coalesce(check(schema[k]), F.lit(False)), path, k) for k, check in checks.items() if k in schema])

    def required(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        own, there = kind(v) == "object", names(v)
        return F.concat(*[failed(own & ~F.coalesce(F.array_contains(there, name), F.lit(False)), F.concat(path, F.lit("." + name)), "required") for name in schema["required"]], empty())

    def properties(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        held, there = F.try_variant_get(v, "$", "map<string,variant>"), names(v)
        given = schema.get("properties", {})
        found = [F.when(F.coalesce(F.array_contains(there, name), F.lit(False)), self.errors(part, F.element_at(held, F.lit(name)), F.concat(path, F.lit("." + name)), seen)).otherwise(empty()) for name, part in given.items()]
        rest = schema.get("additionalProperties", True)
        if rest is not True:
            others = F.filter(there, lambda n: ~n.isin(*given) if given else F.lit(True))
            found.append(F.when(kind(v) == "object", F.flatten(F.transform(others, lambda n: self.errors(rest, F.element_at(held, n), F.concat(path, F.lit("."), n), seen)))).otherwise(empty()))
        return F.concat(*found, empty())

    def sizes(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        n_items, n_names = F.size(F.try_variant_get(v, "$", "array<variant>")), F.size(names(v))
        checks = {"minItems": ("array", lambda n: n_items < n), "maxItems": ("array", lambda n: n_items > n), "minProperties": ("object", lambda n: n_names < n), "maxProperties": ("object", lambda n: n_names > n)}
        return F.concat(*[failed((kind(v) == own) & check(schema[k]), path, k) for k, (own, check) in checks.items() if k in schema])

    def items(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        if isinstance(schema["items"], list):
            raise SchemaError("items must be one schema")
        held = F.try_variant_get(v, "$", "array<variant>")
        each = F.transform(held, lambda x, i: self.errors(schema["items"], x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), seen))
        return F.when(kind(v) == "array", F.flatten(each)).otherwise(empty())

    def combined(self, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        found = [self.errors(part, v, path, seen) for part in schema.get("allOf", [])]
        good = {k: [F.size(self.errors(part, v, path, seen)) == 0 for part in schema[k]] for k in ("anyOf", "oneOf") if k in schema}
        if "anyOf" in good:
            found.append(failed(~any_of(good["anyOf"]), path, "anyOf"))
        if "oneOf" in good:
            found.append(failed(sum((g.cast("int") for g in good["oneOf"]), F.lit(0)) != 1, path, "oneOf"))
        if "not" in schema:
            found.append(failed(F.size(self.errors(schema["not"], v, path, seen)) == 0, path, "not"))
        return F.concat(*found)

    @staticmethod
    def rules() -> dict:
        """Rule by keyword; of keywords that one rule reads together, the first that a schema has calls it."""
        c = Compiler
        groups = {c.type: ["type"], c.enum: ["enum"], c.required: ["required"], c.properties: ["properties"], c.items: ["items"]}
        out = {name: rule for rule, names_ in groups.items() for name in names_}
        out["const"] = c.enum
        out |= {"$ref": None, "additionalProperties": None}
        for rule, keys in ((c.string, ("minLength", "maxLength", "pattern")), (c.number, ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf")), (c.sizes, ("minItems", "maxItems", "minProperties", "maxProperties")), (c.combined, ("allOf", "anyOf", "oneOf", "not"))):
            for k in keys:
                out[k] = first_of(rule, k, keys)
        return out


def first_of(rule, own: str, keys: tuple[str, ...]):
    def run(compiler: Compiler, schema: dict, v: Column, path: Column, seen: tuple) -> Column:
        return rule(compiler, schema, v, path, seen) if next(k for k in keys if k in schema) == own else empty()

    return run


def empty() -> Column:
    return F.array().cast(FOUND)


def failed(broken: Column, path: Column, rule: str) -> Column:
    one = F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule")))
    return F.when(F.coalesce(broken, F.lit(False)), one).otherwise(empty())


def any_of(parts: list[Column]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.coalesce(p, F.lit(False))
    return out


def names(v: Column) -> Column:
    """Names of an object's members, null for anything else."""
    return F.when(kind(v) == "object", F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")))


def equals(v: Column, value: object) -> Column:
    """Whether a variant is a JSON value: numbers by value, all else by its one spelling."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        own = {bool: "boolean", str: "string", type(None): "null"}[type(value)]
        return (kind(v) == own) & (F.lit(True) if value is None else F.try_variant_get(v, "$", own) == F.lit(value))
    if isinstance(value, (int, float)):
        return kind(v).isin("integer", "number") & (F.try_variant_get(v, "$", "double") == F.lit(float(value)))
    return F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(value))))


def violations(rows: DataFrame, document: str, schema: dict, key: str) -> DataFrame:
    """(key, path, rule) of every violation of the documents in a text column; text that is no JSON breaks the rule `json`.

    A null document counts as no JSON."""
    v = F.col("_v")
    parsed = rows.select(F.col(key), F.try_parse_json(F.col(document).cast("string")).alias("_v"))
    found = F.when(v.isNull(), failed(F.lit(True), F.lit("$"), "json")).otherwise(Compiler(schema).errors(schema, v, F.lit("$")))
    return parsed.select(key, F.explode(found).alias("e")).select(key, "e.path", "e.rule")
