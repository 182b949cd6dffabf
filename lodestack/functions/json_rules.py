"""JSON schemas as Columns over VARIANT: what of a value a schema forbids, without Python workers."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _empty() -> Column:
    return F.array().cast("array<string>")


def _when(condition: Column, message: Column) -> Column:
    return F.when(condition, F.array(message)).otherwise(_empty())


def kind(v: Column) -> Column:
    """string, boolean, number, object, array or null, of a VARIANT."""
    told = F.schema_of_variant(v)
    return (
        F.when(F.is_variant_null(v), "null")
        .when(told == "STRING", "string")
        .when(told == "BOOLEAN", "boolean")
        .when(F.startswith(told, F.lit("OBJECT")), "object")
        .when(F.startswith(told, F.lit("ARRAY")), "array")
        .otherwise("number")
    )


def number(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def is_value(v: Column, own: Column, value: object) -> Column:
    """Whether a VARIANT of kind ``own`` is a JSON value; true and 1 are one, as they are in Python."""
    if value is None:
        return own == "null"
    if isinstance(value, str):
        return (own == "string") & F.coalesce(F.try_variant_get(v, "$", "string") == value, F.lit(False))
    if isinstance(value, bool | int | float):
        as_number = F.when(own == "number", number(v)).when(own == "boolean", F.try_variant_get(v, "$", "boolean").cast("double"))
        return F.coalesce(as_number == float(value), F.lit(False))
    return F.to_json(v) == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _fits_type(v: Column, own: Column, name: str) -> Column:
    if name == "integer":
        return (own == "number") & (number(v) == F.floor(number(v)))
    return own == name


def errors(v: Column, schema: dict, path: Column | str = "$") -> Column:
    """What a JSON schema forbids of a VARIANT, each with its path, unsorted: types, required, extra and enumerated values, bounds and items."""
    path = F.lit(path) if isinstance(path, str) else path
    own = kind(v)
    said = lambda text: F.concat(path, F.lit(f": {text}"))
    before, after = [], []
    if "anyOf" in schema:
        none_fits = F.lit(True)
        for option in schema["anyOf"]:
            none_fits = none_fits & (F.size(errors(v, option, path)) > 0)
        before.append(_when(none_fits, said("fits none of the options")))
    if "enum" in schema:
        hit = F.lit(False)
        for value in schema["enum"]:
            hit = hit | is_value(v, own, value)
        after.append(_when(~hit, said(f"is not one of {schema['enum']}")))
    if "const" in schema:
        after.append(_when(~is_value(v, own, schema["const"]), said(f"is not {schema['const']!r}")))
    text = F.when(own == "string", F.try_variant_get(v, "$", "string"))
    if schema.get("minLength", 0) > 0:
        after.append(_when(F.length(text) < schema["minLength"], said("is too short")))
    if "pattern" in schema:
        after.append(_when(~text.rlike(schema["pattern"]), said(f"does not match {schema['pattern']}")))
    amount = F.when(own == "number", number(v))
    for name, off, words in (("minimum", lambda a, b: a < b, "less"), ("maximum", lambda a, b: a > b, "greater")):
        if name in schema:
            after.append(_when(off(amount, F.lit(float(schema[name]))), said(f"is {words} than {schema[name]}")))
    after += _of_object(v, own, schema, path, said) + _of_array(v, own, schema, path, said)
    found = F.concat(*after) if after else _empty()
    kinds = schema.get("type")
    if kinds is not None:
        listed = [kinds] if isinstance(kinds, str) else list(kinds)
        fits = F.lit(False)
        for name in listed:
            fits = fits | _fits_type(v, own, name)
        found = F.when(fits, found).otherwise(F.array(said(f"is not of type {' or '.join(listed)}")))
    return F.concat(*before, found)


def _of_object(v: Column, own: Column, schema: dict, path: Column, said: Callable[[str], Column]) -> list[Column]:
    held = F.when(own == "object", F.try_variant_get(v, "$", "map<string,variant>"))
    known, out = schema.get("properties", {}), []
    for name in schema.get("required", ()):
        out.append(_when(~F.map_contains_key(held, name), said(f"lacks {name}")))
    if schema.get("additionalProperties") is False:
        extra = F.array_except(F.map_keys(held), F.array(*map(F.lit, known)).cast("array<string>"))
        out.append(F.coalesce(F.transform(extra, lambda k: F.concat(path, F.lit(": has no place for "), k)), _empty()))
    for name, rule in known.items():
        inside = errors(F.try_element_at(held, F.lit(name)), rule, F.concat(path, F.lit(f".{name}")))
        out.append(F.when(F.map_contains_key(held, name), inside).otherwise(_empty()))
    return out


def _of_array(v: Column, own: Column, schema: dict, path: Column, said: Callable[[str], Column]) -> list[Column]:
    items, out = F.when(own == "array", F.try_variant_get(v, "$", "array<variant>")), []
    if schema.get("minItems", 0) > 0:
        out.append(_when(F.size(items) < schema["minItems"], said("has too few items")))
    if isinstance(schema.get("items"), dict):
        each = F.transform(items, lambda x, n: errors(x, schema["items"], F.concat(path, F.lit("["), n.cast("string"), F.lit("]"))))
        out.append(F.coalesce(F.flatten(each), _empty()))
    return out


def json_errors(text: Column, schema: dict) -> Column:
    """The sorted errors of a text as JSON by a schema; ``$: is not JSON`` if it can't be parsed, null for null."""
    v = F.try_parse_json(text)
    return F.when(text.isNotNull(), F.when(v.isNull(), F.array(F.lit("$: is not JSON"))).otherwise(F.array_sort(errors(v, schema))))
