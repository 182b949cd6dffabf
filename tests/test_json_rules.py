"""Schemas as Columns against the same rules in Python."""

import json
import random

from pyspark.sql import functions as F

from lodestack.functions import json_rules
from lodestack.operators import evaluation, extraction, json_tree

SCHEMAS = [
    {"type": "object", "required": ["a", "b"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 1, "maximum": 5}, "b": {"type": "array", "minItems": 2, "items": {"type": ["string", "null"], "minLength": 2, "pattern": "^x"}}, "c": {"enum": ["x", 1, None, False]}}},
    {"anyOf": [{"type": "string", "minLength": 3}, {"type": "number", "minimum": 2.5}, {"const": {"a": 1}}]},
    {"type": "array", "items": {"type": "object", "properties": {"a": {"type": "array", "items": {"type": "boolean"}}}}},
    {"const": "x"},
]


def value(rng, depth=0):
    plain = [None, True, False, 0, 1, 2, 5, 6, 2.0, 2.5, -3.25, "", "x", "xy", "é y", "y"]
    if depth > 2 or rng.random() < 0.35:
        return rng.choice(plain)
    if rng.random() < 0.4:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {k: value(rng, depth + 1) for k in rng.sample("abcd", rng.randint(0, 4))}


def test_like_the_rules_in_python(spark):
    rng = random.Random(7)
    values = [value(rng) for _ in range(400)] + [{"a": 3, "b": ["xx", None]}, {"a": 1}, {"a": 3.0, "b": ["xx", "xyz"], "c": None}]
    rows = [(k, json.dumps(v)) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k long, text string")
    for schema in SCHEMAS:
        checked = df.select("k", json_rules.json_errors(F.col("text"), schema).alias("errors"))
        assert "Python" not in checked._jdf.queryExecution().executedPlan().toString()
        for r in checked.collect():
            assert r.errors == extraction.json_errors(values[r.k], schema), (values[r.k], schema)


def test_texts_that_are_not_json(spark):
    df = spark.createDataFrame([("{",), (None,), ("1",)], "t string")
    assert [r[0] for r in df.select(json_rules.json_errors(F.col("t"), {"type": "object"})).collect()] == [["$: is not JSON"], None, ["$: is not of type object"]]


def test_leaves_of_large_and_deep_values(spark):
    """Level by level as recursively, for values that are near each other."""
    rng = random.Random(3)

    def near(v):
        if isinstance(v, dict):
            return {k: near(x) for k, x in v.items() if rng.random() < 0.85}
        if isinstance(v, list):
            return [near(x) for x in v if rng.random() < 0.9] + [value(rng, 2)] * (rng.random() < 0.3)
        return v if rng.random() < 0.8 else value(rng, 2)

    values = [value(rng) for _ in range(200)] + [list(range(3000)), {"a": {"b": {"c": {"d": [[[1, "x"]]]}}}}]
    rows = [(k, json.dumps(v), json.dumps(near(v))) for k, v in enumerate(values)] + [(900, None, "1"), (901, "{", "1")]
    out = json_tree.agreement(spark.createDataFrame(rows, "k long, e string, a string"), "e", "a")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        e, a = (None, None) if r.k >= 900 else (json.loads(r.e), json.loads(r.a))
        assert (r.expected_leaves, r.matched_leaves) == ((None, None) if r.k >= 900 else (evaluation.leaves(e), evaluation.agreeing_leaves(e, a)))


def test_fixtures_without_expected_or_found_records(spark):
    schema = "fixture long, record_type string, payload string"
    expected = spark.createDataFrame([(1, "t", '{"b": " x  y", "a": 1, "doc": 5}'), (1, "t", '{"a": 0, "b": null}'), (2, "t", "{}"), (4, "t", '{"a": null}')], schema)
    actual = spark.createDataFrame([(1, "t", '{"a": 1, "b": "x y", "doc": 6}'), (1, "t", '{"a": 0}'), (3, "t", "1"), (2, "t", "{}")], schema)
    got = {r.fixture: (r.total, r.matched, r.score) for r in evaluation.field_accuracy(expected, actual, ("doc",)).collect()}
    assert got == {1: (4, 4, 100.0), 2: (0, 0, 100.0), 3: (0, 0, 0.0), 4: (1, 0, 0.0)}
