"""Values of JSON compared leaf by leaf, as levels of a tree: down by exploding VARIANTs, up by sums.

Each round takes the children of all values of a level; the number of rounds is the depth of the deepest value. A value
of any size is as many rows as it has parts, so a large one is spread like many small ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.functions.json_rules import kind, number
from lodestack.session import discard, materialize, unused


def same_value(a: Column, b: Column) -> Column:
    """Whether two VARIANTs that aren't both objects or arrays are equal; numbers are by value, and true is 1."""
    ka, kb = kind(a), kind(b)
    amount = lambda v, k: F.when(k == "number", number(v)).when(k == "boolean", F.try_variant_get(v, "$", "boolean").cast("double"))
    text = F.to_json(a) == F.to_json(b)
    near = (amount(a, ka) == amount(b, kb)) & (F.abs(amount(a, ka)) < 2.0**53)
    return ((ka == kb) & text) | F.coalesce(near, F.lit(False))


def _children(v: Column, w: Column, dead: Column) -> Column:
    """(side, e, a, dead) of each part of an object or array v beside the same part of w; what only w's array has comes as ``extra``."""
    ke, ka = kind(v), kind(w)
    null = F.parse_json(F.lit("null"))
    part = lambda side, e, a, off: F.struct(F.lit(side).alias("side"), e.alias("e"), a.alias("a"), off.alias("dead"))
    fields, others = F.try_variant_get(v, "$", "map<string,variant>"), F.try_variant_get(w, "$", "map<string,variant>")
    of_object = F.transform(F.map_entries(fields), lambda x: part("own", x["value"], F.when((ka == "object") & F.map_contains_key(others, x["key"]), F.try_element_at(others, x["key"])).otherwise(null), dead | (ka != "object")))
    items, found = F.try_variant_get(v, "$", "array<variant>"), F.when(ka == "array", F.try_variant_get(w, "$", "array<variant>"))
    many = F.coalesce(F.size(F.coalesce(found, F.array().cast("array<variant>"))), F.lit(0))
    listed = F.transform(items, lambda x, n: part("own", x, F.when(n < many, F.get(found, n)).otherwise(null), dead | (ka != "array") | (n >= many)))
    extra = F.transform(F.slice(found, F.size(items) + 1, F.greatest(many - F.size(items), F.lit(0))), lambda x: part("extra", x, null, F.lit(True)))
    kinds = "array<struct<side:string,e:variant,a:variant,dead:boolean>>"
    none = F.array().cast(kinds)
    of_array = F.concat(listed.cast(kinds), F.coalesce(F.when(~dead, extra).cast(kinds), none))
    return F.when(ke == "object", of_object.cast(kinds)).when(ke == "array", of_array).otherwise(none)


def agreement(df: DataFrame, expected: str, actual: str) -> DataFrame:
    """df with the leaves of the expected JSON and how many of them the actual JSON has: expected_leaves, matched_leaves (long).

    Objects agree by key, a missing one being null; arrays by place, less the leaves of what the actual array has more, 0 at
    least; a value of another kind has none. Text that isn't JSON, and null, is null.
    """
    stem = unused(df, "node")
    node = materialize(df.withColumn(stem, F.monotonically_increasing_id()), "json-rows")
    parsed = lambda c: F.coalesce(F.try_parse_json(F.col(c)), F.parse_json(F.lit("null")))
    level = node.select(F.col(stem).alias("id"), F.lit(None).cast("long").alias("parent"), F.lit("own").alias("side"), parsed(expected).alias("e"), parsed(actual).alias("a"), F.lit(False).alias("dead"))
    levels: list[DataFrame] = []
    while True:
        ke = kind(F.col("e"))
        told = level.select("id", "parent", "side", "dead", ke.isin("object", "array").alias("inner"), (ke == "array").alias("listed"), (~F.col("dead") & same_value(F.col("e"), F.col("a"))).cast("long").alias("hit"), F.when(ke.isin("object", "array"), _children(F.col("e"), F.col("a"), F.col("dead"))).alias("parts"))
        held = materialize(told, "json-level")
        levels.append(held)
        if not held.where(F.size("parts") > 0).limit(1).collect():
            break
        level = held.select(F.col("id").alias("parent"), F.explode("parts").alias("p")).select(F.monotonically_increasing_id().alias("id"), "parent", "p.side", "p.e", "p.a", "p.dead")
    below = None
    for held in reversed(levels):
        own = held.select("id", "parent", "side", "dead", "inner", "listed", "hit")
        if below is None:
            sums = own.select("*", F.when(F.col("inner"), 0).otherwise(1).alias("leaves"), F.when(F.col("inner"), 0).otherwise(F.col("hit")).alias("matched"))
        else:
            met = own.join(below, F.col("id") == F.col("of"), "left")
            leaves = F.when(F.col("inner"), F.coalesce("below_leaves", F.lit(0))).otherwise(1)
            inside = F.coalesce("below_matched", F.lit(0)) - F.when(F.col("listed"), F.coalesce("extra", F.lit(0))).otherwise(0)
            matched = F.when(F.col("dead"), 0).when(F.col("inner"), F.greatest(F.lit(0), inside)).otherwise(F.col("hit"))
            sums = met.select("id", "parent", "side", "dead", leaves.alias("leaves"), matched.alias("matched"))
        mine = F.col("side") == "own"
        below = sums.groupBy(F.col("parent").alias("of")).agg(F.sum(F.when(mine, F.col("leaves"))).alias("below_leaves"), F.sum(F.when(mine, F.col("matched"))).alias("below_matched"), F.sum(F.when(~mine, F.col("leaves"))).alias("extra"))
    scored = materialize(sums.select(F.col("id").alias(f"{stem}_id"), F.col("leaves").cast("long").alias("expected_leaves"), F.col("matched").cast("long").alias("matched_leaves")), "json-scores")
    discard(*levels)
    known = F.try_parse_json(F.col(expected)).isNotNull() & F.try_parse_json(F.col(actual)).isNotNull()
    out = node.join(scored, F.col(stem) == F.col(f"{stem}_id"))
    return out.select(*df.columns, *[F.when(known, F.col(c)).alias(c) for c in ("expected_leaves", "matched_leaves")])
