"""Scores of results against expected ones."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.operators import json_tree
from lodestack.operators.ranking import placed
from lodestack.session import discard, materialize


def confidence_distribution(df: DataFrame, key: str, score: str) -> DataFrame:
    """Least, greatest and mean score, and how many are low (< 0.5), medium and high (>= 0.8)."""
    s = F.col(score)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(s).alias("least"),
        F.max(s).alias("greatest"),
        F.round(F.avg(s), 3).alias("mean"),
        F.count(F.when(s < 0.5, 1)).alias("low"),
        F.count(F.when((s >= 0.5) & (s < 0.8), 1)).alias("medium"),
        F.count(F.when(s >= 0.8, 1)).alias("high"),
    )


def f1(hits: Column, expected: Column, actual: Column) -> Column:
    """F1 in percent; both empty is 100."""
    return F.when((expected == 0) & (actual == 0), 100.0).when(hits == 0, 0.0).otherwise(200.0 * hits / (expected + actual))


def count_accuracy(expected: Column, actual: Column) -> Column:
    return F.when(expected == 0, F.when(actual == 0, 100.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - F.abs(expected - actual) / F.greatest(expected, F.lit(1))) * 100)


def zip_sorted(expected: DataFrame, actual: DataFrame, key: str, order: str) -> DataFrame:
    """The n-th expected value of a key beside the n-th actual one, null where there are fewer."""
    number = lambda df, name: placed(df.select(key, order), [key], [order]).select(key, "place", F.col(order).alias(name))
    return number(expected, "expected").join(number(actual, "actual"), [key, "place"], "left")


def table_fits(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """kind, turn, fits: the actual tables that a kind of expected ones would take, numbered in order.

    expected: kind, fixture, rows, columns, cells (what is needed), one row for each kind; cells are distinct on both sides. An actual table that fits has
    the longest of these cells too, so it is found by that one, through a list of the tables by cell; whether it has the
    others is asked of those found. The list has only cells whose 16-bit code is that of a cell asked for in their place.
    """
    place = ["fixture", "rows", "columns"]
    code = lambda c: F.xxhash64(c).bitwiseAND(0xFFFF).cast("int")
    longest = F.array_max(F.transform("cells", lambda c: F.struct(F.length(c).alias("n"), c.alias("cell"))))["cell"]
    asked = expected.where(F.size("cells") > 0).select("kind", *place, F.size("cells").alias("n"), longest.alias("cell"))
    codes = asked.groupBy(*place).agg(F.collect_set(code("cell")).alias("codes"))
    some = actual.join(codes, place).withColumn("codes", F.array_intersect(F.transform("cells", code), "codes")).where(F.size("codes") > 0)
    listed = some.select(*place, F.col("ordinal").alias("fits"), F.explode(F.filter("cells", lambda c: F.array_contains("codes", code(c)))).alias("cell"))
    met = materialize(asked.join(listed, [*place, "cell"]).select("kind", "n", "fixture", "fits"), "table-met")
    tables = actual.select("fixture", F.col("ordinal").alias("fits"), F.col("cells").alias("had"))
    whole = ~F.exists("cells", F.isnull) & (F.size(F.array_except("cells", "had")) == 0)
    rest = met.where("n > 1").join(tables, ["fixture", "fits"]).join(expected.select("kind", "cells"), "kind").where(whole)
    anything = expected.where(F.size("cells") == 0).join(actual.select(*place, F.col("ordinal").alias("fits")), place).select("kind", "fits")
    found = met.where("n = 1").select("kind", "fits").unionByName(rest.select("kind", "fits")).unionByName(anything)
    return placed(materialize(found, "table-found"), ["kind"], ["fits"], "turn")


def match_tables(df: DataFrame) -> DataFrame:
    """Greedy one-to-one matches per fixture: each expected table takes the first unused actual one of its size that has its cells.

    df: fixture, role (expected or actual), ordinal (unique for a role of a fixture), rows, columns, cells. The greedy
    choice is the one match in which nobody could take an earlier table from a later expected one, and rounds of bids
    lead to it as well: everyone bids for the first table that has not turned it down; the earliest bidder holds it, until an
    earlier one comes. Expected tables of one size and need have the same list, so the n-th of them begins at its n-th table.
    """
    own = F.array_distinct("cells")
    cells = F.when(F.col("role") == "expected", F.sort_array(own)).otherwise(own)
    df = materialize(df.select("fixture", "role", "ordinal", "rows", "columns", cells.alias("cells")), "tables")
    expected = df.where("role = 'expected'")
    digest = F.unhex(F.sha2(F.to_json(F.struct("fixture", "rows", "columns", "cells")), 256))
    kinds = materialize(expected.select("fixture", "rows", "columns", "cells", "ordinal", digest.alias("kind")), "table-kinds")
    fits = table_fits(kinds.select("kind", "fixture", "rows", "columns", "cells").dropDuplicates(["kind"]), df.where("role = 'actual'"))
    fits = materialize(fits, "table-fits")
    bids = placed(kinds.select("fixture", "kind", "ordinal"), ["kind"], ["ordinal"], "turn")
    discard(kinds)
    now = None
    while True:
        met = bids.join(fits, ["kind", "turn"], "left")
        holders = met.where("fits IS NOT NULL").groupBy("fixture", "fits").agg(F.min("ordinal").alias("holder"))
        before, now = now, materialize(met.join(holders, ["fixture", "fits"], "left").withColumn("lost", F.col("fits").isNotNull() & (F.col("holder") < F.col("ordinal"))), "table-bids")
        if before is not None:
            discard(before)
        if not now.where("lost").limit(1).collect():
            break
        bids = now.select("fixture", "kind", "ordinal", (F.col("turn") + F.col("lost").cast("long")).alias("turn"))
    matched = now.groupBy("fixture").agg(F.count("fits").alias("matched"), F.count(F.lit(1)).alias("expected"))
    fixtures = df.select("fixture").distinct()
    return fixtures.join(matched, "fixture", "left").select("fixture", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("matched", F.lit(0)).alias("matched"))


def leaves(value: object) -> int:
    """Values in a nested value that aren't containers."""
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else None
    return 1 if inner is None else sum(map(leaves, inner))


def agreeing_leaves(expected: object, actual: object) -> int:
    """Leaves of expected that actual has in the same place. Surplus items of a list count against the list, down to 0."""
    match expected, actual:
        case dict(), dict():
            return sum(agreeing_leaves(expected[k], actual.get(k)) for k in expected)
        case list(), list():
            pairs = zip(expected, actual, strict=False)
            return max(0, sum(agreeing_leaves(a, b) for a, b in pairs) - leaves(actual[len(expected) :]))
        case (dict(), _) | (list(), _):
            return 0
    return int(expected == actual)


def json_agreement(df: DataFrame, expected: str, actual: str) -> DataFrame:
    """df with the leaves of the expected JSON and how many of them the actual JSON has, by levels of VARIANTs."""
    return json_tree.agreement(df, expected, actual)


def structure_fidelity(expected_count: Column, actual_count: Column, expected_types: Column, actual_types: Column) -> Column:
    """0.4 times the score of the number of sections (25 off for each that is missing or too many), 0.6 times the share of expected types."""
    off = F.greatest(F.lit(0.0), 100.0 - F.abs(actual_count - expected_count) * 25.0)
    count = F.when(expected_count == 0, F.when(actual_count == 0, 100.0).otherwise(0.0)).otherwise(off)
    want = F.array_distinct(expected_types)
    kinds = F.when(F.size(want) == 0, 100.0).otherwise(F.round(F.size(F.array_intersect(want, actual_types)) / F.greatest(F.size(want), F.lit(1)) * 100, 2))
    return F.round(count * 0.4 + kinds * 0.6, 2)


def snippets_found(snippets: Column, content: Column) -> Column:
    """The share of snippets that the content has, in percent; white space runs count as one space."""
    from lodestack.functions import strings as S

    whole = S.collapse(content)
    found = F.size(F.filter(snippets, lambda x: F.contains(whole, S.collapse(x))))
    return F.when(F.size(snippets) == 0, 100.0).otherwise(F.round(found / F.greatest(F.size(snippets), F.lit(1)) * 100, 2))


def macro_means(scores: DataFrame, by: str, score: str) -> DataFrame:
    """The mean over fixtures of each one's score, whatever their sizes."""
    return scores.groupBy(by).agg(F.round(F.avg(score), 2).alias("mean"), F.count(F.lit(1)).alias("fixtures"))


def extraction_overall(counts: Column, fields: Column, provenance: Column, schema: Column) -> Column:
    """The mean of four scores, to two decimals; no field scores count as 100."""
    return F.round((counts + F.coalesce(fields, F.lit(100.0)) + provenance + schema) / 4, 2)


def field_accuracy(expected: DataFrame, actual: DataFrame, skipped: tuple[str, ...]) -> DataFrame:
    """fixture, record_type, total, matched and score: leaves of expected records that the actual ones have.

    Records (fixture, record_type, payload as JSON) are zipped in the order of their JSON without the skipped keys
    and with white space collapsed: by places, so that a fixture with very many records is in no one task.
    """
    plain = F.pandas_udf(lambda payloads: payloads.map(lambda x: plain_json(x, skipped)), "string")
    key = ["fixture", "record_type"]
    side = lambda df, name: placed(df.select(*key, plain("payload").alias(name)), key, [name])
    pairs = side(expected, "wanted").join(side(actual, "found"), [*key, "place"], "full")
    scored = json_tree.agreement(pairs.where("wanted IS NOT NULL").withColumn("had", F.coalesce("found", F.lit("null"))), "wanted", "had")
    sums = scored.groupBy(*key).agg(F.sum("expected_leaves").alias("total"), F.sum(F.when(F.col("found").isNotNull(), F.col("matched_leaves")).otherwise(0)).alias("matched"))
    groups = expected.select(*key).unionByName(actual.select(*key)).distinct()
    total, matched = F.coalesce("total", F.lit(0)), F.coalesce("matched", F.lit(0))
    score = F.when(F.col("total").isNull(), 0.0).when(total == 0, 100.0).otherwise(F.round(matched / F.greatest(total, F.lit(1)) * 100, 2))
    return groups.join(sums, key, "left").select(*key, total.alias("total"), matched.alias("matched"), score.alias("score"))


def plain_json(payload: str | None, skipped: tuple[str, ...]) -> str | None:
    """JSON in one form: keys in order and without the skipped ones, white space in texts as single spaces; null where it is none."""

    def plain(value: object) -> object:
        if isinstance(value, dict):
            return {k: plain(value[k]) for k in sorted(value) if k not in skipped}
        if isinstance(value, list):
            return [plain(x) for x in value]
        return " ".join(value.split()) if isinstance(value, str) else value

    try:
        return json.dumps(plain(json.loads(payload)), sort_keys=True)
    except (TypeError, ValueError):
        return None
