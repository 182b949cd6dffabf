"""Plans against plain loops on random input."""

import random

import pytest
from pyspark.sql import functions as F

from lodestack.operators import claims, evaluation, extraction, intake, publishing, structure


def test_pages_filled_like_a_loop(spark):
    rng = random.Random(2)
    rows = [(d, i, rng.choice([None, None, rng.randint(1, 9)]) if d % 4 else None) for d in range(50) for i in range(rng.randint(1, 12))]
    got = {(r.doc_id, r.idx): r.page for r in structure.infer_pages(spark.createDataFrame(rows, "doc_id long, idx long, page long"), F.lit(5)).collect()}
    for d in range(50):
        pages = [p for k, _, p in rows if k == d]
        known = [p for p in pages if p is not None]
        now = known[0] if known else None
        for i, p in enumerate(pages):
            now = p if p is not None else now
            assert got[d, i] == (now if known else min(5, i * 5 // len(pages) + 1))


@pytest.mark.parametrize(
    "title, content, kind, expected",
    [
        ("WARNING", "", "datasheet", "safety"),
        ("Voltage ratings", "", "datasheet", "specifications"),
        ("Notes", "battery", "datasheet", "other"),
        ("Routine", "replace the battery", "datasheet", "maintenance"),
        ("Routine", "", "sop", "sop"),
        ("3 Turn it", "nothing", "datasheet", "workflow"),
        ("Wiring", "", "wiring-diagram", "wiring"),
        ("Wiring", "", "datasheet", "installation"),
        ("Field notice", "", "service-bulletin", "bulletin"),
    ],
)
def test_section_types(spark, title, content, kind, expected):
    df = spark.createDataFrame([(title, content, kind, "authoritative-technical")], "title string, content string, document_type string, document_class string")
    assert structure.classify(df).first().section_type == expected


def test_schedule_waits_for_the_budget(spark):
    df = spark.createDataFrame([(1, 1, 60), (1, 2, 60), (1, 3, 500), (2, 1, 10)], "run long, n long, tokens long")
    got = {(r.run, r.n): r.starts_at for r in extraction.schedule(df, "run", "n", requests=10, budget=100).collect()}
    assert got == {(1, 1): 0.0, (1, 2): 60.0, (1, 3): None, (2, 1): 0.0}


def test_schedules_like_a_loop(spark):
    """Second by second: an item starts as soon as what was sent in the last 60 seconds leaves room, in order."""
    rng = random.Random(9)
    rows = [(run, n, rng.randint(1, 120)) for run in range(4) for n in range(25)]
    got = {(r.run, r.n): r.starts_at for r in extraction.schedule(spark.createDataFrame(rows, "run long, n long, tokens long"), "run", "n", requests=3, budget=100).collect()}
    for run in range(4):
        now, sent = 0, []
        for _, n, tokens in (r for r in rows if r[0] == run):
            if tokens > 100:
                assert got[run, n] is None
                continue
            while True:
                live = [k for t, k in sent if now - t < 60]
                if len(live) < 3 and sum(live) + tokens <= 100:
                    break
                now += 1
            sent.append((now, tokens))
            assert got[run, n] == now


def test_eval_parser_like_a_loop(spark, data):
    """The registered query against plain loops over the whole table."""
    from lodestack.plans import evaluation as plans
    from lodestack.plans import registry

    fixtures = {}
    for r in plans._eval_tables(spark, data).collect():
        fixtures.setdefault(r.fixture, []).append(r)
    want = {}
    for fixture, rows in fixtures.items():
        rows.sort(key=lambda r: r.ordinal)
        free, hits = [r for r in rows if r.role == "actual"], 0
        for e in (r for r in rows if r.role == "expected"):
            fit = next((a for a in free if (a.rows, a.columns) == (e.rows, e.columns) and set(e.cells) <= set(a.cells)), None)
            if fit:
                free.remove(fit)
                hits += 1
        want[fixture] = (sum(r.role == "expected" for r in rows), hits)
    got = {r.fixture: (r.expected, r.matched) for r in registry.queries()["eval_parser"](spark, data).collect()}
    assert got == want and sum(h for _, h in want.values()) > 0


def test_eval_fields_like_a_loop(spark, data):
    import json

    from lodestack.plans import registry

    events = {r.event_id: r.props for r in spark.read.parquet(f"{data}/events.parquet").collect()}
    got = registry.queries()["eval_fields"](spark, data).collect()
    assert len(got) == len(events)
    for r in got:
        own = json.loads(events[r.event_id])
        other = {"k": 0} if r.event_id % 3 == 0 else own
        assert (r.expected_leaves, r.matched_leaves) == (len(own), sum(other.get(k) == v for k, v in own.items()))


def test_extract_offline_like_a_loop(spark, data):
    import re

    from lodestack.plans import extraction as plans
    from lodestack.plans import registry

    contents = {r.item_id: r.content for r in plans._items(spark, data).select("item_id", "content").collect()}
    got = registry.queries()["extract_offline"](spark, data).collect()
    assert {r.item_id for r in got} == set(contents)
    for r in got:
        own = contents[r.item_id]
        assert (r.severe, r.words) == (re.search(r"(?i)\b(danger|warning|caution)\b", own) is not None, len(own.split()))


def test_failed_requests_win(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "custom_id string")
    got = extraction.settle(ids, spark.createDataFrame([("a",), ("b",)], "custom_id string"), spark.createDataFrame([("b", "timeout")], "custom_id string, error_type string"))
    assert {r.custom_id: r.outcome for r in got.collect()} == {"a": "succeeded", "b": "failed", "c": "missing"}


def test_changed_items_start_again(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")], "item_id string, fp string")
    before = spark.createDataFrame([("a", "1", "succeeded"), ("b", "0", "succeeded"), ("c", "1", "failed")], "item_id string, fp string, status string")
    status = lambda retry: {r.item_id: r.status for r in extraction.reconcile(now, before, retry).collect()}
    assert status(False) == {"a": "succeeded", "b": "pending", "c": "failed", "d": "pending"}
    assert status(True)["c"] == "pending"


def test_text_contradictions(spark):
    pairs = [("Open the valve", "Never open the valve", True), ("Open the valve slowly", "Open the valve fast", True), ("Clean the filter", "Torque all bolts", False), ("", "x", True), ("", "", False)]
    df = spark.createDataFrame(pairs, "a string, b string, expected boolean").withColumn("got", claims.text_contradicts(F.col("a"), F.col("b")))
    assert all(r.got == r.expected for r in df.collect())


def test_empty_buckets_fall_back(spark):
    df = spark.createDataFrame([(1, None, "F", None, "", "c", None, " ", None)], "doc_id long, manufacturer string, family string, models array<string>, document_type string, document_class string, curated string, revision string, publication_date date")
    got = {r.dimension: r.value for r in intake.buckets(df).collect()}
    assert got["manufacturer"] == "unknown-manufacturer" and got["model_applicability"] == "unknown-model" and got["publication_date"] == "undated" and "curated_bucket" not in got


def test_table_matches_are_one_to_one(spark):
    rows = [(1, "expected", 0, 2, 2, ["a"]), (1, "expected", 1, 2, 2, ["a"]), (1, "actual", 0, 2, 2, ["a", "b"]), (1, "actual", 1, 3, 2, ["a"])]
    df = spark.createDataFrame(rows, "fixture long, role string, ordinal long, rows long, columns long, cells array<string>")
    assert tuple(evaluation.match_tables(df).first()) == (1, 2, 1)


def test_pages_without_a_place_are_not_staged(spark):
    df = spark.createDataFrame([("topic", "specifications", "a"), ("overview", None, "b"), ("topic", "other", "c"), ("source", None, "d")], "kind string, topic string, slug string")
    assert sorted(r.path for r in publishing.stage(df).collect()) == ["publish/controller/a.md", "publish/source-index/d.md"]


def test_leaves_that_agree():
    want = {"a": 1, "b": [1, {"c": 2}], "d": {"e": None}}
    assert evaluation.leaves(want) == 4 and evaluation.agreeing_leaves(want, want) == 4
    assert evaluation.agreeing_leaves(want, {"a": 1, "b": [1, {"c": 2}, 5, 6], "d": 3}) == 1
    assert evaluation.agreeing_leaves([1], [1, 2, 3]) == 0 and evaluation.agreeing_leaves({}, []) == 0


def test_optional_properties_become_nullable():
    own = {"type": "object", "required": ["a"], "properties": {"a": {"type": "string"}, "b": {"type": "integer"}, "c": {"anyOf": [{"type": "string"}]}, "d": {"type": ["string", "null"]}}}
    got = extraction.nullable_schema(own)
    assert got["required"] == ["a", "b", "c", "d"] and got["properties"]["a"] == {"type": "string"} and got["properties"]["b"]["type"] == ["integer", "null"]
    assert got["properties"]["c"]["anyOf"][-1] == {"type": "null"} and got["properties"]["d"] == own["properties"]["d"] and own["required"] == ["a"]


def test_merged_reviews_do_not_join_all_pairs(spark):
    """Pairs meet once; what was saved of them stands beside them."""
    import contextlib
    import io

    from lodestack.plans import claims

    kinds = "subject string, a_claim_id string, b_claim_id string, a_level int, b_level int, confidence string, a_edition struct<n: long>, b_edition struct<n: long>"
    rows = [("1", "a", "b", 1, 2, "high", (2,), (2,)), ("1", "a", "c", 1, 1, "high", (0,), (0,)), ("1", "b", "c", 1, 2, "low", None, (3,)), ("1", "b", "d", 1, 2, "high", (0,), (1,))]
    merged = claims._merged_reviews(spark.createDataFrame(rows, kinds))
    assert sorted(map(tuple, merged.collect())) == [("a||b", False, "accepted"), ("a||c", True, "rejected"), ("b||c", True, "unreviewed"), ("b||d", False, "unreviewed")]
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        merged.explain()
    assert "Join" not in plan.getvalue()


def test_rolling_budget_like_a_loop_without_sliding_frames(spark):
    """A frame that slides is added up anew for each row; running sums aren't."""
    rng = random.Random(8)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice([0, 9, 10, 11, 19, 20, rng.randint(-30, 60)]), rng.choice([None, None, 5, 7])) for k in range(150)]
    log = spark.createDataFrame([*rows, (999, "a", None, 3)], "n long, model string, s long, t long").withColumn("ts", F.timestamp_seconds("s"))
    out = extraction.rolling_budget(log, "model", "ts", "t", 10)
    got = {r.n: (r.requests, r.tokens) for r in out.collect()}
    want = {}
    for n, model, s, _ in rows:
        own = [t for _, m, x, t in rows if m == model and s - 10 < x <= s]
        known = [t for t in own if t is not None]
        want[n] = len(own), sum(known) if known else None
    assert got == want
    frames = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("specifiedwindowframe(")[1:]]
    assert frames and all("unboundedpreceding" in x.split(")")[0] for x in frames)
