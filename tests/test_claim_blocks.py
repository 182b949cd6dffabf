"""Contradictions of claims found where their classes meet: sums, pairs and places without pairs as rows of a shuffle."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from test_ranking import CLAIMS, contradicts

from lodestack.operators import claims
from lodestack.operators import records as O
from lodestack.plans import records


def some_claims(seed, n, texts=4):
    rng = random.Random(seed)
    words = ["open", "close", "valve", "never", "pump", "of"]
    rows = []
    for k in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, texts)))
        models = rng.sample(["m1", "m2", "m3"], rng.choice([0, 1, 1, 2, 3]))
        rows.append((rng.choice("xy"), f"c{rng.randint(0, 9)}{k:03d}", rng.choice(["spec_value", "warning"]), "s", "ma", "fa", models, rng.choice([None, "a", "b"]), text, text))
    return rows


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(claims, "BLOCK", 16)
    monkeypatch.setattr(claims, "SLICE_BITS", 4)


def test_pairs_have_places_like_plain(spark, small):
    rows = some_claims(3, 150)
    same = [("x", "c5", "spec_value", "s", "ma", "fa", [], None, str(k % 2), "t") for k in range(4)]  # an id that repeats
    df = spark.createDataFrame(rows + same, CLAIMS).selectExpr("*", "substr(claim_text, 1, 2) AS label")
    label = {r[1]: r[9][:2] for r in rows + same}
    pairs = [(a[0], *sorted((a[1], b[1]))) for a, b in combinations(rows + same, 2) if contradicts(a, b) and a[1] != b[1]]
    for order, key in ((None, lambda p: p), ("label", lambda p: (p[0], label[p[1]], *p[1:]))):
        want = []
        for bucket in "xy":
            want += [(*p, k + 1) for k, p in enumerate(sorted((p for p in pairs if p[0] == bucket), key=key))]
        found = claims.ordered_pairs(claims.class_parts(df, ("bucket",), ("label",) if order else ()), "bucket", order)
        assert sorted((r.bucket, r.head, r.tail, r.place) for r in found.collect()) == sorted(want)


def test_places_go_on_between_rounds(monkeypatch):
    monkeypatch.setattr(claims, "SORTED", 100)
    rng = random.Random(1)
    names = pa.array([f"n{k:02d}" for k in range(40)])
    no, pairs = np.arange(40) + 1000, sorted(rng.sample([(a, b) for a in range(40) for b in range(40) if a != b], 900))
    mark = {p: rng.randint(0, 2) for p in pairs}
    mixed = rng.sample(pairs, len(pairs))
    raws = [claims._piece(no, names, *(np.array(x, np.int64) for x in zip(*some, strict=True)), np.array([mark[p] for p in some], np.uint8)) for some in (mixed[:100], mixed[100:550], mixed[550:])]
    got = [(h, t, int(m), int(p)) for heads, tails, marks, places in claims._in_order(7, raws, 900) for h, t, m, p in zip(heads.to_pylist(), tails.to_pylist(), marks, places, strict=True)]
    assert got == [(f"n{a:02d}", f"n{b:02d}", mark[a, b], 8 + k) for k, (a, b) in enumerate(pairs)]


def test_many_claims_of_two_classes_are_paired_in_steps(monkeypatch):
    monkeypatch.setattr(claims, "_PAIRS", 1000)
    monkeypatch.setattr(claims, "_AT_ONCE", 2)
    sizes = [1, 90, 2, 70, 1, 5]
    ids = [[{"claim_id": f"{k}-{i:03d}"} for i in range(n)] for k, n in enumerate(sizes)]
    t = pa.table({"side": [2] * 6, "class_id": pa.array([bytes([k]) for k in range(6)]), "scope_revision": pa.array([None] * 6, pa.string()), "signature": [b"%d" % (k % 3) for k in range(6)], "folded": [b"x"] * 6, "models": [["m"]] * 6, "tokens": pa.array([None] * 6, pa.list_(pa.int64())), "negates": [False] * 6, "claims": sizes, "members": ids})
    names = [x["claim_id"] for own in ids for x in own]
    batches = list(claims._claim_pairs(t, "m"))
    assert max(len(a) for a, _ in batches) <= 1000
    got = sorted((names[a], names[b]) for x, y in batches for a, b in zip(x, y, strict=True))
    assert got == sorted(p for p in combinations(names, 2) if int(p[0][0]) % 3 != int(p[1][0]) % 3)


def test_order_numbers_claims_not_pairs(spark, data, monkeypatch):
    """contradiction_order: what is sorted are the claims, before their pairs."""
    sorted_ = []
    for module in (claims, O):
        monkeypatch.setattr(module, "placed", lambda df, *a, real=module.placed, **b: (sorted_.append(df.columns), real(df, *a, **b))[1])
    assert records.contradiction_order(spark, data).count() > 0
    assert sorted_ == [["bucket_id", "class_id", "part", "claim_id", "doc_id"]]


def test_notes_number_claims_not_pairs(spark, data, monkeypatch):
    """note_entries: what is sorted are the claims, before their pairs."""
    sorted_ = []
    for module in (claims, O):
        monkeypatch.setattr(module, "placed", lambda df, *a, real=module.placed, **b: (sorted_.append(df.columns), real(df, *a, **b))[1])
    assert records.note_entries(spark, data).count() > 0
    assert sorted_ == [["bucket_id", "class_id", "part", "claim_id", "label"]]


def test_classes_are_counted_without_pairs(spark, data, small, monkeypatch):
    """claim_classes: blocks send sums; pairs of classes are made nowhere."""
    rows = some_claims(5, 150, 2)
    classes, members = claims.claim_classes(spark.createDataFrame(rows, CLAIMS), ("bucket",))
    found = claims.opposed_classes(classes, ("bucket",)).collect()
    of = {r.claim_id: r.class_id for r in members.collect()}
    for r in found:
        own = next(x for x in rows if x[1] == r["head"])
        assert r.opposed == sum(contradicts(own, x) for x in rows)
        assert r["head"] == min(c for c, k in of.items() if k == r.class_id)
    assert sum(r.claims for r in found) == len(rows)

    monkeypatch.setattr(claims, "class_pairs", lambda *a: pytest.fail("pairs of classes are made"))
    assert records.claim_classes(spark, data).count() > 0


def test_pairs_of_claims_are_not_shuffled(spark, data):
    """bucket_contradictions: pairs are made by the last step, and nothing is dealt out after it."""
    plan = records.bucket_contradictions(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" in plan and "Exchange" not in plan[: plan.index("InArrow")] and "Join" not in plan[: plan.index("InArrow")]
