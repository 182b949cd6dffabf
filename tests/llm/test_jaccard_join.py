import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from conftest import words_of

from lodestack.llm import blocks, components, jaccard_join as J


def plain(rows, width, percent):
    sets = {}
    for k, r in enumerate(rows):
        w = words_of(r[1], lower=True)
        sets[k] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if None not in (rows[a][0], rows[b][0]) and x and y and 100 * len(x & y) >= percent * len(x | y):
            root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted(((r[0], len(sets[k]), None if r[0] is None else least[find(k)]) for k, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_edges_like_plain(edge, edge_rows, width, percent):
    got = J.near_duplicates(edge, width, percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(edge_rows, width, percent)


def test_chains_of_near_copies(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(4):
        words = [str(rng.randint(0, 10**6)) for _ in range(120)]
        for _ in range(12):
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(120)] = str(rng.randint(0, 10**6))
            rows.append((n, " ".join(words)))
            n += 1
    rng.shuffle(rows)
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, 3, 90)


def test_signatures_and_sketches_miss_no_link():
    rng = np.random.default_rng(3)
    for percent in (80, 90):
        for n in (1, 2, 5, 9, 10, 19, 20, 50, 200, 1500):
            for _ in range(40):
                a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
                drop = rng.random(len(a)) < rng.random() * 0.2
                b = np.unique(np.concatenate([a[~drop], rng.integers(0, 1 << 63, rng.integers(0, 2 + n // 10), dtype=np.uint64)]))
                if len(b) and J.linked(a, b, percent):
                    common = [(np.isin(x, y), np.isin(y, x), p, q) for p, _, x in J.signatures(a, percent) for q, _, y in J.signatures(b, percent) if np.isin(x, y).any()]
                    assert any(x.sum() >= max(p, q) and x[: len(x) - p + 1].any() and y[: len(y) - q + 1].any() for x, y, p, q in common if min(p, q) > 1) or any(min(p, q) == 1 for _, _, p, q in common)
                    assert J.sketches_allow(J.sketch(a, percent), J.sketch(b, percent), len(a) + len(b), percent)


def templated(rng, n, length):
    fixed = [f"w{k}" for k in range(length)]
    return [(k, " ".join([f"a{k}x{rng.randrange(9)}", *fixed[1 : length // 2], f"b{k}", *fixed[length // 2 :]])) for k in range(n)]


def test_templated_documents_like_plain(spark, monkeypatch):
    """Small blocks, so that groups are split, and frequent signatures."""
    monkeypatch.setattr(J, "BLOCK", 4)
    monkeypatch.setattr(J, "LARGE", 6)
    monkeypatch.setattr(J, "FREQUENT", 3)
    rng = random.Random(2)
    rows = templated(rng, 60, 12) + [(100 + k, t) for k, t in templated(rng, 60, 40)]
    rows += [(200 + k, t.replace("w7", f"w{rng.randrange(6, 9)}")) for k, t in rows[::3]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for width, percent in ((3, 90), (3, 70)):
        assert sorted((tuple(r) for r in J.near_duplicates(df, width, percent).collect()), key=repr) == plain(rows, width, percent)


def test_few_pairs_of_templated_documents_are_compared(spark, monkeypatch):
    """20,000 documents of one template that don't link: few pairs are compared."""
    rows = templated(random.Random(3), 20_000, 27)
    compared = []
    plan = J._compared

    def counted(rows, facts, percent, forest):
        held = rows.groupBy("k1").agg(F.count_if("weak" if "weak" in rows.columns else F.lit(True)).alias("w"), F.count(F.lit(1)).alias("n"))
        if forest:
            compared.append(held.agg(F.sum(F.expr("w * (w - 1) / 2 + w * (n - w)"))).first()[0] or 0)
        return plan(rows, facts, percent, forest)

    monkeypatch.setattr(J, "_compared", counted)
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), 3, 90)
    assert got.where("doc_id = component_id").count() == 20_000
    assert sum(compared) < 0.15 * 20_000**2 / 2


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(30)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def test_labels_fill_all_partitions(spark):
    labels = blocks.labels(211)
    held = spark.createDataFrame([(int(x),) for x in labels], "label int").repartition(211, "label").select(F.spark_partition_id().alias("p")).distinct().count()
    assert held == 211


def test_one_of_each_group_stays(edge, edge_rows):
    stay = sorted((r.doc_id for r in J.drop_near_duplicates(edge).collect()), key=repr)
    classes = plain(edge_rows, 5, 80)
    assert stay == sorted((d for d, _, c in classes if d is None or d == c), key=repr)


def test_empty(nothing):
    assert J.near_duplicates(nothing).count() == 0


def test_no_plan_holds_several_comparisons(spark, monkeypatch):
    """Groups are split in rounds; each comparison is written by itself, so plans don't grow with the rounds."""
    monkeypatch.setattr(J, "BLOCK", 4)
    monkeypatch.setattr(J, "LARGE", 6)
    steps = []

    def counted(df, name, write=J.materialize):
        if name in ("compared", "across"):
            steps.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")))
        return write(df, name)

    monkeypatch.setattr(J, "materialize", counted)
    df = spark.createDataFrame(templated(random.Random(2), 60, 12), "doc_id long, text string").repartition(3)
    assert J.near_duplicates(df, 3, 90).count() == 60
    assert ("compared", 1) in steps and ("across", 0) in steps
    assert {n for name, n in steps if name == "across"} == {0} and max(n for _, n in steps) == 1
