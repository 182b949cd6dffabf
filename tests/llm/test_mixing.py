import random
from collections import Counter, defaultdict

import pytest
from compare import both
from conftest import words_of
from pyspark.sql import functions as F

from lodestack.llm import mixing


def targets(sizes, weights=(5, 2, 1)):
    """Water filling, round by round."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    out, left, free = {}, 1.5 * sum(sizes.values()), set(sizes)
    while free:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if share * weight[s] > 2 * sizes[s]}
        if not full:
            out |= {s: share * weight[s] for s in free}
            break
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    return out


def check(rows, got):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    expected, taken, longest = targets(sizes), defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.target - expected[r.source]) < 1e-6 * max(1, r.target) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size * sum((x.doc_id, x.size) == (r.doc_id, r.size) for x in got))
    assert all(abs(taken[s] - expected[s]) <= longest[s] / 2 + 1e-6 for s in expected)


def test_edges(edge, edge_rows, nothing):
    check(edge_rows, mixing.mix(edge).collect())
    assert mixing.mix(nothing).count() == 0


def test_many_sources(spark):
    rng = random.Random(2)
    rows = [(k, "w " * rng.randint(0, 30), None, f"s{min(rng.randrange(12), rng.randrange(12))}") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    first = mixing.mix(df).collect()
    check(rows, first)
    assert sorted(first) == sorted(mixing.mix(df.repartition(5)).collect())


def test_preferred_documents_come_first(spark):
    rows = [(k, "w " * (10 + k % 3), "s") for k in range(3000)] + [(9000, "w " * 20000, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    liking = lambda size: F.when(size == 10, 0).when(size == 11, 4).otherwise(1).cast("long")
    got = [r for r in mixing.mix(df, weights=(1, 8), share=0.8, preference=liking).collect() if r.source == "s"]
    extra = defaultdict(int)
    for r in got:
        extra[r.size] += r.copies - min(x.copies for x in got)
    assert extra[10] == 0 and extra[11] > 2 * extra[12] > 0


def test_inclusion_probabilities(spark):
    """Over many seeds, a document's share of draws is near its inclusion probability, unequal within the source."""
    rows = [(k, "w " * (250 if k % 2 else 100), "s") for k in range(40)] + [(100, "w " * 4000, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn, goal = defaultdict(int), None
    for seed in range(16):
        got = [r for r in mixing.mix(df, weights=(1, 3), share=0.9, seed=f"s{seed}").collect() if r.source == "s"]
        least = int(got[0].target // got[0].source_size)
        goal = got[0].target - least * got[0].source_size
        for r in got:
            drawn[r.size] += r.copies - least
    rate = goal / (20 * 250 * 2 + 20 * 100)
    assert abs(drawn[250] / 320 - 2 * rate) < 0.1 and abs(drawn[100] / 320 - rate) < 0.1


def test_rows_are_repeated(edge, edge_rows):
    """Rows with repeated and null ids too, each as often as the mix says."""
    mixed = mixing.mix(edge).collect()
    got = mixing.mix_rows(edge)
    assert got.columns == edge.columns
    due = Counter()
    for r in mixed:
        due[(r.doc_id, r.source, r.size)] += r.copies
    found = Counter((r.doc_id, r.source, len(words_of(r.text))) for r in got.collect())
    assert found == Counter({k: n for k, n in due.items() if n})


def test_clashing_names(spark):
    df = spark.createDataFrame([(k, "w " * k, "s", 1, 2, 3, 4) for k in range(20)], "doc_id long, text string, source string, row int, copies int, size int, u int")
    assert mixing.mix_rows(df).columns == df.columns


@pytest.mark.parametrize("name", ["op2_line_dedup", "op3_jaccard_join", "op7_mixing", "op10_substring_dedup"])
def test_query_equals_sql(spark, data, duck, name):
    from lodestack.llm import queries

    own, theirs = both(queries.QUERIES[name](spark, data), duck, queries.ORACLE_SQL[name])
    assert own == theirs
