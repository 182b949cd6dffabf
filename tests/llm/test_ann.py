import numpy as np
import pytest

from lodestack.llm import ann


def exact(rows, every, n):
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q, x in good.items():
        if q % every == 0:
            out[q] = sorted(((-float((x * y).sum()), i) for i, y in good.items() if i != q))[:n]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 16)) * 2
    near = [(k, (centres[k % 8] + rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(1200)]
    same = rng.standard_normal(16).astype(np.float32).tolist()
    near += [(2000 + k, same) for k in range(60)] + [(20, near[20][1])]
    return near + [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3060, [1.0, None] * 8), (3080, [1.0] * 3), (None, [1.0] * 16)]


def test_recall_and_order(spark, rows):
    got = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact(rows, 20, 20)
    assert set(got) == set(want)
    hits = 0
    vectors = {i: np.array(v, np.float64) for i, v in rows if i in got or (v and None not in v and len(v) == 16)}
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and len({v for _, v, _ in found}) == 20
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        assert all(abs(s - float((vectors[q] * vectors[v]).sum())) < 1e-9 for _, v, s in found)
        hits += len({v for _, v, _ in found} & {i for _, i in want[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_exact_past_the_most_probes(spark, monkeypatch):
    """With norms that differ greatly, few probes don't reach the recall; then all rows are compared."""
    monkeypatch.setattr(ann, "MOST_PROBES", 2)
    rng = np.random.default_rng(3)
    uneven = [(k, (rng.standard_normal(16) * (20 if k % 50 == 7 else 1)).tolist()) for k in range(3000)]
    got = {}
    for r in ann.search(spark.createDataFrame(uneven, "vec_id long, embedding array<double>").repartition(4)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got == {q: {i for _, i in found} for q, found in exact(uneven, 20, 20).items()}


def test_small_tables_return_all(spark):
    rows = [(k, [float(k + 1), float(k % 3), 1.0]) for k in range(6)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=2).collect()
    assert sorted((r.query_id, r.vec_id) for r in got) == [(q, v) for q in (0, 2, 4) for v in range(6) if v != q]


def test_empty(spark):
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_perturbations_in_order_of_score():
    sets = ann.perturbations(5, 60)
    assert not sets[0].any() and len({tuple(sorted(s)) for s in sets.tolist()}) == len(sets)
    for own in sets.tolist():
        used = [min(x, 11 - x) for x in own if x]
        assert len(set(used)) == len(used)


def test_few_clustered_vectors_are_compared(spark):
    """At this recall a query meets less than a quarter of vectors that lie in clusters."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((60, 32)) * 3
    rows = [(k, (centres[rng.integers(60)] + rng.standard_normal(32)).tolist()) for k in range(6000)]
    clean = ann._clean(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), "vec_id", "embedding").cache()
    index = ann.build(clean, "<f8", 32, 20, 20)
    assert index.reached and index.share < 0.25
    vectors = np.array([v for _, v in rows])
    queries = vectors[::20]
    sets = ann.perturbations(index.k, index.probes)
    stored, visits = index.buckets(vectors), index.visited(queries, sets)
    hits, met = 0, 0
    for n, q in enumerate(range(0, 6000, 20)):
        seen = np.any([np.isin(stored[:, t], visits[n, t]) for t in range(index.tables)], axis=0)
        scores = vectors @ queries[n]
        scores[q] = -np.inf
        hits += seen[np.argsort(-scores)[:20]].sum()
        met += seen.mean()
    assert hits >= 0.9 * 20 * 300 and met < 0.25 * 300
