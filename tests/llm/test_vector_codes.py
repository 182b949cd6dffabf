import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestack.llm import vector_codes as V

ROWS = "vec_id long, embedding array<float>, label int, code string, error string"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 64), st.integers(1, 5), st.sampled_from([2, 40, V.FARTHEST]), st.integers(0, 10**6))
def test_the_annulus_holds_the_nearest_entry(entries, width, spread, seed):
    rng = np.random.default_rng(seed)
    book = V.Codebook(rng.integers(-spread, spread + 1, (entries, width)))
    parts = np.concatenate([rng.integers(-spread, spread + 1, (50, width)), book.entries[:5]])
    code, far = book.nearest(parts)
    every = ((parts[:, None] - book.entries) ** 2).sum(axis=2)
    assert (far == every.min(axis=1)).all() and (code == every.argmin(axis=1)).all()


def test_entries_outside_the_annulus_are_not_compared():
    rng = np.random.default_rng(5)
    of = lambda n: (rng.normal(0, 1, (n, 4)) * 2 ** rng.uniform(3, 12, (n, 1))).astype(np.int64)
    book = V.Codebook(of(64))
    book.nearest(of(2000))
    assert book.compared < 0.45 * 64 * 2000


def plain(rows, parts=16, entries=64, rounds=2):
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    w = -(-len(rows[0][1]) // parts)
    own = [[int(max(-V.FARTHEST, min(V.FARTHEST, np.floor(256 * np.float64(np.float32(x)))))) for x in r[1]] + [0] * (w * parts - len(r[1])) for r in rows]
    books = [[v[p * w : p * w + w] for v in own[:entries]] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w : p * w + w], c, strict=True)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        fresh = []
        for p in range(parts):
            got = [near(v, p)[1] for v in own]
            mine = [[v[p * w : p * w + w] for v, k in zip(own, got, strict=True) if k == e] for e in range(len(books[p]))]
            fresh.append([[sum(c) // len(m) for c in zip(*m, strict=True)] if m else books[p][e] for e, m in enumerate(mine)])
        books = fresh
    found = [[near(v, p) for p in range(parts)] for v in own]
    return books, [(r[0], bytes(k for _, k in f), sum(d for d, _ in f)) for r, f in zip(rows, found, strict=True)]


@pytest.mark.parametrize("length", [32, 19, 0])
def test_codes_of_odd_rows(spark, length):
    rng = np.random.default_rng(length)
    vectors = [[float(np.float32(x)) for x in rng.normal(0, 0.3, length)] for _ in range(90)]
    rows = [(int(k * 2), v, int(rng.integers(0, 3)), "x", "x") for k, v in enumerate(vectors)]
    rows += [rows[3], (rows[4][0], vectors[9], None, None, None), (None, vectors[2], None, "x", "x"), (501, None, 1, "x", "x"), (502, [1.0] * (length + 1), 1, "x", "x")]
    if length:
        rows += [(1, [None, *vectors[0][1:]], 1, "x", "x"), (3, [float("nan"), *vectors[0][1:]], 1, "x", "x"), (5, [float("-inf"), *vectors[0][1:]], 1, "x", "x"), (503, [3e38, *vectors[0][1:]], 1, "x", "x")]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    size, books = V.fit(df)
    wanted, codes = plain(rows)
    assert size == length and books.tolist() == wanted
    coded = V.encode(df, size, books)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.vec_id, bytes(r.code), r.error) for r in coded.collect()), key=key) == sorted(codes, key=key)
    sums = V.with_label_error(coded).collect()
    assert {r.label: r.label_error for r in sums} == {x: sum(r.error for r in sums if r.label == x) for x in {r.label for r in sums}}
    near = [np.abs(V.decode(c, books)[:length] - np.array(vectors[k // 2])).max(initial=0) for k, c, _ in codes if k is not None and k < 100 and k not in (6, 8)]
    assert not length or max(near) < 2


def test_no_vectors(spark):
    assert V.fit(spark.createDataFrame([(1, None, None, None, None)], ROWS)) is None
