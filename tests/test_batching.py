"""Chunks against the loop that makes them one after the other."""

import random

import pytest

from lodestack.operators import batching


def plain(rows, most, budget):
    out, now = {}, {}
    for run, n, tokens, model in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        chunk, held, total, of = now.get(run, (-1, most, 0, None))
        if held >= most or total + (tokens or 0) > budget or model != of:
            chunk, held, total, of = chunk + 1, 0, 0, model
        now[run] = chunk, held + 1, total + (tokens or 0), of
        out[run, n] = chunk
    return out


@pytest.mark.parametrize("most, budget, stretch", [(5, 400, 7), (1, 50, 1), (40, 2000, 64), (25, 10**9, None)])
def test_like_the_loop(spark, most, budget, stretch):
    """One run has nearly all items, so it lies in many stretches."""
    rng = random.Random(most)
    rows, model = [], "a"
    for n in range(900):
        if rng.random() < 0.08:
            model = rng.choice(["a", "b", None])
        rows.append((rng.choice([2, 3, None]) if n % 10 == 0 else 1, n, rng.choice([None, 0, 10, 100, 700]), model))
    got = batching.chunks(spark.createDataFrame(rows, "run long, n long, tokens long, model string").repartition(5), "run", "n", most, budget, stretch).collect()
    assert len(got) == len(rows) and {(r.run, r.n): r.chunk for r in got} == plain(rows, most, budget)


def test_no_items(spark):
    assert batching.chunks(spark.createDataFrame([], "run long, n long, tokens long, model string"), "run", "n", 3, 9).collect() == []
