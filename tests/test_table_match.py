"""Matches by rounds of bids against the greedy loop."""

import random

import pytest

from lodestack.operators import evaluation

TABLES = "fixture long, role string, ordinal long, rows long, columns long, cells array<string>"


def plain(rows):
    out = {}
    for fixture in {r[0] for r in rows}:
        free = sorted(r for r in rows if r[0] == fixture and r[1] == "actual")
        wants = sorted((r for r in rows if r[0] == fixture and r[1] == "expected"), key=lambda r: r[2])
        hits = 0
        for want in wants:
            fit = next((r for r in free if r[3:5] == want[3:5] and set(want[5]) <= set(r[5])), None)
            if fit:
                free.remove(fit)
                hits += 1
        out[fixture] = (len(wants), hits)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_like_the_greedy_loop(spark, seed):
    """One fixture has most tables, many of which are alike."""
    rng = random.Random(seed)
    rows = []
    for k in range(240):
        role = rng.choice(["expected", "actual"])
        cells = rng.sample("abcd", rng.choice([0, 1, 1, 2]) if role == "expected" else rng.choice([1, 2, 3, 4]))
        rows.append((rng.choice([2, 3]) if k % 6 == 0 else 1, role, k, rng.choice([1, 1, 2]), 2, cells))
    rows.append((9, "actual", 500, 1, 1, []))
    got = {r.fixture: (r.expected, r.matched) for r in evaluation.match_tables(spark.createDataFrame(rows, TABLES)).collect()}
    assert got == plain(rows)


def test_an_earlier_table_displaces_a_later_one(spark):
    rows = [(1, "expected", 1, 1, 1, ["a"]), (1, "expected", 2, 1, 1, ["b"]), (1, "expected", 3, 1, 1, ["c"]), (1, "actual", 4, 1, 1, ["a", "b"]), (1, "actual", 5, 1, 1, ["b", "c"])]
    assert evaluation.match_tables(spark.createDataFrame(rows, TABLES)).first()[1:] == (3, 2)


def test_tables_meet_by_the_longest_cell_only(spark, monkeypatch):
    """Forty tables share twenty short cells, each pair a long one: no row is made for what is merely common."""
    made, real = {}, evaluation.materialize

    def counted(df, name):
        out = real(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(evaluation, "materialize", counted)
    common = [f"c{k}" for k in range(20)]
    rows = [(1, role, k, 1, 1, [*common, f"much longer {k // 2}"]) for k in range(80) for role in [("expected", "actual")[k % 2]]]
    rows += [(1, "expected", 90, 1, 1, [None, "much longer 3"]), (1, "actual", 91, 1, 1, [None, "much longer 3"])]  # a null is no cell that a table could have
    assert evaluation.match_tables(spark.createDataFrame(rows, TABLES)).first()[1:] == (41, 40)
    assert made["table-met"] == 43
