import random

import numpy as np
from conftest import words_of

from lodestack.llm import substring
from lodestack.llm.words import mix


def plain(rows, width=13):
    first = {}
    for r in rows:
        w = words_of(r[1])
        if r[0] is not None:
            for i in range(len(w) - width + 1):
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r in rows:
        w = words_of(r[1])
        gone = set()
        if r[0] is not None:
            for i in range(len(w) - width + 1):
                if first[tuple(w[i : i + width])] < r[0]:
                    gone.update(range(i, i + width))
        out.append((r[0], " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return sorted(out, key=repr)


def result(df, **more):
    return sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in substring.dedup_substrings(df, **more).collect()), key=repr)


def test_edges(edge, edge_rows, nothing):
    assert result(edge) == plain(edge_rows)
    assert result(nothing) == []


def test_repetitive_texts(spark, monkeypatch):
    monkeypatch.setattr(substring, "HELD", 50)
    rng = random.Random(8)
    pieces = [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 25))) for _ in range(8)] + ["a " * 30, "a b " * 12, "c"]
    rows = [(rng.randrange(40), " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 5)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for width in (3, 13):
        assert result(df, width=width) == plain(rows, width)


def test_shared_stretches_have_the_same_symbols_inside():
    rng = np.random.default_rng(4)
    letters = mix(np.arange(1, 5, dtype=np.uint64))
    shared = letters[rng.integers(0, 4, 400)]
    seen = []
    for _ in range(30):
        before = letters[rng.integers(0, 4, rng.integers(0, 300))]
        words = np.concatenate([before, shared, letters[rng.integers(0, 4, rng.integers(0, 300))]])
        starts = substring.symbols(words, np.array([0, len(words)])) - len(before)
        seen.append(starts[(starts >= 100) & (starts < 300)].tolist())
    assert all(x == seen[0] for x in seen) and 3 < len(seen[0]) < 40


def test_symbols_end_with_their_documents():
    word = mix(np.arange(1, 4, dtype=np.uint64))
    words = np.concatenate([np.repeat(word[:1], 50), word, np.repeat(word[2:], 50)])
    at = np.array([0, 50, 50, 53, 103])
    starts = substring.symbols(words, at)
    assert set(at[:-1].tolist()) <= set(starts.tolist()) and len(starts) < 8
    assert substring.symbols(words[:0], np.array([0, 0])).tolist() == []
