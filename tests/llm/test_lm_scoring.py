import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import words_of
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestack.llm import lm_scoring as L
from lodestack.llm import ngram_trie as T
from lodestack.llm import queries


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 9000), st.sampled_from([0, 1, 50, 2**40]), st.integers(0, 10**6))
def test_sequences(n, most, seed):
    rng = np.random.default_rng(seed)
    values = np.sort(rng.integers(0, most + 1, n)) + int(rng.integers(0, 1000))
    raw = T.EliasFano.encode(values)
    got, end = T.EliasFano.over(memoryview(b"12345678" + raw), 8)
    assert end == len(raw) + 8 and (got.at(np.arange(n)) == values).all()
    asked = np.concatenate([rng.integers(0, most + 1100, 200), values[: n // 2]])
    place, same = got.successors(asked)
    assert (place == np.searchsorted(values, asked)).all() and (same == np.isin(asked, values)).all()


def test_sequences_are_small():
    values = np.sort(np.random.default_rng(1).integers(0, 2**34, 2**20))
    assert len(T.EliasFano.encode(values)) * 8 < (14 + 2.6) * len(values)  # log2(universe / n) + 2 bits


def test_a_level_finds_its_grams():
    rng = np.random.default_rng(2)
    grams = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 3000, 20000) * 7, rng.integers(0, 500, 20000), strict=True)})
    own = sorted(rng.choice(len(grams), 12000, replace=False).tolist())
    kept = [grams[k] for k in own]
    sizes = Counter(a for a, _ in kept)
    codes = rng.integers(0, 65536, len(kept))
    level = T.Level(memoryview(T.Level.build(np.array(sorted(sizes)), np.array([sizes[a] for a in sorted(sizes)]), np.array([b for _, b in kept]), codes, np.arange(len(kept)))))
    asked = Counter(a for a, _ in grams)
    found, beside, begins = level.find(np.array(sorted(asked)), np.array([asked[a] for a in sorted(asked)]), np.array([b for _, b in grams]))
    place = {g: k for k, g in enumerate(kept)}
    assert found.tolist() == [place.get(g, -1) for g in grams]
    assert all(b == min(k for k, g in enumerate(kept) if g[0] == a) for a, b in list(zip(sorted(asked), begins.tolist(), strict=True))[:300] if a in sizes)
    assert (level.codes == codes).all() and (level.counts == np.arange(len(kept))).all()
    assert all(kept[f - b][0] == kept[f][0] and (f == b or kept[f - b - 1][0] != kept[f][0]) for f, b in zip(found.tolist(), beside.tolist(), strict=True) if f >= 0)


def plain(rows, order, strength):
    """Scores by a model in dictionaries, without codes."""
    texts = [[*words_of(t, lower=True), None] for _, t in rows]
    held = [d is None or zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(tuple(x[i : i + k]) for x, h in zip(texts, held, strict=True) if not h for k in range(1, order + 1) for i in range(len(x) - k + 1))
    n, v = sum(c for g, c in counts.items() if len(g) == 1), sum(len(g) == 1 for g in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 0.1) / (n + 0.1 * (v + 1))
        return (counts[gram] + strength * p(gram[1:])) / (counts[gram[:-1]] + strength)

    out = []
    for (d, _), x, h in zip(rows, texts, held, strict=True):
        base = sum(math.log10(p((w,))) for w in x)
        score = sum(math.log10(p(tuple(x[max(0, i - order + 1) : i + 1]))) for i in range(len(x)))
        out.append((d, h, len(x), sum(counts[(w,)] > 0 for w in x), n, base, score))
    return out


def same(found, wanted, order):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    found, wanted = sorted(map(tuple, found), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    for f, w in zip(found, wanted, strict=True):
        assert f[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert abs(f[6] - w[6]) <= 1e-9 + w[2] * order * 0.5 / T.STEPS * 1.01  # half a step of a code at each order


@pytest.mark.parametrize("order", [2, 3, 4])
def test_odd_rows(edge, edge_rows, order, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 1500)
    monkeypatch.setattr(L, "SLICE", 900)
    monkeypatch.setattr(L, "FREQUENT", 60)
    same(L.score(edge, order=order, strength=2.0).collect(), plain([(r[0], r[1]) for r in edge_rows], order, 2.0), order)


def test_whole_table_and_better_than_single_words(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op11_lm_scoring(spark, data)
    assert ", ".join(f"{n} {t.replace('bigint', 'long')}" for n, t in found.dtypes) == L.SCORES
    got = found.collect()
    same(got, plain([tuple(r) for r in rows], 3, L.STRENGTH), 3)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 9, 40)
    low = rng.dirichlet(np.ones(41))
    assert sum((np.append(counts, 0) + L.STRENGTH * low) / (counts.sum() + L.STRENGTH)) == pytest.approx(1)


def test_long_text_and_no_rows(spark, nothing):
    assert L.score(nothing).collect() == []
    text = " ".join(f"w{k % 977} x{k % 31}" for k in range(250_000))  # above 1 MiB, so hashed in pieces
    rows = [(1, text), (2, text), (3, "w1 x1 w2")]
    same(L.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), plain(rows, 3, L.STRENGTH), 3)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1) | st.integers(0, 50), max_size=300))
def test_sorting_and_distinct_values(values):
    x = np.array(values, np.int64)
    for kind in (np.int64, np.uint64):
        assert (L._sorting(x.astype(kind)) == np.argsort(x, kind="stable")).all()
    found, place = L._distinct(x)
    assert found.tolist() == sorted(set(values)) and (found[place] == x).all()


def shuffled(spark, run):
    """Bytes that the stages of run() have shuffled, with its result."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    stages = lambda: [s.apply(k) for s in (store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None),) for k in range(s.size())]
    before = max([s.stageId() for s in stages()], default=-1)
    result = run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return sum(s.shuffleWriteBytes() for s in stages() if s.stageId() > before), result


def test_what_is_shuffled_does_not_grow_with_occurrences(spark, tmp_path):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 300, 200)) for _ in range(20)]
    sizes = []
    for copies in (10, 150):
        rows = [(k, texts[k % len(texts)]) for k in range(len(texts) * copies)]
        path = str(tmp_path / str(copies))
        spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(path)
        frame = spark.read.parquet(path)  # two blocks have each gram
        size, got = shuffled(spark, lambda frame=frame: L.score(frame).collect())
        same(got, plain(rows, 3, L.STRENGTH), 3)
        sizes.append(size)
    assert sizes[1] < 2 * sizes[0]  # counts have more digits
