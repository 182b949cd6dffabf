from collections import defaultdict

import pytest

from lodestack.llm import line_dedup, twice_seen

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_chars=20, min_docs=3):
    docs = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            docs[line.strip(SPACE).translate(LOWER)].add(r[0])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(SPACE).translate(LOWER)
            keeper = max((d for d in docs[key] if d is not None), default=None)
            if len(key) < min_chars or len(docs[key]) < min_docs or r[0] == keeper:
                kept.append(line)
        out.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_bits", [1 << 12, 1 << 20])
def test_like_plain(edge, edge_rows, slice_bits):
    got = line_dedup.dedup_lines(edge, slice_bits=slice_bits)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr) == plain(edge_rows)
    assert set(edge.columns) <= set(got.columns)


def test_full_filter_changes_nothing(edge, edge_rows, monkeypatch):
    monkeypatch.setattr(twice_seen.Seen, "holds", lambda self, k1, k2=None: k1 == k1)
    got = line_dedup.dedup_lines(edge.select("doc_id", "text"))
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr) == plain(edge_rows)


def test_empty(nothing):
    assert line_dedup.dedup_lines(nothing).count() == 0
