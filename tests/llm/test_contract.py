"""The registered queries themselves: columns, types, and rows against plain Python over the whole test tables."""

import hashlib
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lodestack.llm import queries
from lodestack.llm.tokens import vocabulary

COLUMNS = {
    "op1_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op2_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op3_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op4_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op5_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op7_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_media": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op9_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_types(spark, data, name):
    types = dict(queries.QUERIES[name](spark, data).dtypes)
    wanted = dict(x.split() for x in COLUMNS[name].split(", "))
    assert {k: types.get(k) for k in wanted} == wanted


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").collect()


@pytest.fixture(scope="module")
def ids(docs):
    """The ids of whole texts by the library's whole pipeline, with the end id."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    return {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs}


def crc(own):
    return zlib.crc32(struct.pack(f"<{len(own)}I", *own))


def test_op4_rows(spark, data, ids):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op4_packing(spark, data).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for doc, own in pieces.items():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == len(ids[doc])
    waste = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
        waste += 0 if at & (at - 1) == 0 else 2048 - at
    assert waste == 0


def test_op9_rows(spark, data, ids):
    at = 0
    for r in sorted(queries.op9_token_files(spark, data).collect(), key=lambda r: r.doc_id):
        own = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), crc(own))
        at += len(own)


def test_op8_rows(spark, data, docs):
    by_text = {}
    texts = {r.doc_id: (r.text or "").encode() for r in docs}
    for r in queries.op8_media(spark, data).collect():
        raw = texts[r.doc_id]
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.media_bytes > 0 and len(r.media_sha256) == 64 and r.feature
        assert by_text.setdefault(raw, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)


def test_op5_rows(spark, data, docs):
    got = {r.doc_id: r for r in queries.op5_language_id(spark, data).collect()}
    known = {r.lang for r in docs if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    for r in docs:
        own = got[r.doc_id]
        assert own.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= own.score <= 1
        assert own.lang_pred in known if any(c.isalpha() for c in r.text or "") else own.lang_pred == "und"


def test_op6_rows(spark, data):
    rows = [r for r in spark.read.parquet(f"{data}/embeddings.parquet").collect() if r.embedding is not None]
    ids = np.array([r.vec_id for r in rows])
    matrix = np.array([r.embedding for r in rows], np.float64)
    ok = np.isfinite(matrix).all(axis=1) & matrix.any(axis=1)
    ids, matrix = ids[ok], matrix[ok]
    place = {int(v): k for k, v in enumerate(ids)}
    found, total = 0, 0
    got = defaultdict(list)
    for r in queries.op6_nearest(spark, data).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
        assert abs(r.score - float(matrix[place[r.query_id]] @ matrix[place[r.vec_id]])) < 1e-9
    assert set(got) == {int(v) for v in ids if v % 20 == 0}
    for query, own in got.items():
        scores = matrix @ matrix[place[query]]
        order = [int(v) for v in ids[np.lexsort((ids, -scores))] if v != query][:20]
        assert [n for n, _, _ in sorted(own)] == list(range(1, len(order) + 1))
        found += len(set(order) & {v for _, v, _ in own})
        total += len(order)
    assert found >= 0.9 * total
