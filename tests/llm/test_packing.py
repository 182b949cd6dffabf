import numpy as np
import pytest
from tokenizers import Tokenizer

from lodestack.llm import packing
from lodestack.llm.tokens import WordEncoder, vocabulary


@pytest.fixture(scope="session")
def library():
    return Tokenizer.from_file(vocabulary())


def test_pieces_rebuild_the_documents(edge, edge_rows, library, tmp_path):
    pieces = packing.pack(edge, vocabulary(), max_len=64)
    rows = pieces.collect()
    built = {}
    for r in sorted(rows, key=lambda r: r.sequence_id):
        assert r.length & (r.length - 1) == 0 and r.length <= 64 and 1 << r.bucket == r.length == len(r.ids) // 4 and r.offset == 0
        built.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc_id, text in {(r[0], r[1]) for r in edge_rows}:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        copies = sum(1 for r in edge_rows if r[:2] == (doc_id, text))
        own = sorted(built[doc_id, len(ids) // 4])
        assert b"".join(raw for _, raw in own[::copies]) == ids and [s for s, _ in own[::copies]] == list(np.cumsum([0, *(len(raw) // 4 for _, raw in own[::copies])])[:-1])
    packing.write_buckets(pieces, str(tmp_path / "p"))
    assert edge.sparkSession.read.parquet(str(tmp_path / "p")).count() == len(rows)


def test_cut():
    assert packing.cut(5000, 2048) == [2048, 2048, 512, 256, 128, 8]
    assert packing.cut(1, 2048) == [1] and packing.cut(2048, 2048) == [2048]


def test_bad_length(edge):
    with pytest.raises(ValueError):
        packing.pack(edge, vocabulary(), max_len=100)


def test_empty(nothing):
    assert packing.pack(nothing, vocabulary()).count() == 0


def test_word_cache_equals_library(library):
    import random

    rng = random.Random(5)
    parts = list("aZé'Éß ǰĴJ̌̇IΣσ.,;!<|>\t\n １²½中文字한글​x*_-9🙂\xa0\x85\x1c") + ["<|endoftext|>", "<|ENDOFTEXT|>", "don't", "I'LL", "ñ.", "end.", "End,"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(2000)]
    got = WordEncoder(vocabulary()).encode([t.encode() for t in texts])
    assert [list(np.frombuffer(x, "<u4")) for x in got] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_words_that_come_once_are_not_kept(library):
    """A worker's memory goes to words that come again, and ids are right whether or not the filter knows them."""
    own = WordEncoder(vocabulary(), eager=False)
    once, again = [f"w{k}x" for k in range(3000)], ["pump", "valve."]
    for k in range(30):
        text = " ".join([*again, *once[100 * k : 100 * k + 100]])
        assert list(np.frombuffer(own.encode([text.encode()])[0], "<u4")) == library.encode(text, add_special_tokens=False).ids
    assert {b"pump", b"valve.", b"valve"} <= set(own.cache) and len(own.cache) < 100


def test_the_pipeline_packs_in_small_batches(spark):
    import corpus_pipeline
    from lodestack import session
    from pyspark.sql import functions as F

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    long = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("text "), 400).alias("text"))
    try:
        corpus_pipeline.pack_documents(spark, long, "")
        got = [r.size for r in long.mapInArrow(sizes, "size long").collect()]
        assert sum(got) > 12_000_000 and max(got) < session.BATCH_BYTES * 1.1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
