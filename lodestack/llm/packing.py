"""Packing by power-of-two decomposition.

Each document's ids (with an end id) are cut into pieces whose lengths are powers of two: as many
of ``max_len`` as fit, then one for each set bit of what is left. Every piece is a sequence of its
own, so no sequence crosses documents and none needs padding; batches are made of equal lengths,
from one bucket. The plan is one map over the documents: nothing is shuffled.

Defined cases: a null or empty text is the end id alone, one piece of length 1. Repeated rows and
equal ids are packed each on its own. An empty table gives no pieces. A null doc_id is kept. Extra
columns are left out whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm import worker
from lodestack.llm.tokens import encoded

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int, sequence_id long, offset long"


def cut(n: int, max_len: int) -> list[int]:
    """Lengths of the pieces of n ids, longest first."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << k for k in range(max_len.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, vocabulary: str, max_len: int = 2048, end_id: int = 1, eager: bool = True) -> DataFrame:
    """Pieces of all documents: their ids (little-endian unsigned 32-bit), place in the document,
    bucket (log2 of the length), sequence and place in the sequence (always 0).

    Workers keep the ids of all words, or if not ``eager`` of those that come again. sequence_id is unique: the number of the partition, then a counter within it.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")

    @worker.task("tokens")
    def pieces(batches):
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids_of = batch.column(0)
            out: list[list] = [[] for _ in range(6)]
            size = 0
            for row, ids in encoded(batch.column(1), vocabulary, end_id, eager=eager):
                n, start, doc = len(ids) // 4, 0, ids_of[row].as_py()
                for length in cut(n, max_len):
                    for column, value in zip(out, (doc, start, length, ids[4 * start : 4 * (start + length)], n, sequence), strict=True):
                        column.append(value)
                    start += length
                    sequence += 1
                size += len(ids)
                if size > 1 << 21:
                    yield _piece_batch(out)
                    out, size = [[] for _ in range(6)], 0
            if out[0]:
                yield _piece_batch(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pieces, SCHEMA)


def _piece_batch(out: list[list]) -> pa.RecordBatch:
    doc, start, length, ids, n, sequence = out
    lengths = np.array(length, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc, pa.int64()),
            pa.array(start, pa.int64()),
            pa.array(lengths),
            pa.array(ids, pa.binary()),
            pa.array(n, pa.int64()),
            pa.array(np.log2(lengths).astype(np.int32)),
            pa.array(sequence, pa.int64()),
            pa.array(np.zeros(len(lengths), np.int64)),
        ],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset"],
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder for each length, so that a batch of training sequences reads one bucket."""
    pieces.write.partitionBy("bucket").parquet(path)
