"""Token ids in ORC files that are sorted by document id.

Integers are run-length encoded by ORC, every stripe carries row indexes with the least and
greatest document id and a Bloom filter of the ids, and stripes are read in parallel. A lookup by
id prunes files, stripes and row groups by that metadata.

Defined cases: a null or empty text is the end id alone. A null doc_id sorts first. Rows of equal
doc_id are ordered by their text, null first. An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.llm.tokens import encoded

SCHEMA = "doc_id long, part int, part_start long, ids array<int>"
OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "10000",
    "orc.create.index": "true",
}


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, partitions: int | None = None) -> None:
    """Write the ids of all documents: file by file, and within each, by ascending doc_id.

    One shuffle deals the texts by ranges of doc_id. part numbers the ranges in ascending order,
    and part_start counts the ids of the same part before the document.
    """

    def rows(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids = batch.column(0)
            first, taken, starts, size = 0, [], [], 0
            for row, ids in encoded(batch.column(1), vocabulary, end_id):
                taken.append(np.frombuffer(ids, "<u4"))
                starts.append(before)
                before += len(taken[-1])
                size += len(taken[-1])
                if size > 1 << 21:
                    yield _rows(doc_ids.slice(first, len(taken)), part, starts, taken)
                    first, taken, starts, size = row + 1, [], [], 0
            if taken:
                yield _rows(doc_ids.slice(first, len(taken)), part, starts, taken)

    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = plain.repartitionByRange(n, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    writer = placed.mapInArrow(rows, SCHEMA).write
    for key, value in OPTIONS.items():
        writer = writer.option(key, value)
    writer.orc(path)


def _rows(doc_ids: pa.Array, part: int, starts: list[int], taken: list[np.ndarray]) -> pa.RecordBatch:
    at = np.zeros(len(taken) + 1, np.int32)
    np.cumsum([len(x) for x in taken], out=at[1:])
    ids = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(taken).astype(np.int32)))
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(np.full(len(taken), part, np.int32)), pa.array(starts, pa.int64()), ids], names=["doc_id", "part", "part_start", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids and start (ids of all documents before it) from the files.

    The parts' sizes are summed from the files; there is one row for each part, so the table of
    their starts is as small as the list of files.
    """
    files = spark.read.schema(SCHEMA).orc(path)
    totals = files.groupBy("part").agg(F.max(F.col("part_start") + F.size("ids")).alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "ids")


def find_documents(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """The stored ids of the documents from low to high; the filter is pushed to the stripes' metadata."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").between(low, high)).select("doc_id", "ids")


def with_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def sums(batches):
        for batch in batches:
            lists = batch.column(2)
            at = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * int(a) : 4 * int(b)]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")
