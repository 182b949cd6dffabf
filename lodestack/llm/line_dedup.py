"""Line dedup with two Bloom filters.

The key of a line is the line without white space (0x20, 0x09-0x0D) at its ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points that are found in at least ``min_docs`` documents lose
all their lines, except in the document with the largest doc_id among those that hold them.

1. One map makes a table of keys: doc_id and a 128-bit digest for each key of a document.
2. Each task fills two Bloom filters from its part of the table, one of keys seen once, one of keys
   seen again. Filters are merged piece by piece: what is in two once-seen filters, or in either
   twice-seen one, is seen twice.
3. Only keys that the twice-seen filter lets through are shuffled, for an exact count of their
   documents and the choice of the one that keeps them.
4. The documents meet the keys they lose by doc_id, and lose the lines.

Scale: the filters have at least BITS_PER_KEY bits a key and are made and asked in slices of the key
space of 32 MB (``slice_bits``), the only thing that is broadcast and collected, one at a time.
Hot keys are summed before they are shuffled, and joined by a join that splits hot keys.

Defined cases: a null or empty text is one empty line, and stays empty. A line that repeats within
a document counts once for it and is kept or dropped as one. Rows of equal doc_id are one document
for counting. A null doc_id counts as one document below all others. Columns n_lines and n_dropped
of the input are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.llm import worker
from lodestack.llm.twice_seen import SLICE_BITS, suspected
from lodestack.session import discard, materialize, unused

_SPACE = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The digest of each line's key, or None where the key is too short."""
    keys: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip(_SPACE).lower()
        long = len(key) >= 4 * min_chars or (len(key) >= min_chars and len(key.decode()) >= min_chars)
        keys.append(xxhash.xxh3_128_digest(key) if long else None)
    return keys


def _key_table(docs: DataFrame, min_chars: int) -> DataFrame:
    @worker.task("line_dedup")
    def rows(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            ids, digests = [], []
            for k in range(len(texts)):
                own = {x for x in line_keys(texts[k].as_py() or b"", min_chars) if x}
                digests.extend(own)
                ids.extend([k] * len(own))
                if len(ids) > 1 << 18 or k == len(texts) - 1:
                    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["doc_id", "k1", "k2"])
                    ids, digests = [], []

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, k1 long, k2 long")


def lost_keys(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, slice_bits: int = SLICE_BITS) -> DataFrame:
    """For each document that loses lines: doc_id and the digests of the keys it loses, as two arrays."""
    keys = materialize(_key_table(docs, min_chars).sortWithinPartitions("k1"), "line-keys")
    some = suspected(keys, keys.count(), slice_bits, "line-suspects").distinct()
    discard(keys)
    common = some.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs)
    # Written, so that the join has an exchange of its own on each side, which AQE can split at hot keys.
    common = materialize(common, "line-common")
    lost = some.join(common, ["k1", "k2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id").agg(F.collect_list("k1").alias("k1"), F.collect_list("k2").alias("k2"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, slice_bits: int = SLICE_BITS) -> DataFrame:
    """The rows of docs with what is left of their texts, n_lines (before) and n_dropped."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    own = unused(docs, "lost")
    lost = lost_keys(docs, min_chars, min_docs, slice_bits).toDF(f"{own}doc", f"{own}k1", f"{own}k2")
    met = docs.select(*kept).join(lost, docs["doc_id"].cast("long").eqNullSafe(lost[f"{own}doc"]), "left").drop(f"{own}doc")
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    @worker.task("line_dedup")
    def rows(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, k1s, k2s = batch.column(at).cast(pa.large_binary()), batch.column(f"{own}k1"), batch.column(f"{own}k2")
            out, n_lines, n_dropped = [], [], []
            for k in range(len(texts)):
                raw = texts[k].as_py() or b""
                lines = raw.split(b"\n")
                n_lines.append(len(lines))
                if k1s[k].is_valid:
                    both = np.stack([k1s[k].values.to_numpy(), k2s[k].values.to_numpy()], axis=1).astype("<i8")
                    gone = {x.tobytes() for x in both}
                    lines = [x for x, key in zip(lines, line_keys(raw, min_chars), strict=True) if key not in gone]
                    raw = b"\n".join(lines)
                n_dropped.append(n_lines[-1] - len(lines))
                out.append(raw)
            columns = [batch.column(c) if c != "text" else pa.array(out, pa.binary()).cast(batch.schema.field(at).type) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*kept, "n_lines", "n_dropped"])

    return met.mapInArrow(rows, schema)


#: The same rows in DuckDB SQL.
SQL = """
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS row_no, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), numbered AS (
  SELECT doc_id, row_no, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS place FROM lines
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM numbered
), common AS (
  SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 20 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, c.keeper IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM keyed k LEFT JOIN common c USING (line_key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id, row_no
"""
