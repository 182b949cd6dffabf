"""Substring dedup by recompression.

A window is ``width`` consecutive words of a document. Every word goes that is covered by a window
whose words also start in a document with a smaller doc_id. Windows are judged on the input.

Recompression names the runs of a sequence of symbols, then the pairs of a left symbol and a right
one (a bit of the symbol's hash with the level says which), and goes on with the names. A name is a
64-bit hash of what it stands for, so all tasks give equal substrings equal names without asking each
other; how a stretch of text is parsed depends on its own words and a few around it only.

1. A round names long stretches. LEVELS levels of recompression part each document into symbols of some
   words. A symbol with the ``width`` - 1 words after it holds the windows that start in the symbol. Such
   stretches are shuffled by an 80-bit name of their words; where a document with a smaller doc_id
   has the same one, all its windows are repeats, told by one row.
2. A round names single windows: of those only that are not told yet, that is of one copy of each long
   repeat, of the edges of shared passages, and of text of its own. They are dealt by their 80-bit names
   in blocks; those that are in a document with a smaller doc_id are repeats.
3. The documents meet their repeated windows by doc_id and lose the words.

In both rounds a task decides what it can from its own documents: of those with the same name only the
smallest asks, the others have their answer. So a passage of very many documents asks once for each task.

Scale: shuffled are the symbols (one in about 16 words), the texts twice, compressed, and about 16 bytes
for each window of the second round. Nothing is broadcast or collected. The tasks' buffers are bounded
by HELD windows; with more, a task answers for as many at a time.

Defined cases: a null or empty text has no words and stays empty. Rows of one doc_id, equal or
not, don't remove each other. A null doc_id takes no part: it keeps all words and removes none. Documents
shorter than a window stay whole. An empty table gives no rows. Columns n_words and n_removed of the
input are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestack.llm import blocks, worker
from lodestack.llm.words import _power_tables, hashed_words, mix, text_buffers, word_spans
from lodestack.session import discard, materialize, unused

#: Levels of recompression of the first round; a level joins about a quarter of the symbols with the one before.
LEVELS = 11
#: Windows or symbols that a task holds before it sends them.
HELD = 1 << 19
#: Windows of a slice of their names, about.
SLICE = 1 << 21
#: Bytes of a short word with the space after it, about; it tells the number of windows.
BYTES_PER_WORD = 6
_U = np.uint64
_RUN, _PAIR, _SIDE, _OTHER = mix(np.arange(41, 45, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


class Spans:
    """Hashes of any stretch of a sequence of words: 64 bits, and 16 others."""

    def __init__(self, words: np.ndarray) -> None:
        up, self.down = _power_tables(len(words) + 1)
        self.sums = []
        for names in (words, mix(words + _OTHER)):
            total = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(names * up[: len(words)], out=total[1:])
            self.sums.append(total)

    def names(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = mix((end - begin).astype(np.uint64))
        first, other = (mix((total[end] - total[begin]) * self.down[begin] ^ size) for total in self.sums)
        return first, other.astype(np.uint16)


def recompressed(names: np.ndarray, starts: np.ndarray, heads: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round, runs and then pairs, of symbols that start at words ``starts``; none crosses into a document's first symbol (heads)."""
    begin = heads.copy()
    begin[:1] = True
    begin[1:] |= names[1:] != names[:-1]
    first = np.flatnonzero(begin)
    length = np.diff(np.append(first, len(names))).astype(np.uint64)
    names, starts, heads = names[first], starts[first], heads[first]
    names = np.where(length > 1, mix(names ^ mix(length + _RUN)), names)
    left = (mix(names ^ (_SIDE + _U(level))) & _U(1)).astype(bool)
    pair = np.zeros(len(names), bool)
    pair[:-1] = left[:-1] & ~left[1:] & ~heads[1:]
    keep = np.ones(len(names), bool)
    keep[1:] = ~pair[:-1]
    names = np.where(pair, mix(mix(names + _PAIR) ^ np.append(names[1:], _U(0))[: len(names)]), names)
    return names[keep], starts[keep], heads[keep]


def symbols(words: np.ndarray, at: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Starts of the symbols of documents whose words lie between the offsets ``at``."""
    starts = np.arange(len(words))
    heads = np.zeros(len(words), bool)
    heads[at[:-1][at[:-1] < at[1:]]] = True
    names = words
    for level in range(levels if len(words) else 0):
        names, starts, heads = recompressed(names, starts, heads, level)
    return starts


def _inflated(column: pa.Array) -> list[bytes]:
    codec = pa.Codec("zstd")
    return [codec.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True) for x in column.to_pylist()]


class _Asked:
    """Names of stretches of windows that a task holds: rows (name, other, doc, own, first, many)."""

    KINDS = (np.uint64, np.uint16, np.int64, np.int32, np.int32, np.int32)

    def __init__(self) -> None:
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def add(self, *columns: np.ndarray) -> None:
        self.rows.append(tuple(c.astype(kind) for c, kind in zip(columns, self.KINDS, strict=True)))
        self.count += len(columns[0])

    def drained(self) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """(rows that ask, by name; stretches that are sure to be repeats: doc, own, first, many). Of equal names the smallest doc asks."""
        columns = [np.concatenate([r[k] for r in self.rows]) for k in range(len(self.KINDS))]
        self.rows, self.count = [], 0
        order = np.lexsort((columns[2], columns[1], columns[0]))
        columns = [c[order] for c in columns]
        heads, ends = blocks.stretches(columns[0], columns[1])
        sure = columns[2] > np.repeat(columns[2][heads], ends - heads)
        return tuple(c[~sure] for c in columns), joined(*(c[sure] for c in columns[2:]))


def joined(doc: np.ndarray, own: np.ndarray, first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of windows of each document, those that touch as one."""
    order = np.lexsort((first, own, doc))
    doc, own, first, many = doc[order], own[order], first[order], many[order]
    change = np.ones(len(doc), bool)
    change[1:] = (doc[1:] != doc[:-1]) | (own[1:] != own[:-1]) | (first[1:] > (first + many)[:-1])
    heads = np.flatnonzero(change)
    last = np.append(heads[1:], len(doc))[: len(heads)] - 1
    return doc[heads], own[heads], first[heads], (first[last] + many[last] - first[heads]).astype(np.int32)


def _long_repeats(docs: DataFrame, width: int) -> DataFrame:
    """doc, own, first, many: stretches of windows that the symbols tell to be repeats."""

    @worker.task("substring")
    def ask(batches):
        asked = _Asked()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, at = text_buffers(batch.column(1))
            sums = np.array([zlib.crc32(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], np.uint32).view(np.int32)
            for first, _, words, ends in hashed_words(batch.column(1), lower=False):
                starts = symbols(words, ends)
                row = np.searchsorted(ends, starts, side="right") - 1
                stop = ends[row + 1]
                following = np.minimum(np.append(starts[1:], len(words))[: len(starts)], stop)
                end = np.minimum(following + width - 1, stop)
                some = end - starts >= width
                starts, row, end = starts[some], row[some], end[some]
                name, other = Spans(words).names(starts, end)
                asked.add(name, other, ids[first + row], sums[first + row], starts - ends[row], end - starts - width + 1)
                if asked.count >= HELD:
                    yield from _answered(asked)
        if asked.count:
            yield from _answered(asked)

    schema = "h long, x int, doc long, own int, first int, many int, sure boolean"
    asked = docs.where(F.col("doc_id").isNotNull()).mapInArrow(ask, schema).repartition("h", "x")
    least = F.min("doc").over(Window.partitionBy("h", "x"))
    return asked.withColumn("least", least).where(F.col("sure") | (F.col("doc") > F.col("least"))).select("doc", "own", "first", "many")


def _answered(asked: _Asked) -> Iterator[pa.RecordBatch]:
    names = ["h", "x", "doc", "own", "first", "many", "sure"]
    rows, (doc, own, first, many) = asked.drained()
    order = np.lexsort((rows[4], rows[3], rows[2]))  # in order of documents, which packs better than that of names
    rows = [r[order] for r in rows]
    yield pa.RecordBatch.from_arrays([pa.array(rows[0].view(np.int64)), pa.array(rows[1].astype(np.int32)), *(pa.array(r) for r in rows[2:]), pa.array(np.zeros(len(order), bool))], names=names)
    spread = mix(doc.view(np.uint64) ^ mix(first.astype(np.uint64))).view(np.int64)  # dealt evenly, with no group to meet
    yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(np.full(len(doc), -1, np.int32)), pa.array(doc), pa.array(own), pa.array(first), pa.array(many), pa.array(np.ones(len(doc), bool))], names=names)


_ENTRY = (np.uint64, np.uint16, np.uint32, np.uint32)
_OWNER = (np.int64, np.int32)
_STRETCH = (np.int64, np.int32, np.int32, np.int32)


def _rest(docs: DataFrame, told: DataFrame, width: int, windows: int) -> DataFrame:
    """doc, own, first, many: repeated windows among those that ``told`` does not tell of, about ``windows`` in all."""
    slices = blocks.slice_count(docs, windows, SLICE)
    labels = blocks.labels(slices).tolist()
    lists = told.groupBy("doc", "own").agg(F.collect_list("first").alias("first"), F.collect_list("many").alias("many"))
    texts = _packed_rows(docs.where(F.col("doc_id").isNotNull()), "text")
    # By a shuffle, here and below, so that no stage has two Python workers a task.
    met = texts.join(lists.hint("merge"), (F.col("doc_id") == F.col("doc")) & (F.col("textsum") == F.col("own")), "left").select("doc_id", "textsum", "text", "first", "many")

    @worker.task("substring")
    def ask(batches):
        asked = _Asked()
        for batch in batches:
            ids, owns = batch.column("doc_id").to_numpy(), batch.column("textsum").to_numpy()
            firsts, manys = batch.column("first"), batch.column("many")
            for begin, _, words, ends in hashed_words(pa.array(_inflated(batch.column("text")), pa.large_binary()), lower=False):
                open_ = np.ones(len(words) + 1, np.int64)
                sizes = np.diff(ends)
                for k in np.flatnonzero(sizes):
                    open_[max(ends[k], ends[k + 1] - width + 1) : ends[k + 1]] = 0
                    if firsts[begin + k].is_valid:
                        edge = np.zeros(sizes[k] + 1, np.int64)
                        first = firsts[begin + k].values.to_numpy()
                        np.add.at(edge, first, 1)
                        np.add.at(edge, first + manys[begin + k].values.to_numpy(), -1)
                        open_[ends[k] : ends[k + 1]][np.cumsum(edge[:-1]) > 0] = 0
                starts = np.flatnonzero(open_[:-1])
                row = np.searchsorted(ends, starts, side="right") - 1
                name, other = Spans(words).names(starts, starts + width)
                asked.add(name, other, ids[begin + row], owns[begin + row], starts - ends[row], np.ones(len(starts)))
                if asked.count >= HELD:
                    yield _dealt(asked, labels)
        if asked.count:
            yield _dealt(asked, labels)

    @worker.task("substring")
    def answer(batches):
        sure, own = [], []
        for batch in batches:
            for told_already, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if told_already:
                    sure.append(blocks.unpacked(raw, _STRETCH)[0])
                else:
                    owners, at = blocks.unpacked(raw, _OWNER)
                    (name, other, who, first), _ = blocks.unpacked(raw, _ENTRY, at)
                    own.append((name, other, owners[0][who], owners[1][who], first))
        if own:
            name, other, doc, text, first = (np.concatenate([x[k] for x in own]) for k in range(5))
            own.clear()
            order = np.lexsort((doc, other, name))
            name, other, doc, text, first = name[order], other[order], doc[order], text[order], first[order].astype(np.int32)
            heads, ends = blocks.stretches(name, other)
            again = doc > np.repeat(doc[heads], ends - heads)
            sure.append((doc[again], text[again], first[again], np.ones(int(again.sum()), np.int32)))
        if sure:
            # By document, and all of its stretches in a row.
            doc, text, first, many = joined(*(np.concatenate([x[k] for x in sure]) for k in range(4)))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(text), pa.array(first), pa.array(many)], names=["doc", "own", "first", "many"])

    dealt = met.mapInArrow(ask, "slice int, sure boolean, raw binary")
    return dealt.repartition(slices, "slice").mapInArrow(answer, "doc long, own int, first int, many int")


def _dealt(asked: _Asked, labels: list[int]) -> pa.RecordBatch:
    """Blocks of windows that ask, for each slice, and of those that are sure to be repeats, for any."""
    (name, other, doc, own, first, _), sure = asked.drained()
    slices, marks, raws = [], [], []
    for k, a, b in blocks.cuts(name, len(labels)):
        order = np.lexsort((own[a:b], doc[a:b]))
        heads, ends = blocks.stretches(doc[a:b][order], own[a:b][order])
        who = np.empty(b - a, np.uint32)
        who[order] = np.repeat(np.arange(len(heads), dtype=np.uint32), ends - heads)
        owners = order[heads] + a
        slices.append(labels[k])
        marks.append(False)
        raws.append(blocks.packed(doc[owners], own[owners]) + blocks.packed(name[a:b], other[a:b], who, first[a:b].view(np.uint32)))
    for a in range(0, len(sure[0]), 1 << 14):
        part = [x[a : a + (1 << 14)] for x in sure]
        slices.append(labels[int(mix(part[0][:1].view(np.uint64) + part[2][:1].astype(np.uint64))[0] % _U(len(labels)))])
        marks.append(True)
        raws.append(blocks.packed(*part))
    return pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(marks, pa.bool_()), pa.array(raws, pa.binary())], names=["slice", "sure", "raw"])


def dedup_substrings(docs: DataFrame, width: int = 13) -> DataFrame:
    """The rows of docs with the words that stay, joined by one space, n_words (before) and n_removed.

    A text that loses nothing is joined by single spaces too.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    told = materialize(_long_repeats(plain, width), "long-repeats")
    rest = materialize(_rest(plain, told, width, size // BYTES_PER_WORD), "short-repeats")
    mine = unused(docs, "lost")
    lists = told.unionByName(rest).groupBy("doc", "own").agg(F.collect_list("first").alias(f"{mine}first"), F.collect_list("many").alias(f"{mine}many"))
    lost = materialize(lists.withColumnsRenamed({"doc": f"{mine}doc", "own": f"{mine}own"}), "substrings")
    discard(told, rest)
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    packed = _packed_rows(docs.select(*kept), mine)
    same = (packed["doc_id"].cast("long") == lost[f"{mine}doc"]) & (packed[f"{mine}sum"] == lost[f"{mine}own"])
    met = packed.join(lost.hint("merge"), same, "left").drop(f"{mine}doc", f"{mine}own", f"{mine}sum")
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    @worker.task("substring")
    def rows(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            firsts, manys = batch.column(f"{mine}first"), batch.column(f"{mine}many")
            out, n_words, n_removed = [], [], []
            for k, raw in enumerate(_inflated(batch.column(at))):
                if firsts[k].is_valid:
                    begin, end = word_spans(np.frombuffer(raw, np.uint8), np.zeros(0, np.int64))
                    edge = np.zeros(len(begin) + 1, np.int64)
                    first = firsts[k].values.to_numpy()
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + manys[k].values.to_numpy() + width - 1, -1)
                    stays = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    out.append(b" ".join([raw[a:b] for a, b in zip(begin[stays].tolist(), end[stays].tolist(), strict=True)]))
                    n_words.append(len(begin))
                    n_removed.append(len(begin) - len(stays))
                else:
                    words = raw.split()
                    out.append(b" ".join(words))
                    n_words.append(len(words))
                    n_removed.append(0)
            columns = [batch.column(c) if c != "text" else pa.array(out, pa.binary()).cast(pa.string()) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=[*kept, "n_words", "n_removed"])

    return met.mapInArrow(rows, schema)


def _packed_rows(docs: DataFrame, mine: str) -> DataFrame:
    """The rows of docs with the text compressed and its CRC-32 in a column of its own."""
    schema = T.StructType([*(f if f.name != "text" else T.StructField("text", T.BinaryType()) for f in docs.schema.fields), T.StructField(f"{mine}sum", T.IntegerType())])

    @worker.task("substring")
    def rows(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            place = batch.schema.get_field_index("text")
            data, at = text_buffers(batch.column(place))
            sums, raw = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                text = data[a:b].tobytes()
                sums.append(zlib.crc32(text))
                raw.append(len(text).to_bytes(8, "little") + codec.compress(text, asbytes=True))
            columns = [batch.column(k) if k != place else pa.array(raw, pa.binary()) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.array(sums, np.uint32).view(np.int32))], names=schema.names)

    return docs.mapInArrow(rows, schema)


#: The same rows in DuckDB SQL.
SQL = """
WITH listed AS (
  SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, row_no, unnest(range(1, greatest(len(words) - 11, 1))) AS place, words FROM listed
), named AS (
  SELECT doc_id, row_no, place, md5(array_to_string(words[place : place + 12], ' ')) AS w FROM windows
), firsts AS (
  SELECT w, min(doc_id) AS least FROM named GROUP BY w HAVING min(doc_id) <> max(doc_id)
), gone AS (
  SELECT DISTINCT row_no, place + unnest(range(0, 13)) AS word FROM named JOIN firsts USING (w) WHERE doc_id > least
), each AS (
  SELECT doc_id, row_no, unnest(words) AS word_text, unnest(range(1, len(words) + 1)) AS word FROM listed
), judged AS (
  SELECT e.*, g.word IS NOT NULL AS is_gone FROM each e LEFT JOIN gone g USING (row_no, word)
), summed AS (
  SELECT row_no, count(*) AS n_words, count(*) FILTER (WHERE is_gone) AS n_removed, string_agg(word_text, ' ' ORDER BY word) FILTER (WHERE NOT is_gone) AS kept FROM judged GROUP BY row_no
)
SELECT l.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM listed l LEFT JOIN summed USING (row_no)
"""
