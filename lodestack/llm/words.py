"""Words and their hashes, for whole Arrow batches at once.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D of the UTF-8 text, which is
``[^\\x20\\x09-\\x0D]+`` of the text. Hashes are 64 bits: a polynomial over random byte values,
mixed with the length. They are the same on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodestack.llm import worker

#: Bytes of text hashed at once; the arrays for a piece take about 60 times as much.
PIECE = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on each other."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_ODD = _U(0x9E3779B97F4A7C15)
_BYTES = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _ODD)
_LOWERED = _BYTES.copy()
_LOWERED[65:91] = _BYTES[97:123]
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95
_powers: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, PIECE + 65536)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its len + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held, at


def word_spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``; a word also ends at each of ``cuts``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_GAP[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hash_piece(data: np.ndarray, cuts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_spans(data, cuts)
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=total[1:])
    raw = (total[ends] - total[starts]) * down[starts]
    return starts, mix(raw ^ ((ends - starts).astype(np.uint64) * _ODD))


def hashed_words(column: pa.Array, lower: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Hashes of the words of whole texts, in chunks of neighbouring rows.

    Yields (first row, row after the last, word hashes, offsets of the rows into them). A chunk has
    about PIECE bytes, or one longer text, which is hashed in pieces cut at white space.
    """
    worker.use("words")
    values = _LOWERED if lower else _BYTES
    data, at = text_buffers(column)
    row, n = 0, len(at) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, side="right")) - 1)
        begin, end = int(at[row]), int(at[stop])
        hashes, starts = [], []
        pos = begin
        while pos < end:
            to = min(end, pos + PIECE)
            while to < end and not _GAP[data[to]]:
                gaps = np.flatnonzero(_GAP[data[to : min(end, to + 4096)]])
                to = to + int(gaps[0]) if len(gaps) else min(end, to + 4096)
            s, h = _hash_piece(data[pos:to], at[row : stop + 1] - pos, values)
            starts.append(s + pos)
            hashes.append(h)
            pos = to
        words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        yield row, stop, words, np.searchsorted(where, at[row : stop + 1])
        row = stop
