"""Two Bloom filters of a table of keys: of those seen once or more, and twice or more.

A key is a 64-bit hash in column k1, or a 128-bit one in k1 and k2. Each task fills both filters from
its rows; filters are merged piece by piece (a key that is in two tasks' once-seen filters is in the
merged twice-seen one). Keys that occur once mostly fail the twice-seen filter; no key that repeats does.

The filters have at least BITS_PER_KEY bits a key, however many there are. They are made in slices of the
key space (by a key's high bits) of at most SLICE_BITS (32 MB) each, one after the other: a slice is filled,
broadcast, asked and dropped before the next, so neither the driver nor a task ever holds more than one.
On a cluster with more memory a larger ``slice_bits`` means fewer rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm import worker
from lodestack.llm.words import mix
from lodestack.session import materialize

BITS_PER_KEY = 8
PROBES = 4
#: Bits of a slice of the filters.
SLICE_BITS = 1 << 28
#: Bits of a piece of a filter.
PIECE = 1 << 19
_ONCE = pa.schema([("piece", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
_MERGED = pa.schema([("piece", pa.int32()), ("bits", pa.binary())])


class Shape:
    """Slices of the filters for about n keys, and the bits of one."""

    def __init__(self, n: int, slice_bits: int = SLICE_BITS) -> None:
        bits = max(1 << 16, 1 << (BITS_PER_KEY * max(1, n) - 1).bit_length())
        self.bits = min(bits, slice_bits)
        self.slices = bits // self.bits

    def ranges(self) -> Iterator[tuple[int, int]]:
        """The least and the greatest k1 of each slice, as signed numbers."""
        step = (1 << 64) // self.slices
        for k in range(self.slices):
            yield -(1 << 63) + k * step, -(1 << 63) + (k + 1) * step - 1

    def places(self, k1: np.ndarray, k2: np.ndarray | None = None) -> np.ndarray:
        """The positions of each key in its slice, one row for each probe."""
        k1 = k1.view(np.uint64)
        step = (mix(k1) if k2 is None else k2.view(np.uint64)) | np.uint64(1)
        return np.stack([(k1 + np.uint64(i) * step) & np.uint64(self.bits - 1) for i in range(PROBES)]).astype(np.int64)


class Seen:
    """A slice of a filter, packed."""

    def __init__(self, shape: Shape, packed: np.ndarray) -> None:
        self.shape, self.packed = shape, packed

    def holds(self, k1: np.ndarray, k2: np.ndarray | None = None) -> np.ndarray:
        """False only for keys that are not in it."""
        where = self.shape.places(k1, k2)
        return ((self.packed[where >> 3] & _bit(where)) != 0).all(axis=0)


def _encoded(packed: np.ndarray) -> bytes:
    """A packed piece as gaps between its positions, a byte each and 255 more for each byte 255, or as it is if that's shorter."""
    if int(np.bitwise_count(packed).sum()) < len(packed):
        gaps = np.diff(np.flatnonzero(np.unpackbits(packed)), prepend=0)
        ends = np.cumsum(gaps // 255 + 1)
        if len(ends) and ends[-1] < len(packed):
            out = np.full(ends[-1], 255, np.uint8)
            out[ends - 1] = gaps % 255
            return b"g" + out.tobytes()
        if not len(ends):
            return b"g"
    return b"b" + packed.tobytes()


def _decoded(raw: bytes, size: int) -> np.ndarray:
    if raw[:1] == b"b":
        return np.frombuffer(raw, np.uint8, offset=1)
    steps = np.frombuffer(raw, np.uint8, offset=1)
    bits = np.zeros(size, bool)
    bits[np.cumsum(steps, dtype=np.int64)[steps != 255]] = True
    return np.packbits(bits)


def _bit(where: np.ndarray) -> np.ndarray:
    return np.uint8(128) >> (where & 7).astype(np.uint8)


class _Pair:
    """Packed bits of keys seen once or more, and of keys seen twice or more."""

    def __init__(self, size: int) -> None:
        self.once, self.twice = np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8)

    def merge(self, once: np.ndarray, twice: np.ndarray) -> None:
        self.twice |= twice | (self.once & once)
        self.once |= once

    def add(self, where: np.ndarray, k1: np.ndarray) -> None:
        again = ((self.once[where >> 3] & _bit(where)) != 0).all(axis=0)  # all their bits are set already
        _, first, counts = np.unique(k1, return_index=True, return_counts=True)
        again[first[counts > 1]] = True  # and those that repeat in these rows
        some = where[:, again].ravel()
        np.bitwise_or.at(self.twice, some >> 3, _bit(some))
        where = where.ravel()
        np.bitwise_or.at(self.once, where >> 3, _bit(where))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray | None]:
    return batch.column("k1").to_numpy(), batch.column("k2").to_numpy() if "k2" in batch.schema.names else None


def _table_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    return map(_columns, batches)


def seen(rows: DataFrame, shape: Shape, twice: bool = True, keys_of: Callable = _table_keys) -> Seen:
    """The filter of the keys that ``keys_of`` yields from batches of rows as (k1, k2 or None): of those seen twice, or of all.

    They are the keys of one slice.
    """
    bits, piece = shape.bits, min(PIECE, shape.bits)

    def fill(batches):
        own = None
        for k1, k2 in keys_of(batches):
            own = own or _Pair(bits)
            for at in range(0, len(k1), 1 << 18):
                part = k1[at : at + (1 << 18)]
                own.add(shape.places(part, None if k2 is None else k2[at : at + (1 << 18)]), part)
        for at in range(0, bits // 8 if own else 0, piece // 8):
            once = own.once[at : at + piece // 8]
            if once.any():
                yield pa.RecordBatch.from_pydict({"piece": [at * 8 // piece], "once": [_encoded(once)], "twice": [_encoded(own.twice[at : at + piece // 8])]}, schema=_ONCE)

    def merge(batches):
        worker.use("twice_seen")
        held: dict[int, _Pair] = {}
        for batch in batches:
            for k, first, again in zip(*(batch.column(i) for i in range(3)), strict=True):
                held.setdefault(k.as_py(), _Pair(piece)).merge(_decoded(first.as_py(), piece), _decoded(again.as_py(), piece))
        for k, pair in held.items():
            yield pa.RecordBatch.from_pydict({"piece": [k], "bits": [(pair.twice if twice else pair.once).tobytes()]}, schema=_MERGED)

    filled = rows.mapInArrow(fill, "piece int, once binary, twice binary")
    packed = np.zeros(bits // 8, np.uint8)
    for row in filled.repartition("piece").mapInArrow(merge, "piece int, bits binary").collect():  # a slice, bits / 8 bytes in all
        packed[row["piece"] * piece // 8 : (row["piece"] + 1) * piece // 8] = np.frombuffer(row["bits"], np.uint8)
    return Seen(shape, packed)


def suspected(keys: DataFrame, n: int, slice_bits: int = SLICE_BITS, name: str = "suspects") -> DataFrame:
    """The rows of a table of about n keys that the twice-seen filter lets through, written slice by slice.

    ``keys`` should be a written table whose files are in order of k1, so that each round reads its slice alone.
    """
    own = [c for c in ("k1", "k2") if c in keys.columns]
    shape, paths = Shape(n, slice_bits), []
    for low, high in shape.ranges():
        part = keys.where(F.col("k1").between(low, high)) if shape.slices > 1 else keys
        held = keys.sparkSession.sparkContext.broadcast(seen(part.select(*own), shape))

        def rows(batches, held=held):
            for batch in batches:
                yield batch.filter(pa.array(held.value.holds(*_columns(batch))))

        paths.append(materialize(part.mapInArrow(rows, keys.schema), name).scratch_path)
        held.destroy()
    return keys.sparkSession.read.schema(keys.schema).parquet(*paths)


def member_filter(ids: DataFrame, n: int, max_bits: int = SLICE_BITS) -> Seen | None:
    """A filter of the numbers in ``ids`` (a column), about n; None if it would take more than max_bits, then there's to be none."""
    shape = Shape(n, 1 << 62)
    if shape.bits > max_bits:
        return None
    return seen(ids, shape, twice=False, keys_of=lambda batches: ((mix(b.column(0).to_numpy().view(np.uint64)), None) for b in batches))


def where_member(rows: DataFrame, column: str, held: Seen | None) -> DataFrame:
    """The rows whose number is in the filter, and a few others; with no filter, all that aren't null."""
    if held is None:
        return rows.where(F.col(column).isNotNull())
    shared = rows.sparkSession.sparkContext.broadcast(held)

    def some(batches):
        for batch in batches:
            batch = batch.filter(batch.column(column).is_valid())
            yield batch.filter(pa.array(shared.value.holds(mix(batch.column(column).to_numpy().view(np.uint64)))))

    return rows.mapInArrow(some, rows.schema)
