"""Keys dealt by value in blocks: many to a row, as byte planes.

A row of a block shuffle holds the keys of one task that fall into one slice of the key space, sorted,
with what belongs to each. Byte planes (all first bytes, then all second bytes) let the shuffle's codec
drop what is constant, so a key costs little more than its random bytes. There are as many slices as
partitions, more with more keys, and each slice is a partition of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_U = np.uint64


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as byte planes."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return len(columns[0]).to_bytes(8, "little") + b"".join(planes)


def unpacked(raw: bytes, kinds: tuple[type, ...], at: int = 0) -> tuple[list[np.ndarray], int]:
    """The columns that ``packed`` was given, and the position after them."""
    n = int.from_bytes(raw[at : at + 8], "little")
    at += 8
    out = []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * size
    return out, at


def pressed(*groups: tuple[np.ndarray, ...]) -> bytes:
    """Groups of columns, each group of one length, as byte planes compressed by zstd."""
    raw = b"".join(packed(*g) for g in groups)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def opened(raw: bytes, *kinds: tuple[type, ...]) -> list[list[np.ndarray]]:
    """The groups that ``pressed`` was given."""
    plain = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
    at, out = 0, []
    for own in kinds:
        columns, at = unpacked(plain, own, at)
        out.append(columns)
    return out


def _spark_hash(x: np.ndarray) -> np.ndarray:
    """Spark's hash of an int column (Murmur3, seed 42)."""
    u = np.uint32

    def turned(v: np.ndarray, by: int) -> np.ndarray:
        return (v << u(by)) | (v >> u(32 - by))

    k = turned(x.astype(u) * u(0xCC9E2D51), 15) * u(0x1B873593)
    h = turned(u(42) ^ k, 13) * u(5) + u(0xE6546B64)
    h = h ^ u(4)
    h = (h ^ (h >> u(16))) * u(0x85EBCA6B)
    h = (h ^ (h >> u(13))) * u(0xC2B2AE35)
    return (h ^ (h >> u(16))).view(np.int32)


def labels(n: int) -> np.ndarray:
    """n ints that repartition(n, label) puts into a partition each."""
    found = np.full(n, -1, np.int32)
    at = 0
    while (found < 0).any():
        some = np.arange(at, at + 16 * n, dtype=np.int32)
        where = np.mod(_spark_hash(some).astype(np.int64), n)
        fresh, first = np.unique(where, return_index=True)
        open_ = found[fresh] < 0
        found[fresh[open_]] = some[first[open_]]
        at += 16 * n
    return found


def slice_count(df: DataFrame, keys: int, most: int) -> int:
    """Slices for about so many keys, ``most`` in each: the session's shuffle partitions at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-keys // most))


def cuts(keys: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(slice, first, end) of the slices that sorted 64-bit keys fall into, in n equal parts of the key space."""
    if not len(keys):
        return
    place = ((keys >> _U(32)) * _U(n)) >> _U(32)
    heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    ends = np.concatenate([heads[1:], [len(keys)]])
    yield from zip(place[heads].tolist(), heads.tolist(), ends.tolist(), strict=True)


def stretches(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the groups of equal neighbours."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    heads = np.flatnonzero(change)
    return heads, np.concatenate([heads[1:], [len(change)]]).astype(np.int64)
