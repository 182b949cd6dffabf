"""Vectors as product codes: each part of a vector by the number of its nearest codebook entry.

Components become integers (256 times, rounded down), so distances, sums and ties are exact and alike
on every machine. A part's nearest entry is found by annular pruning: entries are sorted by their norm;
some entries whose norms are next to the part's give a first distance d; since no entry nearer than d can
have a norm that differs by more than d, two binary searches bound the annulus of norms that may hold a
better one or a tie, and only what lies in it is compared.

Codebooks are small (parts x entries) and go to the driver and the tasks; vectors never do. Each round is
a pass over the vectors in which every task adds up its own parts by entry before anything is shuffled.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do vectors of
another length than the vector of the smallest vec_id that is kept. Null vec_ids come last, rows of one
vec_id in the order of their vectors; each is a row of the result. Integer components beyond 2^27 either way
count as 2^27, so that distances fit 64 bits. Lengths that the number of parts doesn't divide are filled with
zeros at the end. Empty vectors have parts of no components, all at distance 0 of entry 0. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm import worker

#: Components are multiplied by this and rounded down.
SCALE = 256
#: Integer components lie within this, either way.
FARTHEST = 1 << 27
#: Vectors compared at once in a task.
STEP = 4096
#: Entries on either side in the order of norms that give the first distance.
BESIDE = 4
#: Floating norms may err by so much of their size; the annulus is wider by that.
SLACK = 1e-9


@dataclass
class Codebook:
    """One part position's entries, (entries, components)."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        norms = _norms(self.entries)
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]
        self.compared = 0

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, by squared distance and then by number, and that distance."""
        norms, n = _norms(parts), len(parts)
        right = np.searchsorted(self.norms, norms)
        best = np.full(n, np.iinfo(np.int64).max)
        for by in range(-BESIDE, BESIDE):
            beside = self.order[np.clip(right + by, 0, len(self.order) - 1)]
            best = np.minimum(best, _squared(parts, self.entries[beside]))
        reach = np.sqrt(best.astype(np.float64))
        reach += SLACK * (reach + norms) + SLACK
        first = np.searchsorted(self.norms, norms - reach, side="left")
        end = np.searchsorted(self.norms, norms + reach, side="right")
        sizes = end - first
        heads = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(n), sizes)
        entry = self.order[np.arange(sizes.sum()) - heads[row] + first[row]]
        self.compared += len(row)
        found = _squared(parts[row], self.entries[entry])
        least = np.minimum.reduceat(found, heads)
        return np.minimum.reduceat(np.where(found == least[row], entry, len(self.order)), heads), least


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=1)


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -FARTHEST, FARTHEST).astype(np.int64)


def cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(vectors, parts, components of a part), filled with zeros."""
    width = -(-vectors.shape[1] // parts)
    return np.pad(vectors, ((0, 0), (0, parts * width - vectors.shape[1]))).reshape(len(vectors), parts, width)


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is neither null nor holds a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(vector).isNotNull() & finite)


def _batches(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integer vectors) of some rows at a time."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)
    for at in range(0, len(column), STEP):
        yield at, integers(flat[at : at + STEP])


def first_codebooks(kept: DataFrame, key: str, vector: str, parts: int, entries: int) -> tuple[int, np.ndarray] | None:
    """The vectors' length, and as (parts, entries, components) the parts of the vectors of the smallest keys."""
    head = kept.select(key, vector).orderBy(F.asc_nulls_last(key), vector)
    if not (least := head.limit(1).collect()):
        return None
    length = len(least[0][1])
    rows = head.where(F.size(vector) == length).limit(entries).collect()
    own = np.array([r[1] for r in rows], np.float64).reshape(len(rows), length)
    return length, cut(integers(own), parts).transpose(1, 0, 2)


def _assigned(vectors: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = cut(vectors, len(books))
    found = [book.nearest(own[:, p]) for p, book in enumerate(books)]
    return own, np.stack([x[0] for x in found], axis=1), np.stack([x[1] for x in found], axis=1)


def moved(kept: DataFrame, vector: str, length: int, entries: np.ndarray) -> np.ndarray:
    """Codebooks after a round: each entry the rounded-down mean of the parts assigned to it, if any."""
    parts, count, width = entries.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in entries]
        sums, used = np.zeros(parts * count * width, np.int64), np.zeros(parts * count, np.int64)
        for batch in batches:
            for _, vectors in _batches(batch.column(0), length):
                own, code, _ = _assigned(vectors, books)
                cell = code + np.arange(parts) * count
                used += np.bincount(cell.ravel(), minlength=len(used))
                np.add.at(sums.reshape(len(used), width), cell.ravel(), own.reshape(cell.size, width))
        cells = np.flatnonzero(used)
        if not width or not len(cells):
            return
        for at in range(width):
            place = cells * width + at
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums[place]), pa.array(used[cells])], ["cell", "total", "used"])

    rows = kept.select(vector).mapInArrow(worker.task("vector_codes")(summed), "cell long, total long, used long")
    out = entries.copy()
    flat = out.reshape(-1)
    for r in rows.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("used").alias("used")).collect():  # a row for each component of the codebooks
        flat[r.cell] = int(r.total) // r.used
    return out


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[int, np.ndarray] | None:
    """The vectors' length and the codebooks (parts, entries, components) after so many rounds; None without vectors."""
    kept = usable(df, vector)
    if (started := first_codebooks(kept, key, vector, parts, entries)) is None:
        return None
    length, books = started
    same = kept.where(F.size(vector) == length)
    for _ in range(rounds):
        books = moved(same, vector, length, books)
    return length, books


def encode(df: DataFrame, length: int, entries: np.ndarray, carry: tuple[str, ...] = ("vec_id", "label"), vector: str = "embedding") -> DataFrame:
    """The columns named in ``carry``, code (a byte for each part) and error (squared distances summed over parts) of each usable vector."""
    same = usable(df, vector).where(F.size(vector) == length).select(vector, *carry)
    fields = "".join(f"`{c}` {same.schema[c].dataType.simpleString()}, " for c in carry)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in entries]
        for batch in batches:
            for at, vectors in _batches(batch.column(0), length):
                _, code, far = _assigned(vectors, books)
                raw = code.astype(np.uint8).tobytes()
                codes = pa.array([raw[k : k + len(books)] for k in range(0, len(raw), len(books))], pa.binary())
                kept = [batch.column(k + 1).slice(at, len(vectors)) for k in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*kept, codes, pa.array(far.sum(axis=1))], [*carry, "code", "error"])

    return same.mapInArrow(worker.task("vector_codes")(coded), f"{fields}code binary, error long")


def decode(code: bytes, entries: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in the vectors' own units (with the zeros that filled the last part)."""
    return np.concatenate([book[k] for book, k in zip(entries, code, strict=True)]) / SCALE


def digest(entries: np.ndarray) -> str:
    """Of all entries' decimal components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error: error summed over the rows of the same label, null labels together.

    Sums are made for each label before the join; labels may be many, so Spark chooses the join by its size
    and splits the partition of a label that many rows share.
    """
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")


SQL = """WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x)::BIGINT) AS v, len(embedding) // 16 AS w FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, p, v[p * w + 1 : (p + 1) * w] AS x FROM kept, range(16) t(p)),
start AS (SELECT p, e, x AS c FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 64),
{rounds}
pairs AS (SELECT vec_id, label, parts.p, e, list_sum(list_transform(range(1, len(x) + 1), lambda k: (x[k] - c[k]) * (x[k] - c[k])))::BIGINT AS d FROM parts JOIN book2 USING (p)),
found AS (SELECT vec_id, any_value(label) AS label, p, min(d) AS d, arg_min(e, (d, e)) AS e FROM pairs GROUP BY vec_id, p),
rows AS (SELECT vec_id, any_value(label) AS label, string_agg(lower(lpad(printf('%x', e), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM found GROUP BY vec_id),
flat AS (SELECT string_agg(y, ',' ORDER BY p, e, k) AS s FROM (SELECT p, e, unnest(c)::VARCHAR AS y, generate_subscripts(c, 1) AS k FROM book2))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha256((SELECT s FROM flat)) AS codebooks_sha256 FROM rows"""
_ROUND = """pairs{n} AS (SELECT vec_id, parts.p, e, x, list_sum(list_transform(range(1, len(x) + 1), lambda k: (x[k] - c[k]) * (x[k] - c[k])))::BIGINT AS d FROM parts JOIN {before} USING (p)),
near{n} AS (SELECT vec_id, p, any_value(x) AS x, arg_min(e, (d, e)) AS e FROM pairs{n} GROUP BY vec_id, p),
means{n} AS (SELECT p, e, k, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS k FROM near{n}) GROUP BY p, e, k),
fresh{n} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS c FROM means{n} GROUP BY p, e),
book{n} AS (SELECT b.p, b.e, coalesce(f.c, b.c) AS c FROM {before} b LEFT JOIN fresh{n} f USING (p, e)),"""
SQL = SQL.replace("{rounds}", "\n".join(_ROUND.format(n=n, before=before) for n, before in ((1, "start"), (2, "book1"))))
