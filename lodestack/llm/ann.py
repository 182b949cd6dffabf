"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. Vectors get one more component, sqrt(M^2 - |x|^2) with M the greatest
norm, and queries, scaled to norm M, get 0 there; then the largest inner product is the least distance.
Each of TABLES tables has K functions floor((a . x + b) / w) with normal a. A query visits, in each
table, its own bucket and buckets whose numbers differ by one in some functions, in order of the
expected score of Lv et al. (2007): the sum of squares of the distances to the crossed edges, ranked
once for all queries by the expected sizes of sorted distances. How many buckets are visited is
fitted: of about SAMPLE queries the exact neighbours are found among all rows, and the number is the
least that finds RECALL of them. Of several numbers of functions and widths that one is taken that leaves
the least to compare. If MOST_PROBES buckets a table don't find as many (vectors of very
different norms), all queries are compared with all rows. Candidates of all tables are merged and ranked by the exact inner
product in double precision.

Scale: every row is in the index, TABLES times; vectors and probes meet by bucket. K grows with the
logarithm of the rows, so buckets stay small. Buckets with over a quarter of a partition's share are
split into blocks that go to different partitions, and their probes go to each block; there can be at
most four times as many of those as partitions, which bounds what the tasks get told. A query's vector
goes to a partition once, with all its probes there. Queries that find too few neighbours are compared
with all rows, in blocks.

Defined cases: vectors that are null, zero, hold null or non-finite components, or differ in length
from most others take no part; nor do rows with a null vec_id. Rows of one vec_id are one candidate.
Ties of the score go to the smaller vec_id. With fewer candidates than asked for, all are returned.
An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.llm.words import mix
from lodestack.session import materialize

TABLES = 8
#: What is tried: functions more than the rows ask for, and the width of a function's buckets, in standard deviations of its values.
SHAPES = ((0, 3.0), (2, 3.0), (4, 3.0), (7, 3.0), (8, 5.0), (0, 1.5), (2, 1.5), (4, 1.5))
#: Rows that the share of compared rows is estimated on.
TRIED = 4096
#: Rows of a bucket, about, if all are alike.
BUCKET = 100
SAMPLE = 128
RECALL = 0.94
#: Stored rows of a partition, at least, if there are as many.
HELD = 4096
#: Buckets of a table that a query visits, at most; past them all rows are compared.
MOST_PROBES = 3000
_U = np.uint64
FOUND = "query_id long, vec_id long, score double"


def perturbations(k: int, most: int) -> np.ndarray:
    """Sets of ranks (1 to 2k, 0 for none) of the sorted distances to edges, least expected score first, the empty set included."""
    j = np.arange(1, k + 1)
    low = j * (j + 1) / (4.0 * (k + 1) * (k + 2))
    i = 2 * k + 1 - np.arange(k + 1, 2 * k + 1)
    high = 1 - i / (k + 1.0) + i * (i + 1) / (4.0 * (k + 1) * (k + 2))
    score = np.concatenate([[0.0], low, high])
    sets: list[tuple[int, ...]] = [()]
    queue = [(score[1], (1,))]
    while queue and len(sets) < most:
        cost, own = heapq.heappop(queue)
        if len({min(x, 2 * k + 1 - x) for x in own}) == len(own):
            sets.append(own)
        last = own[-1]
        if last < 2 * k:
            heapq.heappush(queue, (cost - score[last] + score[last + 1], (*own[:-1], last + 1)))
            heapq.heappush(queue, (cost + score[last + 1], (*own, last + 1)))
    out = np.zeros((len(sets), max(1, max(map(len, sets)))), np.int64)
    for row, own in enumerate(sets):
        out[row, : len(own)] = own
    return out


@dataclass
class Index:
    """The hash functions of all tables, and how many buckets a query visits in each."""

    tables: int
    k: int
    norm: float
    functions: np.ndarray  # (dimension + 1, tables * k)
    shifts: np.ndarray
    width: float
    salts: np.ndarray  # (tables, k), for the buckets' names
    probes: int = 1
    #: Whether so many probes find RECALL of the fitted queries' neighbours.
    reached: bool = True
    #: The share of all rows that a query is compared with, about.
    share: float = 1.0

    def values(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """The functions' values before rounding, (rows, tables, k)."""
        norms = np.linalg.norm(vectors, axis=1)
        if query:
            vectors = vectors * (self.norm / norms)[:, None]
            last = np.zeros(len(vectors))
        else:
            last = np.sqrt(np.maximum(self.norm**2 - norms**2, 0.0))
        long = np.concatenate([vectors, last[:, None]], axis=1)
        return ((long @ self.functions + self.shifts) / self.width).reshape(len(vectors), self.tables, self.k)

    def _names(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers.astype(np.int64).view(np.uint64) * self.salts).sum(axis=2, dtype=np.uint64)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        return mix(self._names(np.floor(self.values(vectors, False))))

    def visited(self, vectors: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """The buckets that queries visit, (rows, tables, sets), in order."""
        values = self.values(vectors, True)
        numbers = np.floor(values)
        down = values - numbers
        edges = np.concatenate([down, 1.0 - down], axis=2)
        order = np.argsort(edges, axis=2, kind="stable")
        steps = np.concatenate([_U(0) - self.salts, self.salts], axis=1)  # one down, one up
        steps = np.take_along_axis(np.broadcast_to(steps, edges.shape), order, axis=2)
        steps = np.concatenate([np.zeros((*steps.shape[:2], 1), np.uint64), steps], axis=2)
        names = np.broadcast_to(self._names(numbers)[:, :, None], (*values.shape[:2], len(sets))).copy()
        for column in range(sets.shape[1]):
            names += steps[:, :, sets[:, column]]
        return mix(names)


def _clean(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """id, raw (the components, little-endian) and length of the rows that take part."""
    single = "float" in dict(vectors.dtypes)[column]
    kind = "<f4" if single else "<f8"

    def rows(batches):
        for batch in batches:
            ids, raws, sizes = [], [], []
            for key_of, value in zip(batch.column(0), batch.column(1), strict=True):
                if not (key_of.is_valid and value.is_valid) or value.values.null_count:
                    continue
                own = np.asarray(value.values.to_numpy(zero_copy_only=False), kind)
                if len(own) and np.isfinite(own).all() and own.any():
                    ids.append(key_of.as_py())
                    raws.append(own.tobytes())
                    sizes.append(len(own))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raws, pa.binary()), pa.array(sizes, pa.int32())], names=["id", "raw", "length"])

    return vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<float>" if single else "array<double>").alias("v")).mapInArrow(rows, "id long, raw binary, length int")


def _matrix(raws, kind: str, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), kind).reshape(-1, length).astype(np.float64)


class Nearest:
    """The n best of the vectors that each of some queries has met. No result depends on their order.

    Products of blocks only rule vectors out, with some slack; the scores are sums of products in one
    order for each pair, so equal vectors have equal scores.
    """

    CANDIDATES = 1 << 18

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, n: int) -> None:
        self.ids, self.matrix, self.n = ids, matrix, n
        self.least = np.full(len(ids), -np.inf)
        self.size = np.linalg.norm(matrix, axis=1)
        self.kept: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def meet(self, ids: np.ndarray, vectors: np.ndarray, longest: float, which: np.ndarray | None = None) -> None:
        """All vectors against the queries numbered by ``which`` (all of them, if None)."""
        which = np.arange(len(self.ids)) if which is None else which
        step = max(1, 4_000_000 // max(1, len(which)))
        for at in range(0, len(ids), step):
            some, own = vectors[at : at + step], ids[at : at + step]
            least = (self.least - 1e-9 * longest * self.size)[which]
            row, column = np.nonzero(some @ self.matrix[which].T >= least)
            query = which[column]
            other = own[row] != self.ids[query]
            row, query = row[other], query[other]
            if len(row):
                scores = np.concatenate([(some[row[k : k + 65536]] * self.matrix[query[k : k + 65536]]).sum(axis=1) for k in range(0, len(row), 65536)])
                self.kept.append((query, own[row], scores))
                self.count += len(row)
            if self.count > self.CANDIDATES + 2 * self.n * len(self.ids):
                self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """(query number, id, score) of the best so far, one row for each id of a query."""
        if not self.kept:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, ids, scores = (np.concatenate([x[k] for x in self.kept]) for k in range(3))
        order = np.lexsort((-scores, ids, query))
        query, ids, scores = query[order], ids[order], scores[order]
        fresh = np.concatenate([[True], (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])])
        query, ids, scores = query[fresh], ids[fresh], scores[fresh]
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        heads = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        rank = np.arange(len(query)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(query)]])))
        last = rank == self.n - 1
        self.least[query[last]] = scores[last]
        keep = rank < self.n
        self.kept = [(query[keep], ids[keep], scores[keep])]
        self.count = int(keep.sum())
        return self.kept[0]

    def batch(self) -> pa.RecordBatch:
        query, ids, scores = self.cut()
        return pa.RecordBatch.from_arrays([pa.array(self.ids[query]), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])


def _against_all(queries: tuple[np.ndarray, np.ndarray], rows_in: DataFrame, kind: str, length: int, n: int) -> DataFrame:
    """The n best of all rows for a bounded set of queries (ids, matrix)."""

    def rows(batches):
        nearest = Nearest(*queries, n)
        for batch in batches:
            if len(batch):
                stored = _matrix(batch.column(1).to_pylist(), kind, length)
                nearest.meet(batch.column(0).to_numpy(), stored, float(np.linalg.norm(stored, axis=1).max()))
        yield nearest.batch()

    return rows_in.select("id", "raw").mapInArrow(rows, FOUND)


def _ranked(found: DataFrame, n: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def build(rows_in: DataFrame, kind: str, length: int, every: int, n: int, seed: int = 7) -> Index:
    """Hash functions for the rows, with the number of probes fitted on about SAMPLE queries."""

    def norms(batches):
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array([float(np.linalg.norm(_matrix(batch.column(0).to_pylist(), kind, length), axis=1).max())])], names=["norm"])

    count = rows_in.count()
    norm = rows_in.select("raw").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0] or 1.0
    base = int(np.clip(round(np.log2(max(count, 1) / BUCKET)), 3, 16))

    def shaped(k: int, widths: float) -> Index:
        random = np.random.default_rng(seed)
        width = widths * norm  # a function's standard deviation over directions is the norm, over sqrt(length) a component's
        return Index(TABLES, k, norm, random.standard_normal((length + 1, TABLES * k)), random.uniform(0, width, TABLES * k), width, random.integers(1, 1 << 63, (TABLES, k), dtype=np.uint64) * _U(2) + _U(1))

    index = shaped(base, SHAPES[0][1])
    queries = rows_in.where(F.pmod("id", F.lit(every)) == 0)
    wanted = max(1, -(-count // every) // SAMPLE)
    drawn = queries.where(F.pmod(F.xxhash64(F.lit("ann"), "id"), F.lit(wanted)) == 0).orderBy("id").limit(4 * SAMPLE).collect()
    if not drawn:
        return index
    ids = np.array([r["id"] for r in drawn])
    matrix = _matrix([r["raw"] for r in drawn], kind, length)
    near = _ranked(_against_all((ids, matrix), rows_in, kind, length, n), n).join(rows_in.select(F.col("id").alias("vec_id"), "raw"), "vec_id").select("query_id", "raw").collect()
    if not near:
        return index
    place = {int(q): p for p, q in enumerate(ids)}
    of = np.array([place[r["query_id"]] for r in near])
    neighbours = _matrix([r["raw"] for r in near], kind, length)
    rate = max(1, count // TRIED)
    tried = _matrix([r["raw"] for r in rows_in.where(F.pmod(F.xxhash64(F.lit("tried"), "id"), F.lit(rate)) == 0).select("raw").limit(2 * TRIED).collect()], kind, length)
    found = [_fitted(shaped(min(20, base + more), widths), matrix, of, neighbours, tried) for more, widths in SHAPES]
    # A bucket that is visited costs about as much as two vectors.
    return min(found, key=lambda x: (not x.reached, x.share * count + 2 * TABLES * x.probes))


def _fitted(index: Index, matrix: np.ndarray, of: np.ndarray, neighbours: np.ndarray, tried: np.ndarray) -> Index:
    """The index with the least number of probes that finds RECALL of the neighbours (of: each one's query in matrix), and the share of ``tried`` that is compared then."""
    sets = perturbations(index.k, MOST_PROBES)
    theirs, others = index.buckets(neighbours), index.buckets(tried)
    rank = np.full(len(neighbours), len(sets))
    visits = []
    for q in range(len(matrix)):
        mine = np.flatnonzero(of == q)
        own = index.visited(matrix[q : q + 1], sets)[0]
        visits.append(own)
        for table in range(TABLES):
            order = np.argsort(own[table], kind="stable")
            at = np.minimum(np.searchsorted(own[table][order], theirs[mine, table]), len(order) - 1)
            hit = own[table][order][at] == theirs[mine, table]
            rank[mine] = np.minimum(rank[mine], np.where(hit, order[at], len(sets)))
    last = int(np.sort(rank)[min(len(rank) - 1, int(np.ceil(RECALL * len(rank))) - 1)])
    index.reached = last < len(sets)
    index.probes = last + 1 if index.reached else 1
    if index.reached and len(tried):
        met = [np.any([np.isin(others[:, t], own[t, : index.probes]) for t in range(TABLES)], axis=0).mean() for own in visits[:32]]
        index.share = float(np.mean(met))
    return index


def search(vectors: DataFrame, every: int = 20, n: int = 20, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the n nearest found of each row whose key is divisible by ``every``."""
    spark = vectors.sparkSession
    kind = "<f4" if "float" in dict(vectors.dtypes)[column] else "<f8"
    clean = materialize(_clean(vectors, key, column), "vectors")
    usual = clean.groupBy("length").count().orderBy(F.desc("count"), "length").first()
    length = usual["length"] if usual else 1
    rows_in = clean.where(F.col("length") == length)
    total = usual["count"] if usual else 0
    index = build(rows_in, kind, length, every, n)
    # A partition with few vectors would cost more in merging its finds than it saves.
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total * index.tables // HELD))
    share = max(64, total * index.tables // (4 * parts))

    def indexed(batches):
        for batch in batches:
            if len(batch):
                names = index.buckets(_matrix(batch.column(1).to_pylist(), kind, length)).view(np.int64)
                again = pa.array(np.repeat(np.arange(len(batch)), index.tables))
                yield pa.RecordBatch.from_arrays([pa.array(names.ravel()), batch.column(0).take(again), batch.column(1).take(again)], names=["bucket", "id", "raw"])

    tables = rows_in.select("id", "raw").mapInArrow(indexed, "bucket long, id long, raw binary")
    heavy = {r["bucket"]: -(-r["n"] // share) for r in tables.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share).collect()}

    def part_of(bucket: np.ndarray, block: np.ndarray) -> np.ndarray:
        return (mix(bucket.view(np.uint64) + block.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) % _U(parts)).astype(np.int32)

    def placed(batches):
        for batch in batches:
            bucket, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            blocks = np.array([heavy.get(x, 1) for x in bucket.tolist()], np.uint64)
            block = mix(ids.view(np.uint64)) % np.maximum(blocks, _U(1))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32)), batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(part_of(bucket, block)), pa.array(np.zeros(len(batch), np.int32)), batch.column(1), batch.column(2), keys], names=["part", "kind", "id", "raw", "buckets"])

    sets = perturbations(index.k, index.probes)

    def probing(batches):
        for batch in batches:
            for at in range(0, len(batch), 64):
                some = batch.slice(at, 64)
                visits = index.visited(_matrix(some.column(1).to_pylist(), kind, length), sets).reshape(len(some), -1).view(np.int64)
                rows, listed, sizes = [], [], []
                where = []
                for q in range(len(some)):
                    own = visits[q]
                    blocks = np.array([heavy.get(x, 1) for x in own.tolist()])
                    many = np.repeat(own, blocks)
                    block = np.arange(len(many)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    to = part_of(many, block)
                    order = np.argsort(to, kind="stable")
                    to, many = to[order], many[order]
                    heads = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
                    rows.extend([q] * len(heads))
                    where.append(to[heads])
                    sizes.append(np.diff(np.concatenate([heads, [len(to)]])))
                    listed.append(many)
                again = pa.array(rows, pa.int64())
                ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(listed)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(where)), pa.array(np.ones(len(rows), np.int32)), some.column(0).take(again), some.column(1).take(again), keys], names=["part", "kind", "id", "raw", "buckets"])

    schema = "part int, kind int, id long, raw binary, buckets array<long>"
    queries = rows_in.where(F.pmod("id", F.lit(every)) == 0)
    both = tables.mapInArrow(placed, schema).unionByName(queries.select("id", "raw").mapInArrow(probing, schema))

    def meet(batches):
        held: list[tuple] = []
        stored = None
        for batch in batches:
            role = batch.column(1).to_numpy()
            own = batch.filter(pa.array(role == 0))
            if len(own):
                held.append((own.column(2).to_numpy(), _matrix(own.column(3).to_pylist(), kind, length), own.column(4).flatten().to_numpy()))
            asking = batch.filter(pa.array(role == 1))
            if not len(asking) or not held:
                continue
            if stored is None:
                ids, x, bucket = (np.concatenate([y[c] for y in held]) for c in range(3))
                order = np.argsort(bucket, kind="stable")
                stored = ids[order], x[order], bucket[order]
                longest = float(np.linalg.norm(x, axis=1).max())
                held = held[:1]
            ids, x, bucket = stored
            for at in range(0, len(asking), 1024):
                some = asking.slice(at, 1024)
                nearest = Nearest(some.column(2).to_numpy(), _matrix(some.column(3).to_pylist(), kind, length), n)
                lists = some.column(4)
                visits = lists.flatten().to_numpy()
                who = np.repeat(np.arange(len(some)), lists.value_lengths().to_numpy())
                order = np.lexsort((who, visits))
                visits, who = visits[order], who[order]
                heads = np.flatnonzero(np.concatenate([[True], visits[1:] != visits[:-1]]))
                ends = np.concatenate([heads[1:], [len(visits)]])
                low = np.searchsorted(bucket, visits[heads], "left")
                high = np.searchsorted(bucket, visits[heads], "right")
                for h, e, a, b in zip(heads.tolist(), ends.tolist(), low.tolist(), high.tolist(), strict=True):
                    if b > a:
                        nearest.meet(ids[a:b], x[a:b], longest, np.unique(who[h:e]))
                yield nearest.batch()

    met = both.repartitionById(parts, F.col("part")).sortWithinPartitions("kind").mapInArrow(meet, FOUND)
    result = materialize(_ranked(met, n), "neighbours")

    # The rest: queries that found fewer than there are, or all of them.
    asked = queries.select(F.col("id").alias("query_id")).distinct()
    enough = result.groupBy("query_id").agg(F.count(F.lit(1)).alias("held")).where((F.col("held") >= n) & F.lit(index.reached))
    short = materialize(queries.select(F.col("id").alias("query_id"), F.col("raw").alias("query_raw")).join(asked.join(enough, "query_id", "left_anti"), "query_id"), "short")
    if not short.isEmpty():
        blocks = max(1, total // 5000)
        stored = rows_in.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.lit(0).alias("kind"), "id", "raw")
        sent = short.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("kind"), F.col("query_id").alias("id"), F.col("query_raw").alias("raw"))

        def compare(batches):
            now, ids, raws, nearest_of = None, [], [], []
            for batch in batches:
                for block, role, own, raw in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                    if block != now:
                        yield from _compared(ids, raws, nearest_of, kind, length, n)
                        now, ids, raws, nearest_of = block, [], [], []
                    if role == 0:
                        ids.append(own)
                        raws.append(raw)
                    else:
                        nearest_of.append((own, raw))
                        if len(nearest_of) == 1024:
                            yield from _compared(ids, raws, nearest_of, kind, length, n)
                            nearest_of = []
            yield from _compared(ids, raws, nearest_of, kind, length, n)

        more = stored.unionByName(sent).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(compare, FOUND)
        result = _ranked(result.select("query_id", "vec_id", "score").unionByName(more), n)
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _compared(ids: list, raws: list, asking: list, kind: str, length: int, n: int):
    if ids and asking:
        nearest = Nearest(np.array([q for q, _ in asking], np.int64), _matrix([r for _, r in asking], kind, length), n)
        stored = _matrix(raws, kind, length)
        nearest.meet(np.array(ids, np.int64), stored, float(np.linalg.norm(stored, axis=1).max()))
        yield nearest.batch()
