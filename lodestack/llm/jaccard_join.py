"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct shingles (lower-cased A-Z words, ``width`` at a time, or the
whole sequence of fewer words). Two documents link when their sets' Jaccard similarity is at least
``percent`` / 100. The result is one row for each document with the class it belongs to; copies are
never expanded into pairs.

A set's parity sketch has a bit for each value of a hash, flipped by each shingle that has the value.
Its Hamming distance to another sketch is at most the size of the sets' symmetric difference, which
for linked sets of sizes a and b is at most (a + b) * (100 - percent) / (100 + percent).

1. One map makes each document's set, its size, a 128-bit digest of it, a short sketch and its
   signatures. Equal sets become one class, named by its smallest doc_id; from here on a class has one row.
2. Sizes fall into bands (times BAND); a set close under a band's edge is in the next band too.
   A band's sketch is cut into as many parts as its greatest difference allows, plus some to spare.
   By the pigeonhole principle linked sets agree in as many parts as are spare, at least. A signature
   is a 48-bit hash of one part, which is 2^20 bits wide. Parts without shingles are left out,
   unless a set has as many of them as are spare (else linked sets could agree in nothing but those).
   What is left of the spare parts is the set's promise: linked sets have so many signatures in common.
3. Of a set's signatures, in an order that is the same for all, the last (promise - 1) aren't needed: the
   first common one of linked sets is among the others. Those are dealt by value in blocks; only
   signatures of two classes or more come out, each class with the smallest one of its group. Pairs of a
   class and that smallest one that sizes or sketches rule out go; the others are verified on the whole
   sets. Links give components.
4. Groups whose classes aren't all in one component by then are compared completely, between components,
   by sketch; of what passes, first a least spanning forest of each block is verified, then what still
   lies between components. So no link is lost, and the work on pairs within a component, which
   can't change the result, isn't done. A group of more than BLOCK classes is split by the next common
   signature, as long as the promises last, so that short documents that have but a template in common
   part there. Long ones (WIDE parts and more may differ) are compared in blocks: sketches of a large
   group of long texts just under the threshold are compared pair by pair.

Scale: shuffled rows are linear in the shingles; of the texts only those are shuffled whose class is in a
pair (by a filter, as long as that is small). Signatures that are frequent in a task are joined apart,
by a join that splits hot keys; the members of a hot class's verification are dealt to several tasks
(the square root of their number). Nothing is collected but that filter. Tables between the steps are
deleted when they have been read.

Defined cases: a document without words (or null) has an empty set and links with nothing. Repeated
rows and equal texts are one class. Rows of one doc_id are one document in links, one row each in
the result. A null doc_id links with nothing and has a null component. An empty table gives no rows.
Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm import blocks, worker
from lodestack.llm.components import components
from lodestack.llm.twice_seen import member_filter, where_member
from lodestack.llm.words import hashed_words, mix
from lodestack.session import discard, materialize

BAND = 1.5
SPARE = 3
#: Classes that are compared with each other at once.
BLOCK = 256
#: Larger groups of a signature are split instead of compared at once; what they are split into, down to BLOCK.
LARGE = 1 << 12
#: Groups are split only for classes that differ in fewer parts than this, where linked: else splitting makes more rows than it saves.
WIDE = 8
#: Bytes of a signature.
SIGN = 6
#: Signatures that a task holds before it sends them.
HELD = 1 << 18
#: Signatures of a slice of their values, about.
SLICE = 1 << 19
#: How often a signature is among these before it is frequent.
FREQUENT = 64
_U = np.uint64
_SALTS = mix(np.arange(1, 33, dtype=np.uint64) * _U(0xA0761D6478BD642F))
SET_SCHEMA = "doc_id long, n long, s1 long, s2 long, sketch binary, signs binary"


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the shingles that start at each word; a sequence shorter than width is one shingle."""
    n = min(len(words), width)
    if not n:
        return words[:0]
    count = len(words) - n + 1
    out = np.full(count, _SALTS[-n], np.uint64)
    for k in range(n):
        out = mix(out ^ mix(words[k : k + count] + _SALTS[k]))
    return out


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    return np.unique(shingles(words, width))


def difference(total: int, percent: int) -> int:
    """The greatest symmetric difference of linked sets whose sizes sum to total."""
    return total * (100 - percent) // (100 + percent)


@lru_cache(maxsize=4096)
def _edge(band: int) -> int:
    """The least size in a band."""
    return int(np.ceil(BAND**band))


@lru_cache(maxsize=4096)
def parts_of(band: int, percent: int) -> tuple[int, int]:
    """Parts of a band's sketches, and in how many of them linked sets agree at least.

    There are SPARE more of the latter than parts that a set of the band's least size leaves empty, nearly always.
    """
    allowed = difference(2 * (_edge(band + 1) - 1), percent)
    spare, least = SPARE, max(1, _edge(band) * percent // 100)
    while True:
        empty = (allowed + spare) * float(np.exp(-least / (allowed + spare)))
        need = SPARE + int(np.ceil(empty + 3 * empty**0.5)) if empty > 0.01 else SPARE
        if need <= spare or spare > least:
            return allowed + spare, spare
        spare = need


def bands_of(n: int, percent: int) -> list[int]:
    band = int(np.log(n) / np.log(BAND))
    band += (n >= _edge(band + 1)) - (n < _edge(band))
    return [band, band + 1] if 100 * n >= percent * _edge(band + 1) else [band]


def signatures(own: np.ndarray, percent: int) -> list[tuple[int, int, np.ndarray]]:
    """For each band of the set its promise, the parts that linked sets may differ in, and its signatures, one for each part, in the common order."""
    found = []
    for band in bands_of(len(own), percent):
        parts, agreeing = parts_of(band, percent)
        where = ((own >> _U(40)) % _U(parts)).astype(np.int64)
        held = np.zeros(parts, np.uint64)
        np.bitwise_xor.at(held, where, mix((own & _U(0xFFFFF)) ^ _SALTS[0]))
        empty = np.bincount(where, minlength=parts) == 0
        keys = mix(held ^ mix(np.arange(parts, dtype=np.uint64) + _U(band << 32) + _SALTS[1])) >> _U(64 - 8 * SIGN)
        gaps = int(empty.sum())
        if gaps < agreeing:
            found.append((agreeing - gaps, parts - agreeing, np.unique(keys[~empty])))
        else:
            found.append((1, parts - agreeing, np.unique(keys)))
    return found


def _signs(own: np.ndarray, percent: int) -> bytes:
    """The signatures of a set: for each band their number, the promise, the parts that may differ (32 bits each) and SIGN bytes of each signature.

    If WIDE parts or more may differ, only those that are dealt, with promise 1: the others would only serve to split groups.
    """
    out = []
    for promise, allowed, keys in signatures(own, percent):
        if allowed >= WIDE:
            promise, keys = 1, keys[: len(keys) - promise + 1]
        out.append(np.array([len(keys), promise, allowed], np.uint32).tobytes() + keys.view(np.uint8).reshape(-1, 8)[:, :SIGN].tobytes())
    return b"".join(out)


def _bands(raw: bytes):
    """The (promise, parts that may differ, signatures) that ``_signs`` packed."""
    at = 0
    while at < len(raw):
        n, promise, allowed = np.frombuffer(raw, np.uint32, 3, at).tolist()
        keys = np.zeros((n, 8), np.uint8)
        keys[:, :SIGN] = np.frombuffer(raw, np.uint8, SIGN * n, at + 12).reshape(n, SIGN)
        yield promise, allowed, keys.view(np.uint64).ravel()
        at += 12 + SIGN * n


def sketch(own: np.ndarray, percent: int) -> bytes:
    """A parity sketch of at least eight times as many bits as the greatest difference, a power of two."""
    bits = max(64, 1 << (8 * difference(2 * len(own), percent)).bit_length())
    flips = np.bincount((own & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def _fold(raw: np.ndarray, words: int) -> np.ndarray:
    """A sketch brought to a smaller power of two."""
    return np.bitwise_xor.reduce(raw.reshape(-1, words), axis=0)


def sketches_allow(x: bytes, y: bytes, total: int, percent: int) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    words = min(len(a), len(b))
    return int(np.bitwise_count(_fold(a, words) ^ _fold(b, words)).sum()) <= difference(total, percent)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets of the rows from it on) for chunks of a batch (doc_id, text)."""
    for first, stop, words, at in hashed_words(batch.column(1), lower=True):
        yield first, [shingle_set(words[at[k] : at[k + 1]], width) for k in range(stop - first)]


def sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Size, digest, sketch and signatures of each document's set."""

    @worker.task("jaccard_join")
    def rows(batches):
        for batch in batches:
            for first, own in _sets(batch, width):
                n = [len(x) for x in own]
                s1 = [int(np.add.reduce(mix(x ^ _SALTS[2])).view(np.int64)) if len(x) else 0 for x in own]
                s2 = [int(np.bitwise_xor.reduce(mix(x ^ _SALTS[3])).view(np.int64)) if len(x) else 0 for x in own]
                known = batch.column(0).slice(first, len(own))
                flips = [sketch(x, percent) if len(x) else b"" for x in own]
                signs = [_signs(x, percent) if len(x) and d.is_valid else b"" for x, d in zip(own, known, strict=True)]
                yield pa.RecordBatch.from_arrays([known, pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(flips, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "n", "s1", "s2", "sketch", "signs"])

    return docs.mapInArrow(rows, SET_SCHEMA)


_KEYS = (np.uint64, np.int64, np.uint32, np.bool_)
_GROUPS = "k1 long, doc long, n int, least long, least_n int, hot boolean"


def _groups(classes: DataFrame) -> DataFrame:
    """Rows (k1, doc, n, least, least_n) of the signatures that several classes have: a class, its size, and those of the smallest class."""
    wanted = classes.agg(F.sum(F.octet_length("signs"))).first()[0] or 0
    slices = blocks.slice_count(classes, wanted // SIGN, SLICE)
    labels = blocks.labels(slices).tolist()

    @worker.task("jaccard_join")
    def send(batches):
        held: list[list[np.ndarray]] = [[], [], []]
        count = 0
        for batch in batches:
            for doc, n, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                for promise, _, keys in _bands(raw):
                    keys = keys[: len(keys) - promise + 1]
                    held[0].append(keys)
                    held[1].append(np.full(len(keys), doc, np.int64))
                    held[2].append(np.full(len(keys), n, np.uint32))
                    count += len(keys)
                if count >= HELD:
                    yield _dealt(held, labels)
                    held, count = [[], [], []], 0
        if count:
            yield _dealt(held, labels)

    @worker.task("jaccard_join")
    def group(batches):
        own = [[np.zeros(0, kind)] for kind in _KEYS]
        for batch in batches:
            for frequent, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                columns, _ = blocks.unpacked(raw, _KEYS)
                if frequent:
                    yield _group_rows(columns[0], columns[1], columns[2], None, None, columns[3])
                else:
                    for kept, more in zip(own, columns, strict=True):
                        kept.append(more)
        keys, doc, n, hot = (np.concatenate(x) for x in own)
        own.clear()
        order = np.lexsort((doc, keys))
        keys, doc, n, hot = keys[order], doc[order], n[order], hot[order]
        heads, ends = blocks.stretches(keys)
        size = ends - heads
        hot = np.repeat(np.logical_or.reduceat(hot, heads), size) if len(keys) else hot
        some = np.repeat(size > 1, size) | hot
        head = np.repeat(heads, size)[some]
        yield _group_rows(keys[some], doc[some], n[some], doc[head], n[head], hot[some])

    found = materialize(classes.select("doc", "n", "signs").mapInArrow(send, "slice int, frequent boolean, raw binary").repartition(slices, "slice").mapInArrow(group, _GROUPS), "groups")
    plain = found.where(F.col("least").isNotNull()).drop("hot")
    if found.where(F.col("least").isNull()).isEmpty():
        return plain
    # Frequent signatures: both sides have exchanges of their own, which AQE can split at hot keys.
    leaders = found.where(F.col("hot") & (F.col("doc") == F.col("least"))).select("k1", "least", "least_n").distinct()
    apart = found.where(F.col("least").isNull()).drop("least", "least_n", "hot").join(leaders, "k1")
    return plain.unionByName(apart)


def _group_rows(keys, doc, n, least, least_n, hot) -> pa.RecordBatch:
    count = len(keys)
    lead = [pa.nulls(count, pa.int64()), pa.nulls(count, pa.int32())] if least is None else [pa.array(least), pa.array(least_n.astype(np.int32))]
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(doc), pa.array(n.astype(np.int32)), *lead, pa.array(hot)], names=["k1", "doc", "n", "least", "least_n", "hot"])


def _dealt(held: list[list[np.ndarray]], labels: list[int]) -> pa.RecordBatch:
    """Blocks of sorted signatures for each slice; of a frequent one only the smallest class, the others in any slice."""
    keys, doc, n = (np.concatenate(x) for x in held)
    placed = mix(keys)  # the first signatures in order are small numbers
    order = np.lexsort((doc, placed))
    keys, doc, n, placed = keys[order], doc[order], n[order], placed[order]
    heads, ends = blocks.stretches(placed)
    frequent = np.repeat(ends - heads > FREQUENT, ends - heads)
    head = np.zeros(len(keys), bool)
    head[heads] = True
    stays = head | ~frequent
    slices, marks, raws = [], [], []
    for k, a, b in blocks.cuts(placed[stays], len(labels)):
        slices.append(labels[k])
        marks.append(False)
        raws.append(blocks.packed(keys[stays][a:b], doc[stays][a:b], n[stays][a:b], frequent[stays][a:b]))
    rest = np.flatnonzero(~stays)
    for a in range(0, len(rest), 1 << 14):
        at = rest[a : a + (1 << 14)]
        slices.append(labels[int(mix(doc[at[:1]].view(np.uint64) + keys[at[:1]])[0] % _U(len(labels)))])
        marks.append(True)
        raws.append(blocks.packed(keys[at], doc[at], n[at], frequent[at]))
    return pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(marks, pa.bool_()), pa.array(raws, pa.binary())], names=["slice", "frequent", "raw"])


def _plausible(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link."""
    left = facts.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("xa"))
    right = facts.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("xb"))

    @worker.task("jaccard_join")
    def rows(batches):
        for batch in batches:
            sums = np.add(batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            keep = [sketches_allow(x.as_py(), y.as_py(), int(t), percent) for x, y, t in zip(batch.column("xa"), batch.column("xb"), sums, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(rows, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets.

    The texts of the documents in pairs are shuffled once, to meet the pairs (a filter leaves out most
    others, as long as it is small); then each a's set and those of its b's, dealt to about the square
    root of their number of tasks.
    """
    pairs = materialize(pairs, f"{name}-pairs")
    share = pairs.groupBy("a").agg(F.ceil(F.sqrt(F.count(F.lit(1)) / 16.0)).alias("salts"))
    members = pairs.join(share, "a").select(F.col("b").alias("doc"), "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"))
    heads = share.select(F.col("a").alias("doc"), "a", F.explode(F.sequence(F.lit(0), F.col("salts").cast("int") - 1)).alias("salt"), F.lit(0).alias("role"))
    wanted = materialize(members.unionByName(heads).groupBy("doc").agg(F.collect_list("a").alias("a"), F.collect_list("salt").alias("salt"), F.collect_list("role").alias("role")), f"{name}-wanted")
    some = where_member(docs, "doc_id", member_filter(wanted.select("doc"), wanted.count()))
    # By a shuffle, so that no stage has two Python workers a task.
    met = some.join(wanted.hint("merge"), some["doc_id"] == wanted["doc"]).select("doc", "text", "a", "salt", "role")

    @worker.task("jaccard_join")
    def send(batches):
        for batch in batches:
            names = ["doc", "a", "salt", "role", "own"]
            for first, stop, words, at in hashed_words(batch.column(1), lower=True):
                out: list[list] = [[], [], [], [], []]
                size = 0
                for k in range(first, stop):
                    raw = shingle_set(words[at[k - first] : at[k - first + 1]], width).tobytes()
                    for a, salt, role in zip(batch.column(2)[k].as_py(), batch.column(3)[k].as_py(), batch.column(4)[k].as_py(), strict=True):
                        for column, value in zip(out, (batch.column(0)[k].as_py(), a, salt, role, raw), strict=True):
                            column.append(value)
                        size += len(raw)
                        if size > 1 << 23:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, _SENT, strict=True)], names=names)
                            out, size = [[], [], [], [], []], 0
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, _SENT, strict=True)], names=names)

    @worker.task("jaccard_join")
    def test(batches):
        now, heads_now = None, []
        for batch in batches:
            a, b = [], []
            for k in range(len(batch)):
                key = (batch.column(1)[k].as_py(), batch.column(2)[k].as_py())
                own = np.frombuffer(batch.column(4)[k].as_py(), np.uint64)
                if key != now:
                    now, heads_now = key, []
                if batch.column(3)[k].as_py() == 0:
                    heads_now.append(own)
                elif any(linked(x, own, percent) for x in heads_now):
                    a.append(key[0])
                    b.append(batch.column(0)[k].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    sent = met.mapInArrow(send, "doc long, a long, salt int, role int, own binary")
    found = materialize(sent.repartition("a", "salt").sortWithinPartitions("a", "salt", "role").mapInArrow(test, "a long, b long"), name)
    discard(pairs, wanted)
    return found


_SENT = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())


def _across(named: DataFrame, classes: DataFrame, percent: int, forest: bool) -> DataFrame:
    """All pairs (a, b) of classes with a common signature that are in different components and that sizes and sketches allow.

    As a forest, of the pairs of a block of classes only those that join what nearer pairs don't.
    ``named`` has rows (k1, doc, root). Large groups go on split by their next common signature: linked classes
    have as many in common as the greater of their promises, so a group is compared after so many rounds. What a round
    finds is written: one plan of all rounds, which the driver plans anew after each of its stages, grows with their square.
    """
    facts = classes.select("doc", "n", "sketch")
    signs = classes.select("doc", "signs")

    def compared(rows: DataFrame) -> DataFrame:
        return materialize(_compared(rows, facts, percent, forest), "compared")

    held = materialize(_mixed(named.select("k1", F.col("k1").alias("last"), "doc", "root", F.lit(1).alias("promise")), 1), "mixed")
    found = [compared(held.where(F.col("held") <= LARGE))]
    length, most = 1, LARGE
    while True:
        large = held.where(F.col("held") > most).drop("held")
        if large.isEmpty():
            break
        step = materialize(_split(large, signs, length), "split")
        found.append(compared(step.where("weak IS NOT NULL")))
        length += 1
        before, held = held, materialize(_mixed(step.where("weak IS NULL").drop("weak").distinct(), length), "mixed")
        discard(before, step)
        most = BLOCK
        found.append(compared(held.where(F.col("held") <= BLOCK)))
    out = found.pop() if len(found) == 1 else materialize(reduce(DataFrame.unionByName, found).distinct(), "across")
    discard(held, *found)
    return out


def _mixed(rows: DataFrame, length: int) -> DataFrame:
    """The rows of groups (k1) with several components and a promise of ``length`` common signatures, with ``held``, the number of classes."""
    several = rows.groupBy("k1").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("held"), F.max("promise").alias("most")).where(f"low < high AND most >= {length}").select("k1", "held")
    return rows.join(several, "k1")


def _split(large: DataFrame, signs: DataFrame, length: int) -> DataFrame:
    """Rows of large groups with ``length`` signatures in common, to be compared now or (weak is null) with each that may be the next common one.

    Weak classes promise just so many; they are compared with each other and with those that promise less.
    If linked classes may differ in WIDE parts, all are weak and nothing goes on.
    """

    @worker.task("jaccard_join")
    def rows(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for k1, last, doc, root, raw in zip(*(batch.column(c).to_pylist() for c in ("k1", "last", "doc", "root", "signs")), strict=True):
                sign = np.array(last, np.int64).view(np.uint64)
                for promise, allowed, keys in _bands(raw):
                    at = int(np.searchsorted(keys, sign))
                    if at == len(keys) or keys[at] != sign:
                        continue
                    wide = allowed >= WIDE
                    after = keys[:0] if wide else keys[at + 1 : len(keys) - max(promise, length + 1) + length + 1]
                    now = wide or promise <= length
                    count = now + len(after)
                    out[0] += [k1] * now + mix(mix(after) ^ np.array(k1, np.int64).view(np.uint64)).view(np.int64).tolist()
                    out[1] += [last] * now + after.view(np.int64).tolist()
                    out[2] += [doc] * count
                    out[3] += [root] * count
                    out[4] += [promise] * count
                    out[5] += [wide or promise == length] * now + [None] * len(after)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:4]), pa.array(out[4], pa.int32()), pa.array(out[5], pa.bool_())], names=["k1", "last", "doc", "root", "promise", "weak"])

    return large.join(signs, "doc").select("k1", "last", "doc", "root", "signs").mapInArrow(rows, "k1 long, last long, doc long, root long, promise int, weak boolean")


def _compared(rows: DataFrame, facts: DataFrame, percent: int, forest: bool) -> DataFrame:
    """The pairs within groups, across components, that sizes and sketches allow, in blocks of BLOCK classes.

    Where rows have ``weak``, one of a pair is weak at least.
    """
    if "weak" in rows.columns:
        counts = rows.groupBy("k1").agg(F.ceil(F.count_if("weak") / float(BLOCK)).cast("int").alias("weaks"), F.ceil(F.count_if(~F.col("weak")) / float(BLOCK)).cast("int").alias("strongs")).where("weaks > 0")
        dealt = rows.join(counts, "k1").withColumn("own", F.pmod(F.xxhash64("doc"), F.when(F.col("weak"), F.col("weaks")).otherwise(F.col("strongs"))).cast("int"))
        weak, strong = dealt.where("weak"), dealt.where("NOT weak")
    else:
        weak = rows.withColumn("weaks", F.ceil(F.col("held") / float(BLOCK)).cast("int")).withColumn("own", F.pmod(F.xxhash64("doc"), F.col("weaks")).cast("int"))
    blocks_of = weak.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("weaks") - 1))).select("k1", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "root")
    if "weak" in rows.columns:
        probing = weak.where("strongs > 0").select("k1", F.explode(F.sequence(F.lit(0), F.col("strongs") - 1)).alias("i"), (-1 - F.col("own")).alias("j"), F.lit(0).alias("own"), "doc", "root")
        probed = strong.select("k1", F.col("own").alias("i"), F.explode(F.sequence(-F.col("weaks"), F.lit(-1))).alias("j"), F.lit(1).alias("own"), "doc", "root")
        blocks_of = blocks_of.unionByName(probing).unionByName(probed)
    blocks_of = blocks_of.join(facts, "doc")

    @worker.task("jaccard_join")
    def compare(batches):
        now, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("k1", "i", "j", "own", "doc", "root", "n", "sketch")), strict=True):
                if row[:3] != now:
                    yield from _block(held, now, percent, forest)
                    now, held = row[:3], []
                held.append(row[3:])
        yield from _block(held, now, percent, forest)

    return blocks_of.select("k1", "i", "j", "own", "doc", "root", "n", "sketch").repartition("k1", "i", "j").sortWithinPartitions("k1", "i", "j").mapInArrow(compare, "a long, b long").distinct()


def _block(held: list[tuple], block: tuple | None, percent: int, forest: bool):
    if len(held) < 2 or len({r[2] for r in held}) < 2:
        return
    own, doc, root, n = (np.array([r[k] for r in held], np.int64) for k in range(4))
    words = min(len(r[4]) for r in held) // 8
    flat = np.stack([_fold(np.frombuffer(r[4], np.uint64), words) for r in held])
    left, right, spare = [], [], []
    for k in range(len(held) - 1):
        other = slice(k + 1, None)
        total = n[k] + n[other]
        ok = (root[other] != root[k]) & (100 * np.minimum(n[k], n[other]) >= percent * np.maximum(n[k], n[other]))
        if block[1] != block[2]:
            ok &= own[other] != own[k]
        at = np.flatnonzero(ok)
        apart = np.bitwise_count(flat[other][at] ^ flat[k]).sum(axis=1)
        most = total[at] * (100 - percent) // (100 + percent)
        fits = apart <= most
        left.append(np.full(int(fits.sum()), k))
        right.append(at[fits] + k + 1)
        spare.append(apart[fits] / np.maximum(most[fits], 1))
    left, right, spare = np.concatenate(left), np.concatenate(right), np.concatenate(spare)
    if forest and len(left):
        keep = _joining(root[left], root[right], spare)
        left, right = left[keep], right[keep]
    if len(left):
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(doc[left], doc[right])), pa.array(np.maximum(doc[left], doc[right]))], names=["a", "b"])


def _joining(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The edges of a least spanning forest, by their numbers."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    kept = []
    for k in np.argsort(weight, kind="stable").tolist():
        x, y = top(int(a[k])), top(int(b[k]))
        if x != y:
            above[y] = x
            kept.append(k)
    return np.array(kept, np.int64)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) for every row of docs."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = materialize(sets(plain, width, percent), "sets")
    own = materialize(made.select("doc_id", "n", "s1", "s2"), "sizes")
    same = ["n", "s1", "s2"]
    least = F.min(F.struct(F.col("doc_id").alias("doc"), "sketch", "signs")).alias("least")
    classes = materialize(made.where("n > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(least).select(*same, "least.*"), "classes")
    discard(made)
    facts = classes.select("doc", "n", "sketch")
    groups = _groups(classes)

    star = groups.where("doc <> least AND 100 * least(n, least_n) >= %d * greatest(n, least_n)" % percent)
    pairs = star.select(F.col("least").alias("a"), F.col("doc").alias("b")).distinct()
    links = _verified(_plausible(pairs, facts, percent), plain, width, percent, "star")
    roots = materialize(components(links), "roots")
    # Between components first the nearest pairs of a block that would join them; what is left then is compared completely.
    for forest in (True, False):
        root_of = classes.select("doc").join(roots.select(F.col("node").alias("doc"), "root"), "doc", "left").select("doc", F.coalesce("root", "doc").alias("root"))
        more = _across(groups.select("k1", "doc").join(root_of.distinct(), "doc"), classes, percent, forest)
        if more.isEmpty():
            break
        extra = _verified(more, plain, width, percent, "rest")
        if not extra.isEmpty():
            links = links.unionByName(extra)
            roots = materialize(components(links), "roots")
    placed = classes.select(*same, "doc").join(roots.select(F.col("node").alias("doc"), "root"), "doc", "left").select(*same, F.coalesce("root", "doc").alias("component"))
    out = own.select("doc_id", *same).join(placed, same, "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, of each class of near duplicates only the document with the smallest doc_id.

    Rows of one doc_id count as one document and stay together; those with a null doc_id or without
    words stay.
    """
    gone = near_duplicates(docs, width, percent).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone_doc")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_doc"], "left_anti")


#: The rows for three words and 90 % in DuckDB SQL.
SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [md5(array_to_string(w, ' ')) || len(w)]
    ELSE list_transform(range(1, len(w) - 1), lambda i: md5(array_to_string(w[i : i + 2], ' '))) END) AS s FROM worded
), sized AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), placed AS (
  SELECT doc_id, n, s FROM shingled JOIN sized USING (doc_id)
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c FROM placed a JOIN placed b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL
), links AS (
  SELECT x, y FROM shared WHERE 100 * c >= 90 * (nx + ny - c) UNION ALL SELECT y, x FROM shared WHERE 100 * c >= 90 * (nx + ny - c)
), reach AS (
  SELECT DISTINCT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.node
), roots AS (
  SELECT node, min(root) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM documents d LEFT JOIN sized USING (doc_id) LEFT JOIN roots ON node = d.doc_id
"""
