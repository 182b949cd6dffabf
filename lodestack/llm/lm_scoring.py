"""Scores texts by an n-gram model of a part of them, kept as slices of an Elias-Fano trie.

Tokens are words, A-Z lower-cased, and one end after each text. The model is a mixture of each order with the
one below: P(w | context) = (c(context w) + STRENGTH * P(w | shorter context)) / (c(context) + STRENGTH), down to
P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)). It sums to one over the known words and one unknown. Probabilities
of grams that were seen are kept as 16-bit codes of their logarithm (1/4096 of a power of ten); so are those of the
order below where they are mixed in.

1. Documents become blocks of some 1.3 million tokens, written once: distinct words' hashes, which go when words are counted, and
   each token as a place among them.
2. The words of all blocks are counted in slices of the hashes. A block gets back each word's id and count.
3. For each order, a block sends its distinct grams to slices by their context: the context's id, the successor, and how
   often training documents have it. A slice adds up, builds the trie's level of its
   contexts, maps it into memory and looks all grams up in it.
4. A block gets back for each gram that other blocks have as well its count, and makes the code of its probability from that.
   Below the highest order it gets the gram's place among
   the context's successors too, and for each context where these begin: the place in the level is the context's id for the
   next order. The place among the context's successors is what the next order knows
   the gram by: a small number, relative to the context of the order below, instead of the word's id.

Grams that one block alone can have are counted there, in a level of the trie that is the block's own.

Scale: each order shuffles each block's distinct grams once, and what the block is told of them, as compressed byte planes.
Which document has a gram, and all but its count, stays with the block, which makes its grams anew for each order and for
the sums: nothing that is sent or told grows with a gram's occurrences or with the number of slices. Blocks and what they
were told lie in buckets and aren't shuffled again; what an order has shuffled is deleted before the next one starts.
A context that is so frequent that its successors would fill much of a slice is split by successor, which
its count tells. Nothing of the corpus is broadcast or collected but N, V and the number of tokens. A block has
a row for each slice it has grams of. Slices hold about SLICE grams, in one task at a time.

Words are told apart by 64-bit hashes. Documents that learn are those not held out: crc32 of doc_id as text, mod 10, is not 0.

Defined cases: a null or empty text is its end token alone. A null doc_id is held out. Rows of one doc_id are documents of
their own, repeated rows count as often as they are there. A text of any length lies in one block. Without training
documents N = V = 0 and all probabilities are 1. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
import mmap
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm import worker
from lodestack.llm.blocks import cuts, opened, pressed, slice_count
from lodestack.llm.ngram_trie import Level, coded, decoded
from lodestack.llm.words import hashed_words, mix
from lodestack.session import bucketed, materialize, remove, shuffles_freed

#: Tokens of a block, about.
BLOCK = 5 << 18
#: Grams of a slice, about, counted in each block that has them.
SLICE = 1 << 20
#: A context's count from which on its successors are dealt to several slices.
FREQUENT = 1 << 17
#: How many observations the order below counts for.
STRENGTH = 4.0
_END = np.uint64(1)
_U = np.uint64
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(True))


_TOKENS, _OFTEN, _WORDS = (np.uint32,), (np.uint32,), (np.uint64, np.uint32)
_DOCS = (np.int64, np.uint8, np.uint8, np.uint32)  # doc_id, whether there is one, held out, tokens
_KNOWN = (np.uint64, np.uint64, np.uint8)  # id and count of a word, and whether no other block has it
_CONTEXTS = (np.uint64, np.uint32)  # id, grams
_GRAMS = (np.uint64, np.uint32)  # successor, count in training


def _by_frequency(often: np.ndarray) -> np.ndarray:
    """Places of words, the most frequent first."""
    return np.argsort(-often.astype(np.int64), kind="stable")


def blocks_of(docs: DataFrame) -> DataFrame:
    """Blocks of whole documents, each a row of words (distinct hashes with their counts in training) and one of tokens.

    Tokens are places among the words by frequency in the block, which they come with.
    """

    def one(parts: list[tuple]) -> tuple:
        doc, there, held, sizes = (np.concatenate([p[k] for p in parts]) for k in range(4))
        words, tokens = np.unique(np.concatenate([p[4] for p in parts]), return_inverse=True)
        learns = np.repeat(held == 0, sizes)
        counts = np.bincount(tokens[learns], minlength=len(words))
        often = np.bincount(tokens, minlength=len(words))
        rank = np.empty(len(words), np.uint32)
        rank[_by_frequency(often)] = np.arange(len(words), dtype=np.uint32)  # frequent words are small numbers
        return uuid.uuid4().hex, len(words), len(tokens), pressed((words, counts.astype(np.uint32))), pressed((rank[tokens],), (often.astype(np.uint32),)), pressed((doc, there, held, sizes.astype(np.uint32)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def flushed() -> pa.RecordBatch:
            block, n_words, n_tokens, words, tokens, docs = one(parts)
            parts.clear()
            columns = [block] * 2, [n_words, 0], [n_tokens, 0], [words, None], [None, tokens], [None, docs], ["words", "tokens"]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

        names = ["block", "n_words", "n_tokens", "words", "tokens", "docs", "kind"]
        for batch in batches:
            ids = batch.column(0)
            there = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            held = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
            for first, stop, words, at in hashed_words(batch.column(2), lower=True):
                ends = at[1:] + np.arange(1, stop - first + 1)
                tokens = np.full(len(words) + stop - first, _END)
                inside = np.ones(len(tokens), bool)
                inside[ends - 1] = False
                tokens[inside] = words
                parts.append((ids[first:stop], there[first:stop], held[first:stop], np.diff(at) + 1, tokens))
                size += len(tokens)
                if size >= BLOCK:
                    yield flushed()
                    size = 0
        if parts:
            yield flushed()

    schema = "block string, n_words long, n_tokens long, words binary, tokens binary, docs binary, kind string"
    return docs.select("doc_id", held_out().alias("held"), "text").mapInArrow(worker.task("lm")(rows), schema)


def _word_slices(blocks: DataFrame, n: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ((words, counts),) = opened(raw, _WORDS)
                own = [(k, pressed((words[a:b], counts[a:b]))) for k, a, b in cuts(words, n)]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(own)), pa.array([k for k, _ in own], pa.int32()), pa.array([x for _, x in own], pa.binary())], ["block", "slice", "grams"])

    return blocks.where("kind = 'words'").select("block", "words").mapInArrow(worker.task("lm")(rows), "block string, slice int, grams binary")


def _counted_words(sent: DataFrame, n: int) -> DataFrame:
    """Id and count of each block's words, and on one row of each slice the slice's tokens and distinct words in training."""

    def counted(table: pa.Table) -> pa.Table:
        k = table.column("slice")[0].as_py()
        parts = [opened(x.as_py(), _WORDS)[0] for x in table.column("grams")]
        words, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        total = np.bincount(place, np.concatenate([p[1] for p in parts]).astype(np.float64), len(words)).astype(np.uint64)
        known = total > 0
        ids = np.zeros(len(words), np.uint64)
        ids[np.argsort(-total.astype(np.int64), kind="stable")] = np.arange(len(words), dtype=np.uint64) * _U(n) + _U(k)  # frequent ones are small
        ids[~known] = 0
        alone = (np.bincount(place, minlength=len(words)) == 1).astype(np.uint8)
        ends = np.cumsum([len(p[0]) for p in parts])[:-1]
        told = [pressed((ids[p], total[p], alone[p])) for p in np.split(place, ends)]
        stats = [(int(total.sum()), int(known.sum()))] + [(0, 0)] * (len(told) - 1)
        return pa.table({"block": table.column("block"), "slice": table.column("slice"), "told": pa.array(told, pa.binary()), "n": [s[0] for s in stats], "v": [s[1] for s in stats]})

    return sent.groupBy("slice").applyInArrow(counted, "block string, slice int, told binary, n long, v long")


def _sorting(values: np.ndarray) -> np.ndarray:
    """The stable order of whole numbers, none below 0: they are sorted with their places as low bits, if these fit."""
    bits = max(len(values) - 1, 1).bit_length()
    if len(values) and int(values.max()) < 1 << (63 - bits):
        return np.sort((values.astype(np.int64) << bits) | np.arange(len(values))) & ((1 << bits) - 1)
    return np.argsort(values, kind="stable")


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each value's place among them."""
    order = _sorting(values)
    sorted_ = values[order]
    head = np.ones(len(values), bool)
    head[1:] = sorted_[1:] != sorted_[:-1]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(head) - 1
    return sorted_[head], place


def mixture(count: np.ndarray, low: np.ndarray, context: np.ndarray, strength: float) -> np.ndarray:
    """The logarithms of probabilities, from a gram's count, the code of the order below and the context's count."""
    return np.log10((count.astype(np.float64) + strength * 10 ** decoded(low)) / (context.astype(np.float64) + strength))


@dataclass
class Chain:
    """A block's grams of one order, at each position that has one."""

    doc: np.ndarray  # of each position
    gram: np.ndarray  # at each position, a place in what follows
    id: np.ndarray
    rel: np.ndarray
    count: np.ndarray
    code: np.ndarray
    alone: np.ndarray  # whether no other block has it

    def firsts(self) -> np.ndarray:
        """Whether a position is the first of its document."""
        out = np.ones(len(self.doc), bool)
        out[1:] = self.doc[1:] != self.doc[:-1]
        return out


class Sent:
    """A block's distinct grams of the next order, by slice.

    Slices are asked for those only that training documents may have and that other blocks may have as well. A gram
    whose context, or whose gram of the order below, is in this block alone, is counted here: the block has a level of the
    trie for its own. What no training document can have follows from the order below.
    """

    def __init__(self, chain: Chain, learns: np.ndarray, n: int, strength: float, frequent: int) -> None:
        later = np.flatnonzero(~chain.firsts())
        a, b = chain.gram[later - 1], chain.gram[later]
        self.doc = chain.doc[later]
        keys, self.gram = _distinct(a * max(len(chain.id), 1) + b)
        self.a, self.b = np.divmod(keys, max(len(chain.id), 1))
        self.low = chain.code[self.b]
        self.train = np.bincount(self.gram[learns[self.doc]], minlength=len(keys))
        many = chain.count[self.a].astype(np.float64)
        possible = (many > 0) & (chain.count[self.b] > 0)
        self.own = possible & ((chain.alone[self.a] | chain.alone[self.b]) > 0)
        self.asked = possible & ~self.own
        self.logs = decoded(self.low) + np.where(many > 0, math.log10(strength) - np.log10(many + strength), 0)
        mine = np.flatnonzero(self.own & (self.train > 0))
        exact = mixture(self.train[mine], self.low[mine], many[mine], strength)
        context, sizes = np.unique(self.a[mine], return_counts=True)
        _, level = _mapped(Level.build(context, sizes, self.b[mine], coded(exact)))
        found, _, _ = level.find(context, sizes, self.b[mine])
        self.logs[mine] = decoded(level.codes[found]) if len(mine) else 0
        self.parts = np.clip(-(-chain.count[self.a].astype(np.int64) // frequent), 1, min(n, 2**24))
        own = chain.id[self.a] * _U(2**24) + np.where(self.parts > 1, mix(chain.rel[self.b]) % self.parts.astype(np.uint64), _U(0))
        self.part = own & _U(2**24 - 1)
        self.slice = (mix(own) % _U(n)).astype(np.int64)
        self.chain, self.slices, self.strength = chain, n, strength
        order = np.flatnonzero(self.asked)
        for by in (chain.rel[self.b], chain.id[self.a], self.slice):
            order = order[_sorting(by[order])]
        self.order = order

    def heads(self) -> np.ndarray:
        """Where in ``order`` a context, or a slice, begins."""
        ids, at = self.chain.id[self.a[self.order]], self.slice[self.order]
        out = np.ones(len(ids), bool)
        out[1:] = (ids[1:] != ids[:-1]) | (at[1:] != at[:-1])
        return out

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(slice, its grams)."""
        order, chain = self.order, self.chain
        bounds = np.flatnonzero(np.diff(self.slice[order])) + 1
        for own, head in zip(np.split(order, bounds), np.split(self.heads(), bounds), strict=True) if len(order) else ():
            at = np.flatnonzero(head)
            contexts = chain.id[self.a[own[at]]], np.diff(np.append(at, len(own))).astype(np.uint32)
            yield int(self.slice[own[0]]), pressed(contexts, (chain.rel[self.b[own]], self.train[own].astype(np.uint32)))

    def _mix(self, count: np.ndarray) -> None:
        """The logarithms of what was asked for, from its counts."""
        self.logs[self.order] = mixture(count, self.low[self.order], self.chain.count[self.a[self.order]], self.strength)

    def next(self, told: list[bytes]) -> Chain:
        """The grams as a chain, with what the slices have told, in order of slices."""
        size = len(self.a)
        ids, rel, alone = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.ones(size, np.uint8)
        count = np.where(self.own, self.train, 0).astype(np.uint64)
        parts = [opened(x, _BEGINS, _ALONE, _ANSWER) for x in told]
        if parts:
            begins = np.concatenate([p[0][0] for p in parts])
            alone[self.order] = np.concatenate([p[1][0] for p in parts])
            count[self.order] = self.train[self.order]
            shared = alone[self.order] == 0
            own = self.order[shared]
            place, many = (np.concatenate([p[2][k] for p in parts]) for k in (0, 1))
            at = (begins[(np.cumsum(self.heads()) - 1)[shared]] + place) * _U(self.slices) + self.slice[own].astype(np.uint64)
            count[own] = many
            ids[own] = np.where(many > 0, at, _U(0))
            rel[own] = place * self.parts[own].astype(np.uint64) + self.part[own]
            self._mix(count[self.order])
        return Chain(self.doc, self.gram, ids, rel, count, coded(self.logs), alone)

    def sums(self, told: list[bytes], docs: int) -> np.ndarray:
        """Sums of the logarithms by document, with what the slices have told of the highest order. Of what training documents have, those are codes."""
        parts = [opened(x, _ALONE, _COUNTS) for x in told]
        if parts:
            count = self.train[self.order]
            count[np.concatenate([p[0][0] for p in parts]) == 0] = np.concatenate([p[1][0] for p in parts])
            self._mix(count)
            seen = self.order[count > 0]
            self.logs[seen] = decoded(coded(self.logs[seen]))
        return np.bincount(self.doc, self.logs[self.gram], docs)


_BEGINS = (np.uint64,)  # where a context's successors begin in its slice
_ALONE = (np.uint8,)  # whether no other block has the gram; then its count is the block's own
_ANSWER = (np.uint64, np.uint64)  # of the others: place among the context's own, count
_COUNTS = (np.uint64,)  # of the others, at the highest order


class Grams:
    """What came to a slice: the grams of its blocks, the same ones as one."""

    def __init__(self, sent: list[bytes]) -> None:
        parts = [opened(x, _CONTEXTS, _GRAMS) for x in sent]
        self.sizes = [len(p[1][0]) for p in parts]
        ids, many = (np.concatenate([p[0][k] for p in parts]) for k in (0, 1))
        rel, train = (np.concatenate([p[1][k] for p in parts]) for k in (0, 1))
        self.contexts, dense = _distinct(ids)
        self.sent = np.split(dense, np.cumsum([len(p[0][0]) for p in parts])[:-1])
        keys, self.place = _distinct((np.repeat(dense, many).astype(np.uint64) << _U(40)) | rel)
        self.context = (keys >> _U(40)).astype(np.int64)
        self.rel = keys & _U(2**40 - 1)
        self.seen = np.bincount(self.place, train.astype(np.float64), len(keys)).astype(np.int64)

    def level(self) -> bytes:
        """The trie's level of what training documents have, with the counts."""
        seen = self.seen > 0
        own, sizes = np.unique(self.context[seen], return_counts=True)
        return Level.build(self.contexts[own], sizes, self.rel[seen], None, self.seen[seen])

    def looked_up(self, level: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each gram's place in the level, or -1, its place among its context's successors, and where each context's begin."""
        return level.find(self.contexts, np.bincount(self.context, minlength=len(self.contexts)), self.rel)

    def split(self, values: np.ndarray) -> list[np.ndarray]:
        """Values of the grams, as each block has sent them."""
        return np.split(values[self.place], np.cumsum(self.sizes)[:-1])


def _mapped(raw: bytes) -> tuple[mmap.mmap, Level]:
    with tempfile.TemporaryFile() as file:
        file.write(raw)
        file.flush()
        held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    return held, Level(memoryview(held))


def _answers(sent: DataFrame, highest: bool) -> DataFrame:
    """What blocks have asked of an order."""

    def answered(table: pa.Table) -> pa.Table:
        grams = Grams([x.as_py() for x in table.column("grams")])
        _, level = _mapped(grams.level())
        found, beside, begins = grams.looked_up(level)
        seen = found >= 0
        count = np.where(seen, level.counts[np.maximum(found, 0)] if len(level.counts) else 0, 0).astype(np.uint64)
        alone = (np.bincount(grams.place, minlength=len(seen)) == 1).astype(np.uint8)
        columns = [grams.split(c) for c in (alone, np.where(seen, beside, 0).astype(np.uint64), count)]
        if highest:
            told = [pressed((a,), (c[a == 0],)) for a, _, c in zip(*columns, strict=True)]
        else:
            told = [pressed((begins[context].astype(np.uint64),), (a,), (p[a == 0], c[a == 0])) for context, a, p, c in zip(grams.sent, *columns, strict=True)]
        return pa.table({"block": table.column("block"), "slice": table.column("slice"), "told": pa.array(told, pa.binary())})

    return sent.groupBy("slice").applyInArrow(answered, "block string, slice int, told binary")


def _first(row: dict, told: list[bytes], tokens: int, distinct: int) -> tuple[Chain, np.ndarray, list[np.ndarray]]:
    """A block's single words as a chain, which documents learn, and what is known of the documents: doc_id, whether there is one, held out, tokens, known ones, base score."""
    (rank,), (often,) = opened(row["tokens"], _TOKENS, _OFTEN)
    place = _by_frequency(often)[rank]
    ((doc, there, held, size),) = opened(row["docs"], _DOCS)
    parts = [opened(x, _KNOWN)[0] for x in told]
    ids, count, alone = (np.concatenate([p[k] for p in parts]) for k in range(3))
    logs = np.log10((count + 0.1) / (tokens + 0.1 * (distinct + 1)))
    of = np.repeat(np.arange(len(doc)), size)
    base = np.bincount(of, logs[place], len(doc))
    known = np.bincount(of, count[place] > 0, len(doc)).astype(np.uint32)
    return Chain(of, place, ids, ids, count, coded(logs), alone), held == 0, [doc, there, held, size, known, base]


def _settled(chain: Chain, docs: int) -> np.ndarray:
    """Sums by document of what no higher order asks for: the first positions."""
    first = chain.firsts()
    return np.bincount(chain.doc[first], decoded(chain.code[chain.gram[first]]), docs)


def _told(rows: list[dict] | None) -> list[bytes]:
    """What slices have told a block, in their order."""
    return [r["told"] for r in sorted(rows or (), key=lambda r: r["slice"])]


def _listed(answers: DataFrame, order: int) -> DataFrame:
    """What each block was told of an order, as one row. Bucketed answers aren't shuffled for that, nor to join blocks."""
    return answers.groupBy("block").agg(F.collect_list(F.struct("slice", "told")).alias(f"told_{order}")).hint("merge")


def score(docs: DataFrame, order: int = 3, strength: float = STRENGTH) -> DataFrame:
    """Columns SCORES for each row of ``docs`` (doc_id, text), by a model of grams of up to ``order`` tokens, two at least."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_freed(spark), bucketed(blocks_of(docs), "block", "lm_blocks", by="kind") as blocks, ExitStack() as kept:
        size = blocks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
        n1, n = slice_count(blocks, size.words or 0, SLICE), slice_count(blocks, size.tokens or 0, SLICE)
        words = _counted_words(_word_slices(blocks, n1), n1).repartition(parts, "block")
        words = kept.enter_context(bucketed(words, "block", "lm_words"))
        remove(spark, f"{blocks.scratch_path}/kind=words")  # from here on only tokens are read
        found = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
        tokens, distinct, frequent = found.n or 0, found.v or 0, FREQUENT

        def grams(own: pa.Table, upto: int) -> tuple[Sent, np.ndarray, list[np.ndarray]]:
            """A block's grams of order ``upto``, from what it was told of those below, sums by document of what begins them, and what is known of the documents."""
            row = {c: own.column(c)[0].as_py() for c in own.column_names}
            chain, learns, info = _first(row, _told(row["told_1"]), tokens, distinct)
            settled = _settled(chain, len(learns))
            for k in range(2, upto):
                chain = Sent(chain, learns, n, strength, frequent).next(_told(row[f"told_{k}"]))
                settled += _settled(chain, len(learns))
            return Sent(chain, learns, n, strength, frequent), settled, info

        def sends(upto: int) -> Callable[[pa.Table], pa.Table]:
            def sent_of(own: pa.Table) -> pa.Table:
                rows = list(grams(own, upto)[0].rows())
                return pa.table({"block": pa.array([own.column("block")[0].as_py()] * len(rows), pa.string()), "slice": pa.array([k for k, _ in rows], pa.int32()), "grams": pa.array([x for _, x in rows], pa.binary())})

            return sent_of

        def finished(own: pa.Table, answers: pa.Table) -> pa.Table:
            sent, settled, (doc, there, held, size, known, base) = grams(own, order)
            score = settled + sent.sums(_told(answers.to_pylist()), len(doc))
            ids = pa.array(doc, mask=there == 0)
            return pa.table({"doc_id": ids, "held_out": held.astype(bool), "n_tokens": size.astype(np.int64), "n_known": known.astype(np.int64), "train_tokens": pa.array([tokens] * len(doc), pa.int64()), "base_score": base, "score": score})

        own = blocks.where("kind = 'tokens'").select("block", "tokens", "docs").join(_listed(words, 1), "block")
        for k in range(2, order + 1):
            sent = own.groupBy("block").applyInArrow(sends(k), "block string, slice int, grams binary")
            answers = _answers(sent, k == order)
            if k < order:  # the next order, those above and the sums ask for it
                answers = kept.enter_context(bucketed(answers.repartition(parts, "block"), "block", "lm_answers"))
                own = own.join(_listed(answers, k), "block", "left")
        return materialize(own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finished, SCORES), "lm-scores")
