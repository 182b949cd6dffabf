"""One level of an n-gram trie, in few bytes: contexts, their successors and the successors' probabilities.

The grams of a level are sorted by context and then by successor. Kept are three monotone sequences and a
code for each gram:

- the contexts' ids, increasing;
- pointers: where each context's successors begin;
- the successors' ids. Within a context they increase; each context's begin where those of the one before have
  ended, so that the whole level is monotone;
- the probability as a 16-bit code of its logarithm, or the count where whoever asks makes the code from it, or both.

Sequences are Elias-Fano coded in chunks: low bits as they are, high bits in unary. Each chunk's first value is kept
plain, so a successor search goes to one chunk and decodes that. A level is one run of bytes that can be memory-mapped;
nothing but the chunks that are asked for is decoded.
"""

from __future__ import annotations

import numpy as np

#: Values of a chunk.
CHUNK = 4096
#: Steps of a code in one power of ten; codes end at 16 powers.
STEPS = 4096
_U = np.uint64


def coded(log10: np.ndarray) -> np.ndarray:
    """16-bit codes of logarithms of probabilities."""
    return np.clip(np.rint(-log10 * STEPS), 0, 65535).astype(np.uint16)


def decoded(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) / -STEPS


class EliasFano:
    """A non-decreasing sequence of integers below 2^62."""

    def __init__(self, size: int, bases: np.ndarray, widths: np.ndarray, offsets: np.ndarray, bits: np.ndarray) -> None:
        self.size, self.bases, self.widths, self.offsets, self.bits = size, bases, widths, offsets, bits

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.int64)
        bases, widths, offsets, parts, at = values[::CHUNK], [], [0], [], 0
        for k, base in enumerate(bases.tolist()):
            own = values[k * CHUNK : (k + 1) * CHUNK] - base
            width = max(0, (int(own[-1]) // len(own)).bit_length() - 1)
            high = np.zeros((int(own[-1]) >> width) + len(own), np.uint8)
            high[(own >> width) + np.arange(len(own))] = 1
            low = ((own[:, None] >> np.arange(width)) & 1).astype(np.uint8)
            parts += [np.packbits(low).tobytes(), np.packbits(high).tobytes()]
            at += len(parts[-1]) + len(parts[-2])
            widths.append(width)
            offsets.append(at)
        head = np.array([len(values), len(bases), at], np.int64).tobytes()
        raw = b"".join([head, bases.astype(np.int64).tobytes(), np.array(offsets, np.int64).tobytes(), np.array(widths, np.uint8).tobytes(), *parts])
        return raw + bytes(-len(raw) % 8)

    @classmethod
    def over(cls, raw: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence that begins at byte ``at``, and where it ends."""
        size, chunks, length = np.frombuffer(raw, np.int64, 3, at).tolist()
        at += 24
        bases = np.frombuffer(raw, np.int64, chunks, at)
        at += 8 * chunks
        offsets = np.frombuffer(raw, np.int64, chunks + 1, at)
        at += 8 * chunks + 8
        widths = np.frombuffer(raw, np.uint8, chunks, at)
        at += chunks
        bits = np.frombuffer(raw, np.uint8, length, at)
        at += length
        return cls(size, bases, widths, offsets, bits), at + -at % 8

    def chunk(self, k: int) -> np.ndarray:
        size = min(CHUNK, self.size - k * CHUNK)
        width, begin, end = int(self.widths[k]), int(self.offsets[k]), int(self.offsets[k + 1])
        middle = begin + (size * width + 7) // 8
        high = np.flatnonzero(np.unpackbits(self.bits[middle:end]))[:size] - np.arange(size)
        out = self.bases[k] + (high << width)
        if width:
            low = np.unpackbits(self.bits[begin:middle], count=size * width).reshape(size, width)
            for bit in range(width):
                out += low[:, bit].astype(np.int64) << bit
        return out

    def _by_chunk(self, chunks: np.ndarray):
        """(chunk, the places in ``chunks`` that ask for it)."""
        order = np.argsort(chunks, kind="stable")
        sorted_ = chunks[order]
        cuts = np.flatnonzero(np.diff(sorted_)) + 1
        for places in np.split(order, cuts) if len(order) else ():
            yield int(chunks[places[0]]), places

    def at(self, places: np.ndarray) -> np.ndarray:
        """The values at some places."""
        out = np.zeros(len(places), np.int64)
        for k, own in self._by_chunk(places // CHUNK):
            out[own] = self.chunk(k)[places[own] - k * CHUNK]
        return out

    def successors(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first value that isn't less than each target, and whether it is the target."""
        place, same = np.full(len(targets), self.size, np.int64), np.zeros(len(targets), bool)
        if not self.size:
            return place, same
        for k, own in self._by_chunk(np.maximum(np.searchsorted(self.bases, targets, side="left") - 1, 0)):
            values, asked = self.chunk(k), targets[own]
            found = np.searchsorted(values, asked, side="left")
            inside = found < len(values)
            after = self.bases[k + 1] if k + 1 < len(self.bases) else -1
            place[own] = k * CHUNK + found
            same[own] = np.where(inside, values[np.minimum(found, len(values) - 1)] == asked, asked == after)
        return place, same


class Level:
    """The grams of one order (or of one slice of it) over the bytes that ``build`` has made."""

    def __init__(self, raw: memoryview) -> None:
        has_codes = bool(np.frombuffer(raw, np.int64, 1)[0])
        self.contexts, at = EliasFano.over(raw, 8)
        self.pointers, at = EliasFano.over(raw, at)
        self.followers, at = EliasFano.over(raw, at)
        self.codes = np.frombuffer(raw, np.uint16, self.followers.size * has_codes, at)
        at += 2 * len(self.codes)
        self.counts = np.frombuffer(raw, np.uint32, (len(raw) - at) // 4, at + -at % 4)

    @staticmethod
    def build(contexts: np.ndarray, sizes: np.ndarray, followers: np.ndarray, codes: np.ndarray | None, counts: np.ndarray | None = None) -> bytes:
        """Contexts in order, the number of successors of each (at least one), their successors in order, and codes, counts or both."""
        begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        last = followers[begins[1:] - 1].astype(np.int64) + 1 if len(contexts) else np.zeros(0, np.int64)
        shift = np.cumsum(last) - last
        monotone = followers.astype(np.int64) + np.repeat(shift, sizes)
        raw = np.array([codes is not None], np.int64).tobytes() + EliasFano.encode(contexts.astype(np.int64)) + EliasFano.encode(begins) + EliasFano.encode(monotone)
        raw += b"" if codes is None else codes.astype("<u2").tobytes()
        raw += bytes(-len(raw) % 4)
        return raw if counts is None else raw + np.minimum(counts, 2**32 - 1).astype("<u4").tobytes()

    def find(self, contexts: np.ndarray, sizes: np.ndarray, followers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For grams given as contexts, the number of successors asked of each, and these: the place in the level, or -1, and the
        place among the context's own; and where each context's successors begin (0 if the level hasn't the context)."""
        if not self.contexts.size:
            return np.full(len(followers), -1), np.zeros(len(followers), np.int64), np.zeros(len(contexts), np.int64)
        where, known = self.contexts.successors(contexts)
        where = np.minimum(where, self.contexts.size - 1)
        begin, end = self.pointers.at(where), self.pointers.at(where + 1)
        shift = np.zeros(len(where), np.int64)
        shift[begin > 0] = self.followers.at(begin[begin > 0] - 1) + 1
        own = np.repeat(np.arange(len(contexts)), sizes)
        found, same = self.followers.successors(followers.astype(np.int64) + shift[own])
        same &= known[own] & (found >= begin[own]) & (found < end[own])
        return np.where(same, found, -1), found - begin[own], np.where(known, begin, 0)
