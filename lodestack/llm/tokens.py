"""Token ids of whole texts by a public vocabulary file, one library call for each new word.

The normalizer and the split pattern of KNOWN never join characters across white space, and
white space itself is dropped. So the ids of a text are those of its words in turn, and a word
needs to be encoded once while it is in the cache. For files with other ones, or with a dropout, the
library's whole pipeline encodes whole texts.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa

from lodestack.llm import worker

#: Words kept in a worker's cache, which starts anew when it is full (about 150 bytes each).
CACHED_WORDS = 1_000_000
#: Places (a byte each) of the filter that tells which words came before; it starts anew when it is half full.
FILTER = 1 << 21
#: Longer words are encoded each time.
CACHED_BYTES = 48
_MARKS = b".,;:!?"
#: Letters that the vocabulary's normalizer leaves alone and its split pattern never parts.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


# The parts of a vocabulary file that the short way is right for.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def by_words(path: str) -> bool:
    """Whether a vocabulary file's texts may be encoded word by word."""
    with open(path, encoding="utf-8") as file:
        own = json.load(file)
    same = all(own.get(k) == v for k, v in KNOWN.items())
    return same and own["model"].get("type") == "BPE" and not own["model"].get("dropout") and all(x["content"].startswith("<|") for x in own.get("added_tokens", ()))


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordEncoder:
    """Encodes texts with the tokenizers library, without special tokens.

    Unless ``eager``, words are kept from the second time on that they are asked of the library: most come but once, so this
    takes less memory and more time.
    """

    def __init__(self, path: str, eager: bool = True) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.by_words = by_words(path)
        self.letters = _byte_letters()
        self.cache: dict[bytes, bytes] = {}
        self.eager, self.before, self.marks = eager, bytearray(0 if eager else FILTER), 0

    def _again(self, words: list[bytes]) -> list[bytes]:
        """Those of ``words`` that came before, as far as the filter knows."""
        if self.marks > FILTER // 2:
            self.before, self.marks = bytearray(FILTER), 0
        out = []
        for w in words:
            place = hash(w) % FILTER
            if self.before[place]:
                out.append(w)
            else:
                self.before[place] = 1
                self.marks += 1
        return out

    def _ask(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids by the library: its whole pipeline, or for words of plain letters the model alone."""
        found, others = {}, []
        for w in words:
            text = w.decode().lower()
            if _PLAIN.fullmatch(text):
                text = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
                found[w] = struct.pack(f"<{len(t := self.model.tokenize(text))}I", *[x.id for x in t])
            else:
                others.append(w)
        for w, x in zip(others, self.library.encode_batch_fast([w.decode() for w in others], add_special_tokens=False), strict=True):
            found[w] = struct.pack(f"<{len(x.ids)}I", *x.ids)
        return found

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of ``words``. A tail of marks after a letter or digit is a token of its own."""
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        for w in words:
            stem = w.rstrip(_MARKS)
            if stem and len(stem) < len(w) and stem[-1:].isalnum():
                parts[w] = stem, w[len(stem) :]
        need = {p for w in words for p in parts.get(w, (w,))}
        known = {p: self.cache[p] for p in need if p in self.cache}
        known |= self._ask([p for p in need if p not in known])
        learned = {w: b"".join([known[p] for p in parts[w]]) if w in parts else known[w] for w in words}
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        known |= learned
        short = [w for w in known if len(w) <= CACHED_BYTES]
        self.cache.update((w, known[w]) for w in (short if self.eager else self._again(short)))
        return learned

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, for texts in UTF-8."""
        if not self.by_words:
            whole = self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in whole]
        split, found, missing = [], [], set()
        for text in texts:
            # ASCII capitals may be lowered beforehand, unless that could make a special token
            # of a text or let a combining mark join what it would not have joined.
            plain = b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text
            words = (text.lower() if plain else text).split()
            ids = list(map(self.cache.get, words))
            if None in ids:
                missing.update([w for w, x in zip(words, ids, strict=True) if x is None])
            split.append(words)
            found.append(ids)
        learned = self._learn(missing) if missing else {}
        return [b"".join([learned[w] if x is None else x for w, x in zip(words, ids, strict=True)] if learned and None in ids else ids) for words, ids in zip(split, found, strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str, eager: bool = True) -> WordEncoder:
    return WordEncoder(path, eager)


def _drop() -> bool:
    held = encoder.cache_info().currsize > 0
    encoder.cache_clear()
    return held


worker.keeps("tokens", _drop)


def encoded(column: pa.Array, path: str, end_id: int, step: int = 1 << 20, eager: bool = True) -> Iterator[tuple[int, bytes]]:
    """(row, ids with the end id) for each text of a column; null counts as empty."""
    worker.trim()  # what the batch before left
    own, end = encoder(path, eager), struct.pack("<I", end_id)
    values = column.cast(pa.large_binary())
    row, n = 0, len(values)
    while row < n:
        texts, size, first = [], 0, row
        while row < n and (size < step or not texts):
            texts.append(values[row].as_py() or b"")
            size += len(texts[-1])
            row += 1
        for k, ids in enumerate(own.encode(texts)):
            yield first + k, ids + end


def vocabulary() -> str:
    """The vocabulary file of the production queries."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
