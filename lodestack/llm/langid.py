"""Language ID by rank-order profiles.

A profile is a list of the most frequent n-grams (one to three letters of lower-cased words, with
the words' edges), most frequent first. A text's own profile is compared with each language's by
out-of-place distance: the sum of differences of rank, and the greatest difference for n-grams
that the language's profile lacks. The nearest language wins; ties go to the first by code point.
The score is 1 minus the distance's part of the greatest distance possible.

Training counts the whole texts of all labelled documents that are not held out. The model has PROFILE n-grams for each language, so its size depends on the languages alone.
Prediction is one map over the documents.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every text if
nothing is there to learn from. Documents with a null label or text are not learned from. Equal
texts give equal values. A null doc_id hashes as null and is not held out. An empty table gives no
rows. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.llm import worker

#: n-grams of a profile.
PROFILE = 300
UNKNOWN = "und"
#: A text whose score is under this part of what nearly all labelled documents reach is in none of their languages.
FOREIGN = 0.5
#: Codes that training sorts at once, and different ones that a task keeps before it sends them.
_AT_ONCE = 1 << 19
#: Steps of the scores' distribution.
_STEPS = 1 << 16
_BITS = np.uint64(21)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_codes(text: str) -> np.ndarray:
    """Codes of the n-grams of the text's words: three 21-bit fields, a word's edge being 1 and letter c being c + 2."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.uint64)
    codes = np.where(letter, points.astype(np.uint64) + np.uint64(2), np.uint64(1))
    codes = np.concatenate([[np.uint64(1)], codes, [np.uint64(1)]]).astype(np.uint64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 1) | (codes[:-1] != 1)
    codes = codes[keep]
    two = codes[:-1] << _BITS | codes[1:]
    three = two[:-1] << _BITS | codes[2:]
    return np.concatenate([codes[codes != 1], two, three[codes[1:-1] != 1]])


def ranked(codes: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent codes, most frequent first, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.lexsort((values, -counts))[:n]]


class Model:
    """Profiles of languages: ranks[l, k] is the rank of code k in language l, or ``size`` if it isn't there."""

    def __init__(self, profiles: dict[str, list[int]], size: int) -> None:
        self.size, self.languages = size, sorted(profiles)
        self.codes = np.array(sorted({c for p in profiles.values() for c in p}), np.uint64)
        self.ranks = np.full((len(self.languages), len(self.codes) + 1), size, np.int64)
        for row, language in enumerate(self.languages):
            found = np.searchsorted(self.codes, np.array(profiles[language], np.uint64))
            self.ranks[row, found] = np.arange(len(found))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = ngram_codes(text or "")
        if not len(codes) or not len(self.codes):
            return UNKNOWN, 0.0
        own = ranked(codes, self.size)
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        theirs = self.ranks[:, at]
        apart = np.where(theirs == self.size, self.size, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(apart))
        return self.languages[best], 1.0 - float(apart[best]) / (self.size * len(own))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _labelled(docs: DataFrame) -> DataFrame:
    """lang and text of all documents with a label that are not held out."""
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")


class _Counts:
    """Counts of a task's codes by language; what is held is bounded."""

    def __init__(self) -> None:
        self.fresh: dict[str, list[np.ndarray]] = {}
        self.size = 0
        self.counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, lang: str, codes: np.ndarray) -> None:
        self.fresh.setdefault(lang, []).append(codes)
        self.size += len(codes)
        if self.size > _AT_ONCE:
            self.fold()

    def fold(self) -> None:
        for lang, codes in self.fresh.items():
            values, n = np.unique(np.concatenate(codes), return_counts=True)
            if lang in self.counts:
                own, many = self.counts[lang]
                both, at = np.unique(np.concatenate([own, values]), return_inverse=True)
                values, n = both, np.bincount(at, np.concatenate([many, n])).astype(np.int64)
            self.counts[lang] = values, n
        self.fresh, self.size = {}, 0

    def full(self) -> bool:
        return sum(len(values) for values, _ in self.counts.values()) > _AT_ONCE

    def sent(self) -> Iterator[pa.RecordBatch]:
        self.fold()
        for lang, (values, n) in self.counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "code", "n"])
        self.counts = {}


def train(docs: DataFrame, size: int = PROFILE) -> Model:
    """Profiles from all documents with a label that are not held out."""

    @worker.task("langid")
    def count(batches):
        counts = _Counts()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                counts.add(lang.as_py(), ngram_codes(text.as_py()))
                if counts.full():
                    yield from counts.sent()
        yield from counts.sent()

    grams = _labelled(docs).mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = grams.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return Model(profiles, size)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score for every document, from its whole text alone."""

    @worker.task("langid")
    def rows(batches):
        for batch in batches:
            found = [model.predict(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, lang_pred string, score double")


def least_score(docs: DataFrame, model: Model) -> float:
    """The score under which a text is in none of the model's languages: FOREIGN times that which 99 % of all labelled documents that are not held out reach.

    Scores are counted in _STEPS steps; the one in which the lowest hundredth ends counts from its lower end.
    """
    scores = predict(_labelled(docs).select(F.lit(None).cast("long").alias("doc_id"), "text"), model).where(F.col("lang_pred") != UNKNOWN)
    steps = sorted(map(tuple, scores.groupBy(F.floor(F.col("score") * _STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()))
    most, before = 0.01 * sum(n for _, n in steps), 0
    for step, n in steps:
        before += n
        if before >= most:
            return FOREIGN * step / _STEPS
    return 0.0


def keep_languages(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The rows of docs whose text is in one of the model's languages: with a letter, n-grams of its profile, and a score of at least ``least``."""

    @worker.task("langid")
    def rows(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            scores = [model.predict(x.as_py())[1] for x in batch.column(at)]
            yield batch.filter(pa.array([x > 0.0 and x >= least for x in scores], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
