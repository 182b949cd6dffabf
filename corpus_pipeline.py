"""The corpus pipeline: five stages over ``documents``, each on all that the one before it kept.

1. Language ID: the model is trained on the labelled documents that are not held out; documents go
   that are in none of its languages: without a letter, without an n-gram of a profile, or with half
   the score that 99 % of these labelled documents reach, or less.
2. Line dedup: lines found in three documents or more stay in one; texts and n_chars change.
3. N-gram Jaccard join (five words, similarity 0.8): of each group of near duplicates the document
   with the smallest doc_id stays.
4. Mixing to target weights: each document as often as the mix has it.
5. Packing: the pieces of all of these, each a sequence of a power of two.

All stages but the last return the columns of documents. No stage drops rows for speed.

Defined cases: a null or empty text goes in stage 1. Rows of a null doc_id are kept apart from each other
in stage 3 and are mixed as ordinary rows; rows of one doc_id stay or go together in stage 3. A table without
labels teaches no language, so nothing stays. Empty tables give no rows. Extra columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm import jaccard_join, langid, line_dedup, mixing, packing
from lodestack.llm.tokens import vocabulary
from lodestack.session import materialize, share_code, small_batches, unused


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    model = langid.train(docs)
    return langid.keep_languages(docs, model, langid.least_score(docs, model))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    mine = {c: unused(docs, "own") + c for c in ("n_lines", "n_dropped") if c in docs.columns}  # dedup_lines makes such columns
    left = line_dedup.dedup_lines(docs.withColumnsRenamed(mine)).drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in mine.items()})
    counted = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if "n_chars" in docs.columns else None
    return left.select(*[counted if c == "n_chars" else left[c] for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    return jaccard_join.drop_near_duplicates(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    share_code(spark)
    small_batches(spark)
    return packing.pack(docs, vocabulary(), eager=False)  # the stages before have filled the executors' heaps


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]

#: Language ID, sketches and token ids have no SQL form; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
