"""The queries of the operators, each over its whole table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm import ann, html_extract, jaccard_join, langid, line_dedup, lm_scoring, media, mixing, packing, sale_assembly, substring, token_files, vector_codes
from lodestack.llm.tokens import vocabulary
from lodestack.session import keep_until_end, materialize, scratch_dir, share_code


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return share_code(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), every=20, n=20)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialize(media.encode_media(_table(spark, sf_dir, "documents")), "media")
    return media.decode_media(stored).select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.lower(F.hex("feature")).alias("feature"),
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    keep_until_end(spark, path)
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, vocabulary())
    return token_files.with_checksums(token_files.read_tokens(spark, path))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring.dedup_substrings(_table(spark, sf_dir, "documents").select("doc_id", "text"), width=13)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    if (found := vector_codes.fit(vectors)) is None:
        found = 0, np.zeros((16, 1, 0), np.int64)  # no vector has a code
    coded = materialize(vector_codes.encode(vectors, *found), "vector-codes")
    return vector_codes.with_label_error(coded).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.digest(found[1])).alias("codebooks_sha256"))


def op13_sale_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_assembly.assemble(_table(spark, sf_dir, "sales"), _table(spark, sf_dir, "sale_lines"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_line_dedup, op3_jaccard_join, op4_packing, op5_language_id, op6_nearest, op7_mixing, op8_media, op9_token_files, op10_substring_dedup, op11_lm_scoring, op12_vector_codes, op13_sale_assembly)}
ORACLE_SQL = {"op2_line_dedup": line_dedup.SQL, "op3_jaccard_join": jaccard_join.SQL, "op7_mixing": mixing.SQL, "op10_substring_dedup": substring.SQL, "op12_vector_codes": vector_codes.SQL}
