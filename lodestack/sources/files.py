"""Readers and writers of the files that documents, records, batches and pages live in.

Schemas are given, never inferred; malformed rows are kept apart or skipped, as said. Sinks write
whole partitions (dynamic overwrite), so a repeated task or run leaves the same files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.functions import strings as S

STRUCTURE = """doc_id string, page_count int,
  texts array<struct<self_ref: string, label: string, text: string, pages: array<int>>>,
  tables array<struct<self_ref: string, pages: array<int>, data: array<array<string>>>>"""
REQUEST = "custom_id string, model string, body string"
RESULT = "custom_id string, status int, response string, error string, _corrupt_record string"


def raw_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files with their SHA-256 and the place they are copied to; the content is read only if it is selected."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    suffix = F.lower(F.regexp_extract(name, r"(\.[A-Za-z0-9]+)$", 1))
    return files.select("path", "length", "modificationTime", F.sha2("content", 256).alias("checksum"), F.concat(F.lit("raw/"), S.slug(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")), suffix).alias("raw_path"), "content")


def yaml_rows(spark: SparkSession, path: str, schema: str, skip: str = "checksum-index.yaml") -> DataFrame:
    """One row for each YAML file under a folder, with its path; files that aren't mappings have only the path."""
    fields = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    texts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.yaml").text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path")).where(~F.endswith(F.col("path"), F.lit(skip)))

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for batch in batches:
            rows = []
            for value, where in zip(batch["value"], batch["path"], strict=True):
                try:
                    own = yaml.safe_load(value)
                except yaml.YAMLError:
                    own = None
                rows.append({"path": where} | ({f: own.get(f) for f in fields} if isinstance(own, dict) else {}))
            yield pd.DataFrame(rows, columns=["path", *fields], dtype=object)

    return texts.mapInPandas(load, f"path string, {schema}")


def by_path(rows: DataFrame) -> DataFrame:
    """Rows of files in the order of their paths; readers give them in no order."""
    return rows.sort("path")


def structures(spark: SparkSession, path: str) -> DataFrame:
    """Parse artifacts, one JSON document in each file."""
    return spark.read.schema(STRUCTURE).option("multiLine", "true").json(path)


def text_items(artifacts: DataFrame) -> DataFrame:
    """Text items of parse artifacts, in order, with their distinct pages."""
    rows = artifacts.select("doc_id", F.posexplode("texts").alias("idx", "t"))
    return rows.select("doc_id", F.col("idx").cast("long"), F.col("t.self_ref").alias("item_ref"), "t.label", "t.text", F.array_distinct("t.pages").alias("pages"))


def table_items(artifacts: DataFrame) -> DataFrame:
    """Tables of parse artifacts with their numbers of rows and (most) columns; without data 0 by 0."""
    rows = artifacts.select("doc_id", F.posexplode("tables").alias("idx", "t"))
    data = F.coalesce("t.data", F.array().cast("array<array<string>>"))
    width = F.coalesce(F.array_max(F.transform(data, lambda r: F.greatest(F.size(r), F.lit(0)))), F.lit(0))
    return rows.select("doc_id", F.col("idx").cast("long"), F.col("t.self_ref").alias("item_ref"), F.array_distinct("t.pages").alias("pages"), data.alias("data"), F.size(data).alias("rows"), width.alias("columns"))


def write_requests(items: DataFrame, path: str) -> None:
    """Batch requests as JSON lines, null fields left out."""
    items.select(F.to_json(F.struct(*items.columns)).alias("value")).write.mode("overwrite").text(path)


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Batch results from JSON lines: good rows, and the lines that aren't objects. Blank lines are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", RESULT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    good = F.col("r").isNotNull() & F.col("r._corrupt_record").isNull() & F.col("r.custom_id").isNotNull()
    return rows.where(good).select("r.*").drop("_corrupt_record"), rows.where(~F.coalesce(good, F.lit(False))).select("value")


def frontmatter(page: Column) -> tuple[Column, Column]:
    """The YAML head and the body of a Markdown page; a page without a head is all body. Line ends may be CRLF."""
    text = F.regexp_replace(page, "\r\n", "\n")
    pattern = r"(?s)\A---\n(.*?)\n---\n?(.*)\z"
    has = text.rlike(pattern)
    return F.when(has, F.regexp_extract(text, pattern, 1)), F.when(has, F.regexp_extract(text, pattern, 2)).otherwise(text)


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Markdown pages: path, head and body."""
    texts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(path, wholetext=True)
    head, body = frontmatter(F.col("value"))
    return texts.select(F.col("_metadata.file_path").alias("path"), head.alias("head"), body.alias("body"))


def head_field(head: Column, name: str) -> Column:
    """A scalar of a page's head, unquoted, without a full YAML parser; null if it isn't there."""
    found = F.regexp_extract(head, rf"(?m)^{name}:[ \t]*(.*?)[ \t]*$", 1)
    return F.when(head.rlike(rf"(?m)^{name}:"), F.regexp_replace(found, r"""^(["'])(.*)\1$""", "$2"))


def heads(pages: DataFrame, schema: str) -> DataFrame:
    """Pages (path, head, body) with the fields of their YAML heads, lists too; heads that aren't mappings have none."""
    fields = [f.name for f in pages.sparkSession.createDataFrame([], schema).schema.fields]

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for batch in batches:
            rows = []
            for head in batch["head"]:
                try:
                    own = yaml.safe_load(head or "")
                except yaml.YAMLError:
                    own = None
                rows.append([own.get(f) if isinstance(own, dict) else None for f in fields])
            yield pd.DataFrame(rows, columns=fields, dtype=object).assign(path=batch["path"].to_numpy(), body=batch["body"].to_numpy())[["path", *fields, "body"]]

    return pages.select("path", "head", "body").mapInPandas(load, f"path string, {schema}, body string")


def replace_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write df so that partitions it has rows for are replaced and others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
