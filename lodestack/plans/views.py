"""Adapter views: the test tables seen as manifests, text items, tables, logs and results.

Each view is a DataFrame here and a common table expression for DuckDB in SQL, written independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.functions import duck
from lodestack.functions import vocabulary as V

REVISIONS = ("original", "Rev A", "Rev C", "3", "v2.1", "current", "R0", " ")
TITLES = (
    "Startup", "2 Mounting the unit", "Safety", "Notes", "Wiring diagram", "Specifications", "Maintenance schedule", "Overview", "Fault codes", "Shutdown", "3.2 Configure the driver", "WARNING",
    "Parts list", "Revision history", "Inspection form", "Install the sensor", "General", "Status LED", "Checklist", "Service bulletin", "4", "A", "Introduction", "Power on", "Routine",
    "Step 5. Verify the seal", "Field notice", "Standard operating procedure", "Straße und Größe", "Cleaning", "Addendum", "Layout", "Details", "Commissioning", "Replace battery", "Terminal layout",
    "Device Manager", "Danger", "Example run", "Quick guide",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    model = lambda n: F.concat(F.lit("M"), (d % n).cast("string"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.sha2("text", 256).alias("checksum"),
        F.col("source").alias("manufacturer"),
        F.upper("lang").alias("family"),
        F.array_distinct(F.array(model(5), model(7))).alias("models"),
        F.when(d % 5 == 0, pick(V.LEGACY_DOCUMENT_TYPES, d)).otherwise(pick(V.DOCUMENT_TYPES, d * 7)).alias("document_type"),
        pick(V.DOCUMENT_CLASSES, F.floor(d / 3)).alias("document_class"),
        pick(REVISIONS, d).alias("revision"),
        F.when(d % 11 != 0, F.date_add(F.lit("2020-01-01").cast("date"), (d % 700).cast("int"))).alias("publication_date"),
        F.when(d % 4 == 0, F.concat(F.lit("Pack "), (d % 3).cast("string"))).alias("curated"),
        F.when(d % 13 == 0, F.lit("deutsch")).otherwise(F.col("lang")).alias("language"),
    )


MANIFESTS = f"""manifests AS (
  SELECT doc_id, sha256(text) AS checksum, source AS manufacturer, upper(lang) AS family,
    list_distinct(['M' || (doc_id % 5), 'M' || (doc_id % 7)]) AS models,
    CASE WHEN doc_id % 5 = 0 THEN {duck.pick(V.LEGACY_DOCUMENT_TYPES, 'doc_id')} ELSE {duck.pick(V.DOCUMENT_TYPES, 'doc_id * 7')} END AS document_type,
    {duck.pick(V.DOCUMENT_CLASSES, 'doc_id // 3')} AS document_class, {duck.pick(REVISIONS, 'doc_id')} AS revision,
    CASE WHEN doc_id % 11 <> 0 THEN DATE '2020-01-01' + (doc_id % 700)::INTEGER END AS publication_date,
    CASE WHEN doc_id % 4 = 0 THEN 'Pack ' || (doc_id % 3) END AS curated,
    CASE WHEN doc_id % 13 = 0 THEN 'deutsch' ELSE lang END AS language
  FROM documents)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as text items: every fourth is a heading with a title of a fixed list; some others are made steps, checkboxes, bullets, figure labels and callouts."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("idx", "line"))
    idx, d = F.col("idx").cast("long"), F.col("doc_id")
    heading = idx % 4 == 0
    n = F.pmod(d + idx, F.lit(10))
    made = (
        F.when(n == 1, F.concat((idx % 7).cast("string"), F.lit(") Turn valve "), idx.cast("string")))
        .when(n == 3, F.lit("- [x] Check seal"))
        .when(n == 5, F.lit("• Look at the gauge"))
        .when(n == 7, F.concat(F.lit("Figure 3-"), idx.cast("string")))
        .when(n == 9, F.lit("A1. Terminal block"))
        .otherwise(F.col("line"))
    )
    kind = F.when((d + idx) % 9 == 0, "title").when((d + idx) % 11 == 5, "page_header").when((d + idx) % 7 == 3, "subtitle").otherwise("section_header")
    return lines.select(
        "doc_id",
        idx.alias("idx"),
        F.when(heading, kind).otherwise("text").alias("label"),
        F.when(heading, pick(TITLES, d * 3 + idx)).otherwise(made).alias("text"),
        F.when(heading, F.pmod(d + F.floor(idx / 4), F.lit(4)) + 1).alias("level"),
        F.when((d + idx) % 3 != 0, F.floor(idx / 8) + 1).alias("page"),
    )


ITEMS = f"""split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(range(0, len(parts))) AS idx, unnest(parts) AS line FROM split),
items AS (
  SELECT doc_id, idx, CASE WHEN idx % 4 <> 0 THEN 'text' WHEN (doc_id + idx) % 9 = 0 THEN 'title' WHEN (doc_id + idx) % 11 = 5 THEN 'page_header' WHEN (doc_id + idx) % 7 = 3 THEN 'subtitle' ELSE 'section_header' END AS label,
    CASE WHEN idx % 4 = 0 THEN {duck.pick(TITLES, 'doc_id * 3 + idx')} ELSE CASE (doc_id + idx) % 10 WHEN 1 THEN (idx % 7) || ') Turn valve ' || idx WHEN 3 THEN '- [x] Check seal'
      WHEN 5 THEN '• Look at the gauge' WHEN 7 THEN 'Figure 3-' || idx WHEN 9 THEN 'A1. Terminal block' ELSE line END END AS text,
    CASE WHEN idx % 4 = 0 THEN (doc_id + idx // 4) % 4 + 1 END AS level,
    CASE WHEN (doc_id + idx) % 3 <> 0 THEN idx // 8 + 1 END AS page
  FROM lines)"""


def tables(paged: DataFrame) -> DataFrame:
    """Tables of paged items: every eighth, some without a page, of two rows, one row or none."""
    i = F.col("idx")
    row = lambda *cells: F.array(*cells)
    data = F.when(i % 3 == 0, F.array(row(F.lit("Part"), F.lit("Value")), row(F.concat(F.lit(" "), i.cast("string"), F.lit("\t")), F.when(i % 5 != 2, F.col("page").cast("string"))))).when(i % 3 == 1, F.array(row(F.lit("Only")))).otherwise(F.array().cast("array<array<string>>"))
    return paged.where(i % 8 == 3).select("doc_id", i.alias("table_no"), F.when(i % 5 != 0, F.col("page") + i % 2).alias("page"), data.alias("data"))


TABLES = """tables AS (SELECT doc_id, idx AS table_no, CASE WHEN idx % 5 <> 0 THEN page + idx % 2 END AS page,
  CASE idx % 3 WHEN 0 THEN '| Part | Value |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || idx || ' | ' || CASE WHEN idx % 5 = 2 THEN 'None' ELSE page::VARCHAR END || ' |' WHEN 1 THEN '| Only |' || chr(10) || '| --- |' || chr(10) || '|  |' ELSE '' END AS markdown
  FROM paged WHERE idx % 8 = 3)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an inference log."""
    u = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("event_type").alias("model"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("run-"), (u % 7).cast("string"))).alias("run"),
        (F.col("event_id") % 900 + 100).alias("prompt_tokens"),
        (u % 300 + 20).alias("completion_tokens"),
    )


LOG = """log AS (
  SELECT event_id, ts, event_type AS model, CASE WHEN event_id % 3 <> 0 THEN 'run-' || (user_id % 7) END AS run,
    event_id % 900 + 100 AS prompt_tokens, user_id % 300 + 20 AS completion_tokens FROM events)"""
