"""Queries that write a table's rows to a store, to files or through a stream in the shared folder, and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestack.plans.registry import query
from lodestack.plans.views import LOG, log, table
from lodestack.session import keep_until_end, scratch_dir
from lodestack.sources import files, store
from lodestack.streaming import logs


def _folder(spark, name):
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    keep_until_end(spark, path)
    return path


def _name(letter, column):
    return F.concat(F.lit(letter), column.cast("string"))


@query("""WITH first AS (SELECT 'd' || doc_id AS doc_id, 's' || (doc_id % 3) AS section_id, 'r' || doc_id || '-' || unnest([0, 1]) AS record_id, doc_id AS n FROM documents)
  SELECT doc_id, section_id, record_id FROM first WHERE n % 3 <> 0 AND n % 10 <> 0 UNION ALL SELECT 'd' || doc_id, 's' || (doc_id % 3), 'again-' || doc_id FROM documents WHERE doc_id % 3 = 0""")
def record_store(spark, sf_dir):
    """Records in two versions of a store: the second replaces some documents' records and leaves others without any."""
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select(d.alias("n"), _name("d", d).alias("doc_id"), _name("s", d % 3).alias("section_id"), F.lit("spec_value").alias("record_type"))
    path = _folder(spark, "records")
    both = docs.withColumn("j", F.explode(F.array(F.lit("0"), F.lit("1")))).withColumn("record_id", F.concat(F.lit("r"), F.col("n").cast("string"), F.lit("-"), "j"))
    store.write_units(both.drop("n", "j"), path, store.RECORDS, 1)
    again = docs.where("n % 3 = 0").select("doc_id", "section_id", "record_type", F.concat(F.lit("again-"), F.col("n").cast("string")).alias("record_id"))
    store.write_units(again, path, store.RECORDS, 2, units=docs.where("n % 10 = 0").drop("n"))
    schema = "doc_id string, section_id string, record_type string, record_id string"
    return store.read_units(spark, path, store.RECORDS, schema=schema).select("doc_id", "section_id", "record_id")


@query("""SELECT 'good' AS kind, 'c' || doc_id AS custom_id, 200::INTEGER AS status, sha256(text) AS said FROM documents WHERE text IS NOT NULL AND doc_id % 9 <> 0
  UNION ALL SELECT 'bad', NULL, NULL, sha256('no JSON ' || doc_id) FROM documents WHERE doc_id % 9 = 0""")
def batch_results(spark, sf_dir):
    """Results of a batch as JSON lines, some of which are none: rows and bad lines."""
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL OR doc_id % 9 = 0")
    line = F.to_json(F.struct(_name("c", d).alias("custom_id"), F.lit(200).alias("status"), F.col("text").alias("response")))
    path = _folder(spark, "results")
    docs.select(F.when(d % 9 == 0, F.concat(F.lit("no JSON "), d.cast("string"))).otherwise(line).alias("value")).write.text(path)
    good, bad = files.read_results(spark, path)
    rows = good.select(F.lit("good").alias("kind"), "custom_id", "status", F.sha2("response", 256).alias("said"))
    return rows.unionByName(bad.select(F.lit("bad").alias("kind"), F.lit(None).cast("string").alias("custom_id"), F.lit(None).cast("int").alias("status"), F.sha2("value", 256).alias("said")))


@query("""WITH paged AS (SELECT doc_id, coalesce(source, 'x') || ': ' || doc_id AS title, replace(text, chr(13) || chr(10), chr(10)) AS body FROM documents WHERE text IS NOT NULL)
  SELECT 'p' || doc_id || '.md' AS path, title, sha256(body) AS body_hash FROM paged""")
def page_files(spark, sf_dir):
    """Every document as a Markdown page with a YAML head, and the page taken apart again."""
    d = F.col("doc_id")
    title = F.concat(F.coalesce("source", F.lit("x")), F.lit(": "), d.cast("string"))
    pages = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.concat(_name("p", d), F.lit(".md")).alias("path"), title.alias("title"), F.col("text").alias("body"))
    path = _folder(spark, "pages")
    store.page_texts(pages, ["title"]).write.parquet(path)
    head, body = files.frontmatter(F.col("text"))
    return spark.read.parquet(path).select("path", files.head_field(head, "title").alias("title"), F.sha2(body, 256).alias("body_hash"))


@query("""SELECT 'file' AS kind, 'p' || doc_id || '.md' AS name, sha256(coalesce(text, '')) AS told FROM documents
  UNION ALL SELECT 'source', 's' || coalesce(source, 'x'), min(doc_id)::VARCHAR FROM documents GROUP BY coalesce(source, 'x')""")
def publish_files(spark, sf_dir):
    """What a publication leaves: the listed files, and the first snapshot of each source."""
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents")
    staged = docs.select(F.concat(_name("p", d), F.lit(".md")).alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    sources = docs.select(_name("s", F.coalesce("source", F.lit("x"))).alias("doc_id"), d.alias("ordinal"), d.cast("string").alias("first"))
    path = _folder(spark, "publish")
    for _ in range(2):  # a repeated run leaves the same
        store.publish(staged, sources, path, "v1")
    manifest = spark.read.text(f"{path}/manifest").select(F.from_json("value", "files array<struct<path: string, digest: string>>").alias("m")).select(F.explode("m.files").alias("f"))
    listed = manifest.select(F.lit("file").alias("kind"), F.col("f.path").alias("name"), F.col("f.digest").alias("told"))
    held = spark.read.schema("first string, doc_id string").json(f"{path}/_sources").select(F.lit("source").alias("kind"), F.col("doc_id").alias("name"), F.col("first").alias("told"))
    return listed.unionByName(held)


def _streamed(spark, rows, schema, made):
    """Rows written as files, read as a stream that is drained, and what came out of it, a folder for each batch."""
    path = _folder(spark, "stream")
    rows.write.parquet(f"{path}/in")
    stream = made(spark.readStream.schema(schema).parquet(f"{path}/in"))
    logs.drain(stream, f"{path}/checkpoint", lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/out/{n}"))
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{path}/out")


@query(f"""WITH {LOG} SELECT model, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS requests, sum(prompt_tokens + completion_tokens)::BIGINT AS tokens FROM log GROUP BY ALL""")
def log_usage_stream(spark, sf_dir):
    """The inference log as JSON files by date, read as a stream and rolled up by the hour."""
    path = _folder(spark, "logs")
    entries = log(spark, sf_dir).select(F.col("event_id").cast("string").alias("request_id"), F.col("ts").cast("timestamp").alias("ts"), "model", "run", "prompt_tokens", "completion_tokens")
    logs.write_logs(entries, f"{path}/in")
    usage = logs.windowed_usage(logs.read_logs(spark, f"{path}/in"))
    logs.drain(usage, f"{path}/checkpoint", lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/out"), "complete")
    out = spark.read.schema(usage.schema).parquet(f"{path}/out")
    return out.select("model", F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "requests", "tokens")


@query("SELECT DISTINCT 'u' || user_id AS item_id FROM events")
def queue_stream(spark, sf_dir):
    """A queue with repeats as a stream: each item comes out once."""
    items = table(spark, sf_dir, "events").select(_name("u", F.col("user_id")).alias("item_id"), F.col("ts").cast("timestamp").alias("ts"))
    return _streamed(spark, items, "item_id string, ts timestamp", lambda s: logs.once_each(s, "1000 days")).select("item_id")


@query("""WITH files AS (SELECT sha256(coalesce(text, '')) AS checksum, doc_id FROM documents)
  SELECT DISTINCT checksum FROM files WHERE checksum NOT IN (SELECT checksum FROM files WHERE doc_id % 4 = 0)""")
def unseen_stream(spark, sf_dir):
    """Files as a stream, without those whose checksum is known or came before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("checksum"))
    files_ = docs.select("checksum", F.timestamp_seconds(F.col("doc_id") % 1000).alias("ts"))
    return _streamed(spark, files_, "checksum string, ts timestamp", lambda s: logs.unseen(s, docs.where("doc_id % 4 = 0"))).select("checksum")
