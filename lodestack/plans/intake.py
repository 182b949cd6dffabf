"""Queries on manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestack.functions import duck
from lodestack.functions import strings as S
from lodestack.functions import vocabulary as V
from lodestack.operators import intake as O
from lodestack.plans.registry import query
from lodestack.plans.views import MANIFESTS, manifests, table
from lodestack.sources import packs, store

_KEY = " || '-' || ".join(duck.slug(c) for c in ("manufacturer", "family", "document_type", "revision"))


@query(f"""WITH {MANIFESTS} SELECT doc_id, {duck.slug('document_type')} AS type_slug, {_KEY} AS document_key,
  {duck.slug('manufacturer')} || '/' || {duck.slug('family')} || '/' || 'manufacturer' AS bucket_id FROM manifests""")
def slug_keys(spark, sf_dir):
    m = manifests(spark, sf_dir)
    return m.select("doc_id", S.slug(F.col("document_type")).alias("type_slug"), O.document_key(m).alias("document_key"), F.concat_ws("/", S.slug(F.col("manufacturer")), S.slug(F.col("family")), F.lit("manufacturer")).alias("bucket_id"))


@query(f"""WITH {MANIFESTS} SELECT doc_id, min(doc_id) OVER (PARTITION BY checksum) AS first_seen, count(*) OVER (PARTITION BY checksum) AS copies,
  doc_id = min(doc_id) OVER (PARTITION BY checksum) AS is_first FROM manifests""")
def checksum_dedup(spark, sf_dir):
    return O.first_by_checksum(manifests(spark, sf_dir), "doc_id").select("doc_id", "first_seen", "copies", "is_first")


@query(f"""WITH {MANIFESTS} SELECT checksum, arg_max(doc_id, 'manifests/d' || doc_id || '.json') AS owner, count(*) AS copies FROM manifests GROUP BY checksum""")
def checksum_index(spark, sf_dir):
    """Of equal checksums the manifest with the last path counts; copies says how many manifests have the checksum."""
    path = F.concat(F.lit("manifests/d"), F.col("doc_id").cast("string"), F.lit(".json"))
    return store.checksum_index(manifests(spark, sf_dir).select("checksum", "doc_id", path.alias("path"))).withColumnRenamed("doc_id", "owner")


_KNOWN = ", ".join(f"'{v.lower()}'" for v in V.DOCUMENT_TYPES + V.LEGACY_DOCUMENT_TYPES)


@query(f"""WITH {MANIFESTS}, judged AS (SELECT doc_id, list_sort(list_filter([
    CASE WHEN NOT regexp_full_match(checksum, '[0-9a-f]{{64}}') THEN 'checksum' END,
    CASE WHEN document_class NOT IN ({', '.join(repr(c) for c in V.DOCUMENT_CLASSES)}) THEN 'document_class' END,
    CASE WHEN lower(document_type) NOT IN ({_KNOWN}) THEN 'document_type' END,
    CASE WHEN NOT coalesce(regexp_full_match(language, '[A-Za-z]{{2}}'), false) THEN 'language' END,
    CASE WHEN trim(manufacturer) = '' THEN 'manufacturer' END,
    CASE WHEN trim(revision) = '' THEN 'revision' END], lambda e: e IS NOT NULL)) AS errors FROM manifests)
  SELECT doc_id, array_to_string(errors, ',') AS errors, len(errors) = 0 AS valid FROM judged""")
def manifest_validate(spark, sf_dir):
    return O.manifest_errors(manifests(spark, sf_dir)).select("doc_id", F.array_join("errors", ",").alias("errors"), (F.size("errors") == 0).alias("valid"))


@query(f"""WITH {MANIFESTS}, keyed AS (SELECT doc_id, {duck.slug('manufacturer')} || '-' || {duck.slug('family')} AS k FROM manifests)
  SELECT doc_id, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS version,
    k || '--v' || lpad((row_number() OVER (PARTITION BY k ORDER BY doc_id))::VARCHAR, 3, '0') AS version_id,
    row_number() OVER (PARTITION BY k ORDER BY doc_id DESC) = 1 AS is_latest FROM keyed""")
def version_history(spark, sf_dir):
    m = manifests(spark, sf_dir).withColumn("k", F.concat_ws("-", S.slug(F.col("manufacturer")), S.slug(F.col("family"))))
    return O.versions(m, "k", "doc_id").select("doc_id", "version", "version_id", "is_latest")


@query("""SELECT user_id, arg_max(event_type, event_id) AS event_type, count(*) AS changes FROM events GROUP BY user_id""")
def status_current(spark, sf_dir):
    return O.latest(spark.read.parquet(f"{sf_dir}/events.parquet"), "user_id", "event_id", "event_type")


_SCOPE = f"{duck.slug('manufacturer')} || '/' || CASE WHEN dimension = 'curated_bucket' THEN {duck.slug('value')} ELSE {duck.slug('family')} END || '/' || replace(dimension, '_', '-')"


@query(f"""WITH {MANIFESTS}, spread AS (
    SELECT doc_id, manufacturer, family, 'manufacturer' AS dimension, manufacturer AS value FROM manifests
    UNION ALL SELECT doc_id, manufacturer, family, 'product_family', family FROM manifests
    UNION ALL SELECT doc_id, manufacturer, family, 'model_applicability', unnest(models) FROM manifests
    UNION ALL SELECT doc_id, manufacturer, family, 'document_type', document_type FROM manifests
    UNION ALL SELECT doc_id, manufacturer, family, 'document_class', document_class FROM manifests
    UNION ALL SELECT doc_id, manufacturer, family, 'curated_bucket', curated FROM manifests WHERE curated IS NOT NULL
    UNION ALL SELECT doc_id, manufacturer, family, 'revision_authority', CASE WHEN trim(revision) = '' THEN 'unknown-revision' ELSE revision END FROM manifests
    UNION ALL SELECT doc_id, manufacturer, family, 'publication_date', coalesce(strftime(publication_date, '%Y-%m-%d'), 'undated') FROM manifests)
  SELECT doc_id, dimension, value, {_SCOPE} AS bucket_id FROM spread""")
def bucket_assign(spark, sf_dir):
    return O.buckets(manifests(spark, sf_dir)).select("doc_id", "dimension", "value", "bucket_id")


@query(f"""WITH {MANIFESTS}, spread AS (SELECT doc_id, manufacturer, family, 'manufacturer' AS dimension, manufacturer AS value FROM manifests UNION ALL SELECT doc_id, manufacturer, family, 'model_applicability', unnest(models) FROM manifests)
  SELECT doc_id, dimension, value, CASE WHEN doc_id % 3 = 0 AND dimension = 'manufacturer' OR doc_id % 5 = 0 AND value = 'M0' THEN '2020-01-01' ELSE '2024-05-05' END AS assigned_at FROM spread""")
def bucket_history(spark, sf_dir):
    """Assignments of two dimensions, of which some were there before."""
    own = O.buckets(manifests(spark, sf_dir)).where(F.col("dimension").isin("manufacturer", "model_applicability")).select("doc_id", "dimension", "value", "bucket_id")
    known = ((F.col("doc_id") % 3 == 0) & (F.col("dimension") == "manufacturer")) | ((F.col("doc_id") % 5 == 0) & (F.col("value") == "M0"))
    prior = own.where(known).withColumn("assigned_at", F.lit("2020-01-01"))
    return O.with_prior(own, prior, F.lit("2024-05-05")).drop("bucket_id")


@query(f"""WITH {MANIFESTS} SELECT doc_id, manufacturer FROM manifests WHERE curated IS NULL""")
def bucket_unassigned(spark, sf_dir):
    m = manifests(spark, sf_dir)
    assigned = O.buckets(m).where(F.col("dimension") == "curated_bucket").select("doc_id")
    return m.join(assigned, "doc_id", "left_anti").select("doc_id", "manufacturer")


_LEVELS = {t: level for level, types in V.PRECEDENCE_LEVELS.items() for t in types}
_ORIGINAL = "trim(lower(revision)) IN ('original', 'initial', 'first-edition', 'first edition', 'rev 0', 'rev0', 'revision 0', 'r0', 'a', 'rev a', 'revision a')"
PRECEDENCE = f"""CASE WHEN lower(document_class) = 'contextual' THEN 8
  WHEN {duck.slug('document_type')} IN ({', '.join(repr(t) for t in V.PRECEDENCE_LEVELS[1])}) THEN 1
  WHEN {duck.slug('document_type')} IN ({', '.join(repr(t) for t in V.PRECEDENCE_LEVELS[2])}) THEN CASE WHEN {_ORIGINAL} THEN 3 ELSE 2 END
  WHEN {duck.slug('document_type')} IN ({', '.join(repr(t) for t in V.PRECEDENCE_LEVELS[4])}) THEN 4
  WHEN {duck.slug('document_type')} IN ({', '.join(repr(t) for t in V.PRECEDENCE_LEVELS[5])}) OR lower(document_class) = 'operational' THEN 5
  WHEN {duck.slug('document_type')} IN ({', '.join(repr(t) for t in V.PRECEDENCE_LEVELS[6])}) THEN 6
  WHEN {duck.slug('document_type')} IN ({', '.join(repr(t) for t in V.PRECEDENCE_LEVELS[7])}) THEN 7 ELSE 8 END::BIGINT"""
REVISION_TIER = f"""CASE WHEN trim(revision) = '' THEN NULL WHEN {_ORIGINAL} THEN 0 WHEN trim(lower(revision)) IN ('current', 'latest') THEN 3
  WHEN regexp_matches(revision, '[0-9]') THEN 2 WHEN regexp_matches(lower(revision), '\\b[a-z]\\b') THEN 1 END::BIGINT"""
REVISION_NUMBER = f"""CASE WHEN trim(revision) = '' THEN NULL WHEN {_ORIGINAL} THEN 0 WHEN trim(lower(revision)) IN ('current', 'latest') THEN 9999
  WHEN regexp_matches(revision, '[0-9]') THEN regexp_extract(revision, '([0-9]+)', 1)::BIGINT
  WHEN regexp_matches(lower(revision), '\\b[a-z]\\b') THEN ascii(regexp_extract(lower(revision), '\\b([a-z])\\b', 1)) - 96 END::BIGINT"""


@query(f"""WITH {MANIFESTS} SELECT doc_id, {PRECEDENCE} AS level, {REVISION_TIER} AS tier, {REVISION_NUMBER} AS number FROM manifests""")
def document_precedence(spark, sf_dir):
    m = manifests(spark, sf_dir)
    key = S.revision_key(F.col("revision"))
    return m.select("doc_id", O.precedence(m.document_type, m.document_class, m.revision).alias("level"), key["tier"].cast("long").alias("tier"), key["n"].alias("number"))


@query(f"""WITH {MANIFESTS} SELECT manufacturer, family, count(*) AS documents, count(*) FILTER (WHERE document_class = 'operational') AS operational,
  array_to_string(list_sort(list_distinct(flatten(list(models)))), ', ') AS models, min(publication_date) AS oldest, max(publication_date) AS newest
  FROM manifests GROUP BY manufacturer, family""")
def family_overview(spark, sf_dir):
    return (
        manifests(spark, sf_dir)
        .groupBy("manufacturer", "family")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.count(F.when(F.col("document_class") == "operational", 1)).alias("operational"),
            F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("models")))), ", ").alias("models"),
            F.min("publication_date").alias("oldest"),
            F.max("publication_date").alias("newest"),
        )
    )


@query(f"""WITH {MANIFESTS} SELECT manufacturer, string_agg(DISTINCT lower(family), ', ' ORDER BY lower(family)) AS families, count(DISTINCT family) AS n FROM manifests GROUP BY manufacturer""")
def manufacturer_index(spark, sf_dir):
    return manifests(spark, sf_dir).groupBy("manufacturer").agg(F.array_join(F.array_sort(F.collect_set(F.lower("family"))), ", ").alias("families"), F.count_distinct("family").alias("n"))


_PACK = "pack AS (SELECT doc_id, 'f' || doc_id || '.pdf' AS filename, CASE WHEN doc_id % 4 = 1 THEN 'conditional' ELSE 'required' END AS include FROM documents)"


def _pack(spark, sf_dir):
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(d, F.concat(F.lit("f"), d.cast("string"), F.lit(".pdf")).alias("filename"), F.when(d % 4 == 1, "conditional").otherwise("required").alias("include"))


@query(f"WITH {_PACK} SELECT doc_id, filename FROM pack WHERE include <> 'conditional'")
def pack_selected(spark, sf_dir):
    return packs.selected(_pack(spark, sf_dir)).select("doc_id", "filename")


@query(f"WITH {_PACK} SELECT doc_id, filename FROM pack WHERE include <> 'conditional' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def pack_missing(spark, sf_dir):
    files = table(spark, sf_dir, "labels").select(F.concat(F.lit("file:/packs/f"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"))
    return packs.missing_files(packs.selected(_pack(spark, sf_dir)), files).select("doc_id", "filename")
