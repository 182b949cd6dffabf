"""Manifests: validation, identity, deduplication, versions and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.functions import strings as S
from lodestack.functions import vocabulary as V
from lodestack.operators.ranking import placed


def rule_errors(rules: dict[str, Column]) -> Column:
    """The sorted names of the rules whose predicate isn't true."""
    return F.array_sort(F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])))


def manifest_errors(df: DataFrame) -> DataFrame:
    """df with ``errors``: what a manifest's own fields break."""
    known = sorted({v.lower() for v in V.DOCUMENT_TYPES + V.LEGACY_DOCUMENT_TYPES})
    return df.withColumn(
        "errors",
        rule_errors(
            {
                "checksum": F.lower(F.trim("checksum")).rlike("^[0-9a-f]{64}$"),
                "document_class": S.strip(S.fold(F.col("document_class"))).isin(*V.DOCUMENT_CLASSES),
                "document_type": S.strip(S.fold(F.col("document_type"))).isin(*known),
                "language": S.strip(F.col("language")).rlike("^[A-Za-z]{2}$"),
                "manufacturer": F.length(S.strip(F.col("manufacturer"))) > 0,
                "revision": F.length(S.strip(F.col("revision"))) > 0,
            }
        ),
    )


def document_key(df: DataFrame) -> Column:
    return F.concat_ws("-", *[S.slug(df[c]) for c in ("manufacturer", "family", "document_type", "revision")])


def first_by_checksum(df: DataFrame, order: str) -> DataFrame:
    """df with the first registration of the same checksum, and whether this is it. A window over copies sorts only ids."""
    firsts = df.groupBy("checksum").agg(F.min(order).alias("first_seen"), F.count(F.lit(1)).alias("copies"))
    return df.join(firsts, "checksum").withColumn("is_first", F.col(order) == F.col("first_seen"))


def versions(df: DataFrame, key: str, order: str) -> DataFrame:
    """Version number within a key, its label, and the latest one."""
    numbered = placed(df, [key], [order], "version", "versions")
    label = F.concat(F.col(key), F.lit("--v"), F.lpad(F.col("version").cast("string"), 3, "0"))
    return numbered.withColumns({"version_id": label, "is_latest": F.col("version") == F.col("versions")}).drop("versions")


def latest(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The value of the last row of each key, without sorting."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value), F.count(F.lit(1)).alias("changes"))


def buckets(df: DataFrame) -> DataFrame:
    """One row for each document, dimension and value: bucket_id, with documented fallbacks."""
    filled = lambda c, name: F.array(F.when(F.length(S.strip(F.coalesce(F.col(c), F.lit("")))) > 0, F.col(c)).otherwise(F.lit(name)))
    models = F.filter(F.col("models"), lambda m: F.length(S.strip(m)) > 0)
    values = {
        "manufacturer": filled("manufacturer", "unknown-manufacturer"),
        "product_family": filled("family", "unknown-family"),
        "model_applicability": F.when(F.size(models) > 0, models).otherwise(F.array(F.lit("unknown-model"))),
        "document_type": filled("document_type", "unknown-document-type"),
        "document_class": filled("document_class", "unknown-document-class"),
        "curated_bucket": F.when(F.col("curated").isNotNull(), F.array("curated")).otherwise(F.array().cast("array<string>")),
        "revision_authority": filled("revision", "unknown-revision"),
        "publication_date": F.array(F.coalesce(F.date_format("publication_date", "yyyy-MM-dd"), F.lit("undated"))),
    }
    entries = F.array(*[F.struct(F.lit(d).alias("dimension"), values[d].alias("values")) for d in V.BUCKET_DIMENSIONS])
    spread = df.withColumn("entry", F.explode(entries)).select("*", F.col("entry.dimension").alias("dimension"), F.explode("entry.values").alias("value"))
    scope = F.when(F.col("dimension") == "curated_bucket", F.col("value")).otherwise(F.col("family"))
    return spread.withColumn("bucket_id", F.concat_ws("/", S.slug(F.col("manufacturer")), S.slug(scope), S.slug(F.col("dimension"))))


def with_prior(assignments: DataFrame, prior: DataFrame, now: Column) -> DataFrame:
    """assignments with assigned_at: that of the same one (document, dimension, bucket and value) before, or else now."""
    keys = ["doc_id", "dimension", "bucket_id", "value"]
    before = prior.groupBy(*keys).agg(F.min("assigned_at").alias("assigned_at"))
    return assignments.join(before, keys, "left").withColumn("assigned_at", F.coalesce("assigned_at", now))


def precedence(document_type: Column, document_class: Column, revision: Column) -> Column:
    """Level of authority, 1 the highest."""
    return level(S.slug(document_type), S.fold(document_class), S.bare(revision))


def level(kind: Column, document_class: Column, revision: Column) -> Column:
    """``precedence`` of the type's slug, the folded class and the bare revision; each is named many times here."""
    out = F.when(document_class == "contextual", 8)
    for n, types in V.PRECEDENCE_LEVELS.items():
        hit = kind.isin(*types)
        if n == 2:
            out = out.when(hit & S.bare_is_original(revision), 3)
        if n == 5:
            hit = hit | (document_class == "operational")
        out = out.when(hit, n)
    return out.otherwise(8).cast("long")
