"""Stores that are written unit by unit: sections of a document, records of a section, review flags, states of items.

A store is a folder of versions, each in buckets by a hash of the unit. A version holds all rows of the units it writes; a
unit's rows are those of its last version. An index, in the same buckets, has a row for each unit of each version and
says whether the unit has any rows left; it is written after the rows, so a version counts when it is whole.
So the last versions are found without reading rows, and one unit's rows by opening one bucket. Writing a version
twice leaves the same files, so a repeated run is harmless, and nothing that others read is rewritten in place.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Units of the stores: what one write replaces as a whole.
SECTIONS = ("doc_id",)
RECORDS = ("doc_id", "section_id", "record_type")
REVIEWS = ("doc_id", "section_id", "record_type")
ITEMS = ("run_id", "item_id")
#: Buckets of a version, and the folder of the index.
BUCKETS, INDEX = 64, "_index"
# The artifacts that a parser leaves for a document.
ARTIFACTS = ("content", "structure", "headings", "tables", "page_map", "quality", "meta")


def _bucket(unit: tuple[str, ...]) -> Column:
    return F.pmod(F.hash(*[F.col(c).cast("string") for c in unit]), F.lit(BUCKETS)).alias("bucket")


def write_units(rows: DataFrame, path: str, unit: tuple[str, ...], version: int, units: DataFrame | None = None) -> None:
    """All rows of the units that they are in; ``units`` lists further ones, whose rows are all gone now."""
    rows.withColumn("bucket", _bucket(unit)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={version}")
    listed = rows.select(*unit, F.lit(True).alias("held"))
    if units is not None:
        listed = listed.unionByName(units.select(*unit, F.lit(False).alias("held")))
    index = listed.groupBy(*unit).agg(F.max("held").alias("held"))
    index.withColumn("bucket", _bucket(unit)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{INDEX}/version={version}")


def _rows(spark: SparkSession, path: str, schema: str | None) -> DataFrame:
    """All versions; with a schema (the rows' own columns) no file is opened to find it out."""
    read = spark.read.option("basePath", path)
    return read.schema(f"{schema}, bucket int, version long").parquet(path) if schema else read.option("mergeSchema", "true").parquet(path)


def last_versions(spark: SparkSession, path: str, unit: tuple[str, ...], upto: int | None = None) -> DataFrame:
    """Each unit's last version, or its last one up to a given version, if it has rows left: unit, bucket and version."""
    index = spark.read.parquet(f"{path}/{INDEX}")
    if upto is not None:
        index = index.where(F.col("version") <= upto)
    last = index.groupBy("bucket", *unit).agg(F.max_by("held", "version").alias("held"), F.max("version").alias("version"))
    return last.where("held").drop("held")


def read_units(spark: SparkSession, path: str, unit: tuple[str, ...], upto: int | None = None, schema: str | None = None) -> DataFrame:
    """The rows of each unit's last version, or of the last one up to a given version."""
    last = last_versions(spark, path, unit, upto)
    return _rows(spark, path, schema).join(last, [*unit, "bucket", "version"], "left_semi").drop("bucket", "version")


def read_unit(spark: SparkSession, path: str, unit: dict[str, object], schema: str | None = None) -> DataFrame:
    """The rows of one unit's last version. Of the index and of that version one bucket is opened."""
    names = tuple(unit)
    own = reduce(lambda a, b: a & b, [F.col(c) == v for c, v in unit.items()])
    bucket = spark.range(1).select(*[F.lit(v).alias(c) for c, v in unit.items()]).select(_bucket(names)).first()[0]
    last = spark.read.parquet(f"{path}/{INDEX}").where(own & (F.col("bucket") == bucket)).agg(F.max(F.struct("version", "held")).alias("last")).first()["last"]
    version = last["version"] if last and last["held"] else -1
    return _rows(spark, path, schema).where((F.col("version") == version) & (F.col("bucket") == bucket) & own).drop("bucket", "version")


def compact(spark: SparkSession, path: str, unit: tuple[str, ...], into: str) -> None:
    """The last versions alone, as version 0 of a new store."""
    write_units(read_units(spark, path, unit), into, unit, 0)


def latest_states(events: DataFrame, key: tuple[str, ...] = ITEMS, order: str = "at") -> DataFrame:
    """The last event of each key: a run's checkpoint, read from an appended log of events."""
    last = F.max(F.struct(order, *[c for c in events.columns if c not in (*key, order)])).alias("last")
    return events.groupBy(*key).agg(last).select(*key, "last.*")


def write_artifact(df: DataFrame, path: str, name: str) -> None:
    """One artifact of documents, as JSON lines in a folder for each document."""
    if name not in ARTIFACTS:
        raise ValueError(f"no such artifact: {name}")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc_id").json(f"{path}/{name}")


def read_artifact(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """An artifact of all documents; an error that names it if it isn't there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        raise FileNotFoundError(f"artifact {name} is missing under {path}")
    return spark.read.schema(f"doc_id string, {schema}").json(f"{path}/{name}")


def read_artifacts(spark: SparkSession, path: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """Several artifacts of all documents; an error that names the first that is missing, in the order of ARTIFACTS, before any is read."""
    return {name: read_artifact(spark, path, name, schemas[name]) for name in sorted(schemas, key=ARTIFACTS.index)}


def yaml_texts(rows: DataFrame, key: str, left_out: tuple[str, ...] = ()) -> DataFrame:
    """key and text: each row as a YAML mapping in the order of its columns, without computed ones and nulls."""
    kept = [c for c in rows.columns if c not in left_out]

    def dump(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for batch in batches:
            own = [json.loads(x) for x in batch["own"]]
            yield pd.DataFrame({key: batch[key], "text": [yaml.safe_dump(x, sort_keys=False, allow_unicode=True) for x in own]})

    packed = rows.select(F.col(key).cast("string").alias(key), F.to_json(F.struct(*kept)).alias("own"))
    return packed.mapInPandas(dump, f"{key} string, text string")


def write_texts(texts: DataFrame, path: str, key: str) -> None:
    """One text file for each key, in a folder of its own; folders of other keys stay."""
    texts.select(key, "text").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", "\n").partitionBy(key).text(path)


def page_texts(pages: DataFrame, fields: list[str]) -> DataFrame:
    """path and text of pages (path, the fields of the head, body): a YAML head between lines of dashes, then the body."""
    heads = yaml_texts(pages.select("path", *fields), "path", ("path",)).withColumnRenamed("text", "head")
    return heads.join(pages.select("path", "body"), "path").select("path", F.concat(F.lit("---\n"), "head", F.lit("---\n"), "body").alias("text"))


def publish_manifest(staged: DataFrame, version: str) -> DataFrame:
    """One JSON row that lists the staged files (path, digest) in order of path."""
    files = F.array_sort(F.collect_list(F.struct("path", "digest")))
    return staged.agg(F.to_json(F.struct(F.lit(version).alias("version"), F.count(F.lit(1)).alias("count"), files.alias("files"))).alias("value"))


def publish(staged: DataFrame, sources: DataFrame, path: str, version: str) -> None:
    """The files' list as manifest and as log entry, and one snapshot of each source document, the first one given.

    staged: path, digest. sources: doc_id, ordinal and what is known of the document. Manifests of one version are
    written over, so a repeated run leaves the same.
    """
    manifest = publish_manifest(staged, version)
    manifest.write.mode("overwrite").text(f"{path}/manifest")
    manifest.write.mode("overwrite").text(f"{path}/log/version={version}")
    first = sources.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("ordinal"))).where("n = 1").drop("n", "ordinal")
    first.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc_id").json(f"{path}/_sources")


def checksum_index(manifests: DataFrame) -> DataFrame:
    """checksum, doc_id and number of copies of manifests (checksum, doc_id, path); of equal checksums the last path counts."""
    return manifests.groupBy("checksum").agg(F.max_by("doc_id", "path").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


def save_checksum_index(index: DataFrame, path: str) -> None:
    """The index in order of checksums, one JSON line each."""
    index.select("checksum", "doc_id").sort("checksum").write.mode("overwrite").json(path)


def load_checksum_index(spark: SparkSession, path: str) -> DataFrame:
    """A saved index; empty if there is none yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "checksum string, doc_id string")
    return spark.read.schema("checksum string, doc_id string").json(path)
