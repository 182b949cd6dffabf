"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
#: Bytes of a batch of rows that a Python worker gets, about, after ``small_batches``.
BATCH_BYTES = 4 << 20
_OWN: list[str] = []
_WRITTEN: set[str] = set()


def get_session(app: str = "lodestack", cpus: str | int = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the plans are tuned for (UTC, AQE, Arrow)."""
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    spark = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return share_code(spark)


def share_code(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where they see the same file system.

    On a cluster, install the package or pass it with --py-files.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def small_batches(spark: SparkSession) -> None:
    """Keep the batches that Python workers get small in bytes, where the session sets no limit: JVM and worker hold each several times over."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, BATCH_BYTES)


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset and everything runs in one process on one machine, a folder of this
    process is made and set. On a cluster the setting is required.
    """
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="lodestack-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


def unused(df: DataFrame, stem: str) -> str:
    """A column name that begins with ``stem`` and that no column of ``df`` begins with."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(stem) for c in taken):
        stem = f"{stem}_"
    return stem


def keep_until_end(spark: SparkSession, path: str) -> None:
    """Have ``path`` deleted when the application ends, if it isn't before."""
    if not _WRITTEN:
        atexit.register(_sweep, spark)
    _WRITTEN.add(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: what follows survives the loss of executors without recomputing
    what came before, and several readers share one computation.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    keep_until_end(spark, path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


@contextmanager
def bucketed(df: DataFrame, key: str, name: str, by: str | None = None) -> Iterator[DataFrame]:
    """``df`` written in the shared folder in buckets by ``key``, so that joins and groups by it needn't shuffle it; deleted at the end. ``by`` splits it into folders."""
    spark = df.sparkSession
    own = f"{name}_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark)}/{own}"
    keep_until_end(spark, path)
    writer = df.write.partitionBy(by) if by else df.write
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(own)
    out = spark.table(own)
    out.scratch_path = path
    try:
        yield out
    finally:
        spark.sql(f"DROP TABLE {own}")
        _delete(spark, path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While this holds, what a query has shuffled is deleted as soon as its result is written, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _delete(spark: SparkSession, path: str) -> None:
    remove(spark, path)
    _WRITTEN.discard(path)


def _place(spark: SparkSession, path: str) -> tuple[object, object]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    store, where = _place(spark, path)
    store.delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the one above its new place is made if it is missing."""
    store, where = _place(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    store.mkdirs(target.getParent())
    if not store.rename(where, target):
        raise OSError(f"{path} can't be moved to {to}")


def _sweep(spark: SparkSession) -> None:
    """At the end of the application: what is left of written tables goes, unless the session has ended before."""
    for path in list(_WRITTEN):
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone
            return


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these frames. Whatever is still to be read from them must be written by then."""
    for df in frames:
        _delete(df.sparkSession, df.scratch_path)
