"""Assembling sales from parts that arrive in any order, as a stream with state and event-time timers.

A sale's head and its lines arrive on different days. What has arrived of a sale_id is its open assembly.
It closes as ``complete`` on the day on which it holds a head, a line and as many cents as are due; what
stays open too long is closed by the watermark, and a sentinel closes the rest at the end.

1. ``cut``: lines are made distinct and, with the heads, which know what is due, written in batches of days under
   ``spark.checkpoint.dir``. Each batch has a row without a sale_id, so that an empty one runs too; that of the
   last batch has an event time after all others.
2. ``assemble``: the batches move one by one into a folder that a streaming query reads. The query is started
   anew for each on the same checkpoint, and runs one micro-batch, whose watermark is the largest day of the
   batches before it. A start without any sale makes the state's first snapshot. The last start goes on, once its sentinel has moved the watermark beyond all days, with a
   micro-batch without data, in which the timers of all that is open fire.
3. ``parts``: within the stream a task sums its rows by sale_id and day, and sends a row for each group.
4. ``Assemblies``, a stateful processor on RocksDB: a ValueState holds the open assemblies of a group, one record
   for each sale_id. Records join them day by day. A timer is registered when an assembly opens, for the day on which
   it closes at the latest, and deleted when the last assembly with that day is complete. Timers fire after the data.

A group is a sale_id with ``sales_per_group`` = 1. A call of a Python processor, with a frame and its exchanges with
the state store, costs by estimate up to a millisecond, so the query makes groups of about SALES sale_ids by hash and steps
through a group's days with numpy. The state of a group is bounded by that; groups grow in number with the input.

Scale: a sale with very many lines is a record for each day in each task that reads some. Sums are made before each
shuffle; heads and sums meet by a join that splits hot keys. Nothing goes to the driver, to one task or into
a broadcast. The checkpoint makes a lost executor cost one micro-batch.

Defined cases: rows of a null sale_id are dropped, lines and heads. Heads without arrived_at arrive on the first
day. A null line_no is empty text in the hash. Amounts and totals that are null, not finite or beyond 2^53 cents
count as 0. Heads of one sale_id that arrive on one day are one head, with the largest due. Rows equal in the columns
of the contract are one row. Event times more than 40,000 days before or 60,000 after 1970 count as those. Empty tables
give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestack.llm import worker
from lodestack.llm.blocks import opened, pressed
from lodestack.session import keep_until_end, move, remove, scratch_dir

#: The first day of the first batch, and the days that all batches share.
FIRST_DAY, SPAN = 19723, 160
#: Days without completion after which an assembly closes.
PATIENCE = 20
#: sale_ids of a group, about.
SALES = 8192
_DAY_MS = 86_400_000
#: Event times are days since this many before 1970, so that none is negative.
_SHIFT, _LATEST = 40_000, 60_000
LINE = ("sale_id", "line_no", "item_id", "vendor_id", "quantity", "amount", "discount", "flag", "shipped_at")
FEED = "sale_id long, day int, head boolean, cents long, due long, group long, at timestamp"
PARTS = "group long, at timestamp, part binary"
CLOSED = "sale_id long, first_day int, last_day int, n_lines long, cents long, due long, status string"
HELD = np.dtype([("sale", "<i8"), ("first", "<i4"), ("last", "<i4"), ("lines", "<i8"), ("cents", "<i8"), ("due", "<i8"), ("head", "u1")])
#: Due, where no head has come.
_NO_DUE = np.iinfo(np.int64).min
#: Rows of the feed that a task sums up at once.
STEP = 1 << 20


def cents(amount: Column) -> Column:
    return F.when(F.abs(amount * 100) < 2.0**53, F.floor(amount * 100 + 0.5)).otherwise(F.lit(0).cast("long"))


def day_of(at: Column) -> Column:
    return F.unix_date(F.to_date(at))


def arrived_lines(lines: DataFrame) -> DataFrame:
    """sale_id, day, cents of the distinct lines."""
    distinct = lines.select(*LINE).where(F.col("sale_id").isNotNull()).distinct()
    key = F.crc32(F.concat_ws(":", F.col("sale_id").cast("string"), F.coalesce(F.col("line_no").cast("string"), F.lit(""))))
    day = F.coalesce(day_of(F.col("shipped_at")) + key % 4, FIRST_DAY + key % 152).cast("int")
    return distinct.select("sale_id", day.alias("day"), cents(F.col("amount")).alias("cents"))


def heads(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """sale_id, day and due of each sale, given the arrived lines. Only sums of which the last day is left out need the days."""
    kind = lambda c: F.crc32(F.col(c).cast("string")) % 5
    days = lines.groupBy("sale_id", F.when(kind("sale_id") == 1, F.col("day")).alias("day")).agg(F.sum("cents").alias("cents"))
    sums = days.groupBy(F.col("sale_id").alias("of_sale")).agg(F.sum("cents").alias("every"), F.max(F.struct("day", "cents")).alias("latest"))
    own = sales.where(F.col("sale_id").isNotNull()).select("sale_id", F.coalesce(day_of(F.col("arrived_at")), F.lit(FIRST_DAY)).alias("day"), cents(F.col("total")).alias("total"))
    due = F.when(kind("sale_id") == 0, F.col("total")).when(kind("sale_id") == 1, F.col("every") - F.col("latest.cents")).otherwise(F.col("every"))
    return own.join(sums, F.col("sale_id") == F.col("of_sale"), "left").select("sale_id", "day", F.coalesce(due, F.lit(0)).alias("due"))


def writers(spark: SparkSession) -> int:
    """Tasks that write files: an eighth of the shuffle partitions, since each writes one for every batch, but two for each core."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(partitions, max(partitions // 8, 2 * spark.sparkContext.defaultParallelism))


def cut(sales: DataFrame, lines: DataFrame, path: str, batches: int, sales_per_group: int) -> None:
    """Write the feed's batches under ``path``, as folders batch=0 to batch=``batches`` - 1, and batch=-1 with a sentinel alone."""
    spark = sales.sparkSession
    if sales_per_group == 1:
        group = F.col("sale_id")
    else:
        ids = max(sales.count(), lines.agg(F.approx_count_distinct("sale_id")).first()[0])
        groups = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-ids // sales_per_group))
        group = F.pmod(F.xxhash64("sale_id"), F.lit(groups))
    batch = F.least(F.greatest(F.floor((F.col("day").cast("long") - FIRST_DAY) * batches / SPAN), F.lit(0)), F.lit(batches - 1)).cast("int")
    at = F.least(F.greatest(F.col("day"), F.lit(-_SHIFT)), F.lit(_LATEST)).cast("long") + _SHIFT
    none = F.lit(None).cast("long")

    def add(rows: DataFrame, is_head: bool) -> None:
        cents, due = (F.lit(0).cast("long"), F.col("due")) if is_head else (F.col("cents"), none)
        fed = rows.select("sale_id", "day", F.lit(is_head).alias("head"), cents.alias("cents"), due.alias("due"), group.alias("group"), F.timestamp_seconds(at * 86_400).alias("at"), batch.alias("batch"))
        fed.coalesce(writers(spark)).write.mode("append").partitionBy("batch").parquet(f"{path}/cut")

    add(arrived_lines(lines), False)
    came = spark.read.schema("sale_id long, day int, head boolean, cents long").parquet(f"{path}/cut")
    add(heads(sales, came.where("NOT head")), True)
    last = F.when(F.col("id") == batches - 1, _LATEST + _SHIFT + 1).otherwise(0).cast("long")
    sentinels = spark.range(-1, batches, 1, 1).select(none.alias("sale_id"), none.cast("int").alias("day"), F.lit(False).alias("head"), none.alias("cents"), none.alias("due"), F.lit(-1).cast("long").alias("group"), F.timestamp_seconds(last * 86_400).alias("at"), F.col("id").cast("int").alias("batch"))
    sentinels.write.mode("append").partitionBy("batch").parquet(f"{path}/cut")


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the feed as a row for each group, with the group's records of a sale_id and day summed."""

    def of(table: pa.Table) -> pa.RecordBatch:
        real = table.filter(table.column("sale_id").is_valid())
        group = real.column("group").to_numpy()
        out = np.zeros(len(group), HELD)
        out["sale"], out["first"], out["cents"] = (real.column(c).to_numpy() for c in ("sale_id", "day", "cents"))
        out["last"], out["head"] = out["first"], real.column("head").to_numpy(zero_copy_only=False)
        out["lines"], out["due"] = out["head"] == 0, real.column("due").fill_null(_NO_DUE).to_numpy()
        order = np.argsort(group, kind="stable")
        ids, heads_ = np.unique(group[order], return_index=True)
        made = [stored(summed(x)) for x in (np.split(out[order], heads_[1:]) if len(ids) else ())]
        latest = table.column("at").cast(pa.int64())
        ends = np.maximum.reduceat(latest.filter(table.column("sale_id").is_valid()).to_numpy()[order], heads_) if len(ids) else np.zeros(0, np.int64)
        if len(real) < len(table):  # sentinels
            ids, made, ends = np.append(ids, -1), [*made, None], np.append(ends, max(latest.filter(table.column("sale_id").is_null()).to_pylist()))
        stamps = pa.array(ends.astype(np.int64)).cast(table.schema.field("at").type)
        return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), stamps, pa.array(made, pa.binary())], ["group", "at", "part"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= STEP:
            yield of(pa.Table.from_batches(held))
            held, rows = [], 0
    if rows:
        yield of(pa.Table.from_batches(held))


def _due_at(first_day: int) -> int:
    """When the timer of an assembly fires: as soon as the watermark has reached the day (timers fire before it passes them)."""
    return (min(max(first_day + PATIENCE, -_SHIFT), _LATEST) + _SHIFT) * _DAY_MS - 1


def _closings(rows: np.ndarray, status: np.ndarray | str) -> pd.DataFrame:
    due = pd.array(rows["due"], "Int64")
    due[rows["head"] == 0] = pd.NA
    return pd.DataFrame({"sale_id": rows["sale"], "first_day": rows["first"], "last_day": rows["last"], "n_lines": rows["lines"], "cents": rows["cents"], "due": due, "status": status})


def _unfinished(rows: np.ndarray) -> pd.DataFrame:
    late = np.where(rows["cents"] < rows["due"], "short", "over").astype(object)
    return _closings(rows, np.where(rows["head"] == 0, "headless", np.where(rows["lines"] == 0, "orphan", late)))


def summed(records: np.ndarray) -> np.ndarray:
    """Records of one sale_id and day as one, by day and sale_id."""
    if not len(records):
        return records
    records = records[np.lexsort((records["sale"], records["first"]))]
    fresh = np.ones(len(records), bool)
    fresh[1:] = (records["sale"][1:] != records["sale"][:-1]) | (records["first"][1:] != records["first"][:-1])
    at = np.flatnonzero(fresh)
    out = records[at]
    for name, add in (("lines", np.add), ("cents", np.add), ("head", np.maximum), ("due", np.maximum)):
        out[name] = add.reduceat(records[name], at)
    return out


def stored(records: np.ndarray) -> bytes:
    return pressed(tuple(records[c] for c in HELD.names))


def restored(raw: bytes) -> np.ndarray:
    (columns,) = opened(raw, tuple(HELD[c].type for c in HELD.names))
    out = np.zeros(len(columns[0]), HELD)
    for name, own in zip(HELD.names, columns, strict=True):
        out[name] = own
    return out


def advanced(held: np.ndarray, came: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(still open, complete) after records of some days have joined the open assemblies.

    Each sale_id's records join in the order of their days, all sale_ids' first ones together, then the second ones, and so
    on; so the work is that of the records, however many assemblies are open.
    """
    came = came[np.lexsort((came["first"], came["sale"]))]
    fresh = np.ones(len(came), bool)
    fresh[1:] = came["sale"][1:] != came["sale"][:-1]
    begin = np.flatnonzero(fresh)
    many = np.diff(np.append(begin, len(came)))
    now = np.zeros(len(begin), HELD)
    now["sale"], now["due"] = came["sale"][begin], _NO_DUE
    at = np.searchsorted(now["sale"], held["sale"])
    known = now["sale"][np.minimum(at, len(now) - 1)] == held["sale"]
    now[at[known]] = held[known]
    is_open = np.zeros(len(now), bool)
    is_open[at[known]] = True
    complete = []
    for k in range(int(many.max(initial=0))):
        own = np.flatnonzero(many > k)
        more, was = came[begin[own] + k], now[own]
        was["first"] = np.where(is_open[own], was["first"], more["first"])
        was["last"] = more["first"]
        was["lines"] += more["lines"]
        was["cents"] += more["cents"]
        was["due"] = np.maximum(was["due"], more["due"])
        was["head"] |= more["head"]
        done = (was["head"] > 0) & (was["lines"] > 0) & (was["cents"] == was["due"])
        complete.append(was[done])
        for name, value in (("lines", 0), ("cents", 0), ("due", _NO_DUE), ("head", 0)):
            was[name][done] = value
        now[own] = was
        is_open[own] = ~done
    left = np.concatenate([held[~known], now[is_open]])
    return left[np.argsort(left["sale"])], np.concatenate(complete)


class Assemblies(StatefulProcessor):
    """The open assemblies of a group in a ValueState, with a timer for each day on which some of them close."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "held binary")

    def _held(self) -> np.ndarray:
        found = self.state.get()
        return restored(found[0]) if found else np.zeros(0, HELD)

    def _hold(self, held: np.ndarray) -> None:
        if len(held):
            self.state.update((stored(held),))
        else:
            self.state.clear()

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        sent = [restored(x) for own in rows for x in own["part"] if x is not None]
        if not sent:
            return
        came = summed(np.concatenate(sent))
        held = self._held()
        before = set(held["first"].tolist())
        held, done = advanced(held, came)
        if len(done):
            yield _closings(done, "complete")
        self._hold(held)
        after = set(held["first"].tolist())
        for day in after - before:
            self.handle.registerTimer(_due_at(day))
        for day in before - after:
            self.handle.deleteTimer(_due_at(day))

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self._held()
        upto = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)  # at once for all timers that fire now
        due = {d: _due_at(d) <= upto for d in set(held["first"].tolist())}
        over = np.array([due[d] for d in held["first"].tolist()], bool)
        if over.any():
            self._hold(held[~over])
            yield _unfinished(held[over])

    def close(self) -> None:
        pass


def assemble(sales: DataFrame, lines: DataFrame, batches: int = 12, sales_per_group: int = SALES) -> DataFrame:
    """A row for each closing: sale_id, first_day, last_day, n_lines, cents, due, status, closing_batch."""
    spark = sales.sparkSession
    path = f"{scratch_dir(spark)}/sales-{uuid.uuid4().hex}"
    keep_until_end(spark, path)
    cut(sales, lines, path, batches, sales_per_group)
    own = spark.newSession()
    for name, value in {
        "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # a query has one micro-batch, and its stores' own folders would stay for a minute
    }.items():
        own.conf.set(name, value)
    for k in range(-1, batches):
        # The first start has no sale: the store's first version is a snapshot, which every later start has to fetch.
        # A micro-batch without data fires timers by the days of the batch before it: wanted for the last one's sentinel alone.
        own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(k == batches - 1).lower())
        move(spark, f"{path}/cut/batch={k}", f"{path}/feed/{k}")
        run(own, path, max(k, 0))
    for name in ("cut", "feed", "checkpoint"):
        remove(spark, f"{path}/{name}")
    return spark.read.schema(f"{CLOSED}, closing_batch int").parquet(f"{path}/closed")


def run(spark: SparkSession, path: str, batch: int) -> None:
    """Start the query on its checkpoint, and let it process what has come into the feed."""
    feed = spark.readStream.schema(FEED).option("recursiveFileLookup", "true").parquet(f"{path}/feed")
    sums = feed.mapInArrow(worker.task("sales")(parts), PARTS)
    closed = sums.withWatermark("at", "0 seconds").groupBy("group").transformWithStateInPandas(Assemblies(), CLOSED, "Append", "EventTime")
    stamped = closed.withColumn("closing_batch", F.lit(batch))
    if (files := writers(spark)) < int(spark.conf.get("spark.sql.shuffle.partitions")):
        stamped = stamped.repartition(files)
    stamped.writeStream.format("parquet").outputMode("append").option("path", f"{path}/closed").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
