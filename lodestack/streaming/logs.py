"""Inference logs and work queues as streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LOG_SCHEMA = "request_id string, ts timestamp, model string, run string, prompt_tokens long, completion_tokens long, _corrupt_record string"


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """JSON log entries as they arrive under a folder; malformed ones are skipped."""
    lines = spark.readStream.schema(LOG_SCHEMA).option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(path)
    return lines.where(F.col("_corrupt_record").isNull() & F.col("request_id").isNotNull()).drop("_corrupt_record")


def write_logs(entries: DataFrame, path: str) -> None:
    """Entries as JSON, in a folder for each UTC date."""
    entries.withColumn("log_date", F.to_date("ts")).write.mode("append").partitionBy("log_date").json(path)


def windowed_usage(log: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Requests and tokens by model and window; entries later than the watermark are dropped."""
    return (
        log.withWatermark("ts", late)
        .groupBy(F.window("ts", width), "model")
        .agg(F.count(F.lit(1)).alias("requests"), F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("tokens"))
        .select(F.col("window.start").alias("window_start"), "model", "requests", "tokens")
    )


def once_each(items: DataFrame, late: str = "1 hour") -> DataFrame:
    """Queue items without repeats of an item_id within the watermark."""
    return items.withWatermark("ts", late).dropDuplicatesWithinWatermark(["item_id"])


def drain(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process all that has arrived, batch by batch; a restart goes on after the last finished batch."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()


DISPATCH = "run string, item_id string, starts_at double"


def dispatched(stream: DataFrame, requests: int, budget: int, seconds: float = 60.0) -> DataFrame:
    """When each item of a run may start under rolling limits on requests and tokens, with pauses that all of a run's items share.

    Rows: run, item_id, at (seconds), tokens, pause. A row with a pause is a refusal: nothing of its run starts until that
    many seconds after it. State for each run: what was sent within the last ``seconds``, the clock and the pause's end.
    Items over the budget never start (null).
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clock, until, times, sizes = state.get if state.exists else (0.0, 0.0, [], [])
        sent = list(zip(times, sizes, strict=True))
        rows = pd.concat(list(batches)).sort_values(["at", "item_id"])
        out = []
        for row in rows.itertuples():
            if row.pause > 0:
                until = max(until, row.at + row.pause)
                continue
            if row.tokens > budget:
                out.append((key[0], row.item_id, None))
                continue
            clock = max(clock, float(row.at), until)
            while True:
                sent = [(t, n) for t, n in sent if clock - t < seconds]
                if len(sent) < requests and sum(n for _, n in sent) + row.tokens <= budget:
                    break
                clock = sent[0][0] + seconds
            sent.append((clock, int(row.tokens)))
            out.append((key[0], row.item_id, clock))
        state.update((clock, until, [t for t, _ in sent], [n for _, n in sent]))
        yield pd.DataFrame({"run": [r[0] for r in out], "item_id": [r[1] for r in out], "starts_at": pd.array([r[2] for r in out], "Float64")})

    held = "clock double, until double, times array<double>, sizes array<long>"
    return stream.groupBy("run").applyInPandasWithState(run, DISPATCH, held, "append", GroupStateTimeout.NoTimeout)


def unseen(files: DataFrame, known: DataFrame, late: str = "1 day") -> DataFrame:
    """Files (checksum, ts) of a stream whose checksum neither the known ones nor earlier files have."""
    fresh = files.join(known.select("checksum").distinct(), "checksum", "left_anti")
    return fresh.withWatermark("ts", late).dropDuplicatesWithinWatermark(["checksum"])


def keyed_sink(path: str, unit: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    """A sink for drain(): a batch's units replace earlier ones; the batch's number is the version, so it may be written again."""
    from lodestack.sources.store import write_units

    return lambda batch, number: write_units(batch, path, unit, number)
