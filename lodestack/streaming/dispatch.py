"""Dispatching under rolling limits as a stream: items wait in state, and timers let them go."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STARTED = "run string, item_id string, starts_at double"
#: A waiting row: an item, or with a pause a refusal.
WAITING = "item_id string, at double, tokens long, pause double"


def earliest(clock: float, sent: list[tuple[float, int]], tokens: int, requests: int, budget: int, seconds: float) -> float:
    """When something of so many tokens fits, from ``clock`` on, given what was sent (in order of time)."""
    while True:
        live = [(t, n) for t, n in sent if clock - t < seconds]
        if len(live) < requests and sum(n for _, n in live) + tokens <= budget:
            return clock
        clock = live[0][0] + seconds


class Dispatcher(StatefulProcessor):
    """One run's queue: what waits, what was sent within the last ``seconds``, the time of the last start and the end of the pause.

    Something starts only when the watermark has reached its time, so every refusal up to then is known, whatever batches
    the rows came in. Until then a timer stands for the first in the queue.
    """

    def __init__(self, requests: int, budget: int, seconds: float) -> None:
        self.requests, self.budget, self.seconds = requests, budget, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.sent = handle.getListState("sent", "at double, tokens long")
        self.clock = handle.getValueState("clock", "clock double, until double, timer long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        came = pd.concat(list(rows))
        self.waiting.appendList([(r.item_id, float(r.at), int(r.tokens), float(r.pause)) for r in came.itertuples()])
        yield from self._released(key[0], timerValues.getCurrentWatermarkInMs() / 1000)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._released(key[0], timerValues.getCurrentWatermarkInMs() / 1000)

    def _released(self, run: str, now: float) -> Iterator[pd.DataFrame]:
        clock, until, timer = self.clock.get() or (0.0, 0.0, -1)
        queue = sorted((r[1], r[3] <= 0, r[0] or "", r[2], r[3]) for r in self.waiting.get())
        items = [r for r in queue if r[1]]
        refusals = [r for r in queue if not r[1]]
        sent = sorted(tuple(x) for x in self.sent.get())
        out, then = [], None
        while items:
            at, _, item, tokens, _ = items[0]
            if tokens > self.budget:
                start = at  # never starts, which is told when its time has come
            else:
                start = earliest(max(clock, at, until), sent, tokens, self.requests, self.budget, self.seconds)
                while refusals and refusals[0][0] <= start:
                    until = max(until, refusals[0][0] + refusals[0][4])
                    refusals.pop(0)
                    start = earliest(max(clock, at, until), sent, tokens, self.requests, self.budget, self.seconds)
            if start > now:
                then = start
                break
            items.pop(0)
            if tokens > self.budget:
                out.append((run, item, None))
                continue
            clock = start
            sent = [(t, n) for t, n in sent if clock - t < self.seconds] + [(start, tokens)]
            out.append((run, item, start))
        self._keep(clock, until, timer, then, items, refusals, sent)
        if out:
            yield pd.DataFrame({"run": [r[0] for r in out], "item_id": [r[1] for r in out], "starts_at": pd.array([r[2] for r in out], "Float64")})

    def _keep(self, clock: float, until: float, timer: int, then: float | None, items: list, refusals: list, sent: list) -> None:
        wanted = -1 if then is None else math.ceil(then * 1000)
        if timer not in (-1, wanted):
            self.handle.deleteTimer(timer)
        if wanted != -1:
            self.handle.registerTimer(wanted)
        self.clock.update((clock, until, wanted))
        left = [(item, at, tokens, pause) for at, _, item, tokens, pause in [*refusals, *items]]
        for state, rows in ((self.waiting, left), (self.sent, sent)):
            if rows:
                state.put(rows)
            else:
                state.clear()

    def close(self) -> None:
        pass


def dispatched(stream: DataFrame, requests: int, budget: int, seconds: float = 60.0, late: str = "0 seconds") -> DataFrame:
    """run, item_id and starts_at (seconds since 1970) of a stream's items, told once the watermark has reached that time.

    Rows: run, item_id, ts, tokens, pause (seconds; more than 0: a refusal at ts, after which nothing of the run starts for so
    long). Items start in order of ts and item_id, under rolling limits on requests and tokens. Items over the budget
    never start (null). State is on RocksDB, so a restart goes on where it was, in a pause as well; times are exact to
    a millisecond. Needs ``use_rocksdb``.
    """
    rows = stream.select("run", "item_id", "ts", (F.unix_millis("ts") / 1000).alias("at"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), F.coalesce("pause", F.lit(0)).cast("double").alias("pause"))
    return rows.withWatermark("ts", late).groupBy("run").transformWithStateInPandas(Dispatcher(requests, budget, seconds), STARTED, "Append", "EventTime")
