"""The event machine over a stream, as stateful processing with timers.

Samples wait in a list state until the watermark has passed them, so that the machine
reads them in order however they came; a timer of the latest waiting one wakes it. What
the machine holds between (`events.OpenShot`) is a value state: a few samples of the
open pattern, the number of events, and where it stands. The list is bounded by the
lateness that is allowed, the value by the open pattern; neither grows with the shot.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.events import SCHEMA, OpenShot, Params

WAITING = "t double, smoothed double, at long"
HELD = "times array<double>, values array<double>, count long, anchored boolean, found int, heat double, done boolean, shot_start double, shot_end double, last_t double"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A sample this near the shot's end is its last.
NEAR_END = 1e-9


class EventMachine(StatefulProcessor):
    def __init__(self, params: Params, idle_ms: int):
        self.params, self.idle_ms = params, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting, self.held = handle.getListState("waiting", WAITING), handle.getValueState("held", HELD)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bounds, latest = None, None
        for part in rows:
            if len(part):
                at = part["ts"].astype("int64") // (1000 if part["ts"].dtype == "datetime64[us]" else 1_000_000)
                self.waiting.appendList([Row(float(t), float(x), int(ms)) for t, x, ms in zip(part["t"], part["smoothed"], at)])
                bounds = (float(part["shot_start"].iloc[0]), float(part["shot_end"].iloc[0]))
                latest = max(latest or 0, int(at.max()))
        if latest is not None:
            self.wake(latest)
            if not self.held.exists():
                self.held.update(([], [], 0, False, 0, 0.0, False, *bounds, float("-inf")))
        yield from ()

    def wake(self, at: int) -> None:
        """One timer a shot, at the latest sample that waits."""
        old = list(self.handle.listTimers())
        if old and max(old) >= at:
            return
        for ms in old:
            self.handle.deleteTimer(ms)
        self.handle.registerTimer(at)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(tuple(r) for r in self.waiting.get())
        ready, rest = [r for r in waiting if r[2] <= now], [r for r in waiting if r[2] > now]
        *machine, start, end, last_t = tuple(self.held.get())
        shot = OpenShot(start, end, self.params, tuple(machine))
        if ready:
            last_t = max(last_t, ready[-1][0])
        # Over once its last sample has been read, or when nothing more has come for `idle_ms`.
        over = last_t >= end - NEAR_END or not waiting
        out = shot.push([r[0] for r in ready], [r[1] for r in ready], over)
        self.waiting.clear()
        if over:
            self.held.clear()
        else:
            if rest:
                self.waiting.put([Row(*r) for r in rest])
            self.held.update((*shot.held, start, end, last_t))
            self.handle.registerTimer(max(r[2] for r in rest) if rest else int(now) + self.idle_ms)
        if out:
            yield pd.DataFrame([(key[0], *r) for r in out], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    def close(self) -> None:
        pass


def localize_stream(samples: DataFrame, params: Params | None = None, late: str = "10 minutes", idle_ms: int = 600_000) -> DataFrame:
    """The rows of `events.localize` from a stream of samples (shot_id, t, smoothed, shot_start, shot_end, ts), as they are decided.

    ts rises with t within a shot; samples may come up to `late` out of order, in any batches. A shot ends with the sample
    at its end, or when the watermark has gone `idle_ms` past its last. Samples that come after that are another shot of
    the id. Needs the RocksDB state store, which is set here where the session has another.
    """
    spark = samples.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    keyed = samples.withWatermark("ts", late).groupBy("shot_id")
    return keyed.transformWithStateInPandas(EventMachine(params or Params(), idle_ms), SCHEMA, "Append", "EventTime")
