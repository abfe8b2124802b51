"""Live feed health (A14): a symbol goes DOWN when nothing arrives for it, by a timer.

``feed_status_stream`` keeps per symbol its message count, its newest message
time and its status in state, and registers a timer at newest + ``stale``. The timer
fires without any row of that symbol: on event time when the watermark passes it
(replays, driven by the other symbols' rows), on processing time by the wall clock.
One row per change: UP with a symbol's first message or its first after a
silence, DOWN ``stale`` after its newest message. The changes don't depend on
how the feed is cut into micro-batches: a silence inside one gives the same two rows.

Only message times travel to the workers, and a key holds distinct times only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from candela.operators.views import STALE_AFTER_SECONDS
from candela.session import ship_package

STATUS_SCHEMA = "symbol string, status string, at timestamp, message_count bigint, last_message_time timestamp"


class FeedStatusProcessor(StatefulProcessor):
    """State: (message count, newest message in micros, status)."""

    def __init__(self, stale_seconds: int, processing_time: bool):
        self.stale, self.processing_time = stale_seconds * 1_000_000, processing_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("feed", "messages bigint, last_us bigint, up boolean")

    def _rows(self, key, changes: list[tuple]) -> pd.DataFrame:
        """(status, at, messages, last) of each change."""
        def instants(i: int) -> pd.Series:
            return pd.to_datetime(pd.Series([c[i] for c in changes], dtype="int64"), unit="us", utc=True).dt.tz_localize(None)

        return pd.DataFrame({
            "symbol": pd.Series([key[0]] * len(changes), dtype=object), "status": [c[0] for c in changes], "at": instants(1),
            "message_count": pd.Series([c[2] for c in changes], dtype="int64"), "last_message_time": instants(3),
        })

    def _timer(self, last: int, now_ms: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        due = now_ms + self.stale // 1000 if self.processing_time else -((-last - self.stale) // 1000)
        self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for chunk in rows:
            new, many = np.unique(chunk["us"].to_numpy(np.int64), return_counts=True)
            times, at = np.unique(np.concatenate((times, new)), return_inverse=True)
            counts = np.bincount(at, np.concatenate((counts, many)), len(times)).astype(np.int64)
        messages, last, up = self.state.get() if self.state.exists() else (0, None, False)
        changes = []
        if last is not None:
            late = times <= last
            messages += int(counts[late].sum())
            times, counts = times[~late], counts[~late]
        totals = messages + np.cumsum(counts)
        previous = np.concatenate(([last if last is not None else 0], times[:-1])) if len(times) else times
        silent = np.flatnonzero(times - previous >= self.stale) if last is not None else np.flatnonzero(
            np.concatenate(([True], (times[1:] - previous[1:]) >= self.stale))) if len(times) else []
        for i in silent:
            before = int(totals[i - 1]) if i else messages
            if up:
                changes.append(("DOWN", int(previous[i]) + self.stale, before, int(previous[i])))
            changes.append(("UP", int(times[i]), int(totals[i]), int(times[i])))
            up = True
        if len(times):
            messages, last = int(totals[-1]), int(times[-1])
            if not up:  # the timer had fired, and the next message came less than ``stale`` after the one before
                changes.append(("UP", int(times[0]), int(totals[0]), int(times[0])))
                up = True
            now = timerValues.getCurrentProcessingTimeInMs() if self.processing_time else 0
            self._timer(last, now)
        self.state.update((messages, last, up))
        if changes:
            yield self._rows(key, changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        messages, last, up = self.state.get()
        if up:
            self.state.update((messages, last, False))
            yield self._rows(key, [("DOWN", last + self.stale, messages, last)])

    def close(self) -> None:
        pass


def feed_status_stream(trades: DataFrame, stale_seconds: int = STALE_AFTER_SECONDS, delay: str = "0 seconds",
                       time_col: str = "trade_time", processing_time: bool = False) -> DataFrame:
    """Status changes of each symbol of a stream with TIMESTAMP event times."""
    ship_package(trades.sparkSession)
    rows = trades.select("symbol", F.col(time_col).alias("time")).filter(F.col("time").isNotNull())
    rows = rows.withWatermark("time", delay).withColumn("us", F.unix_micros("time"))
    return rows.groupBy("symbol").transformWithStateInPandas(
        FeedStatusProcessor(stale_seconds, processing_time), STATUS_SCHEMA, "append", "ProcessingTime" if processing_time else "EventTime"
    )
