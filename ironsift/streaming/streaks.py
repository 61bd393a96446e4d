"""Streaks of outcomes across batches, in the order of the rows and not of their arrival."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ROW = "ts long, seq long, status string"
OUT = "source string, seq long, status string, streak long, stopped boolean"


class StreakProcessor(StatefulProcessor):
    """Rows of a source wait until the watermark has passed them, and are then counted in the order of (ts, seq). The state is the
    rows that wait, and one number."""

    def __init__(self, hit: str, reset: str, threshold: int) -> None:
        self.hit, self.reset, self.threshold = hit, reset, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _ROW)
        self.streak = handle.getValueState("streak", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            times = frame["ts"].astype("datetime64[ms]").astype("int64")
            self.waiting.appendList(list(zip(times.tolist(), frame["seq"].tolist(), frame["status"].tolist(), strict=True)))
        yield from self._flush(key, timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._flush(key, timerValues)

    def close(self) -> None:
        pass

    def _flush(self, key: tuple, timers: TimerValues) -> Iterator[pd.DataFrame]:
        """Counts the rows up to the watermark; a timer stands for the first of the others."""
        mark = timers.getCurrentWatermarkInMs()
        rows = sorted(self.waiting.get(), key=lambda r: (r[0], r[1]))
        n_due = next((k for k, r in enumerate(rows) if r[0] > mark), len(rows))
        due, rest = rows[:n_due], rows[n_due:]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(rest[0][0])
        else:
            self.waiting.clear()
        if due:
            n, out = self.streak.get()[0] if self.streak.exists() else 0, []
            for _, seq, status in due:
                n = n + 1 if status == self.hit else 0 if status == self.reset else n
                streak = n if status == self.hit else 0
                out.append((key[0], seq, status, streak, streak >= self.threshold))
            self.streak.update((n,))
            yield pd.DataFrame(out, columns=["source", "seq", "status", "streak", "stopped"])


def streak_state(outcomes: DataFrame, hit: str, reset: str, threshold: int, delay: str = "1 hour") -> DataFrame:
    """source, seq, status, streak and stopped of a stream of outcomes (source, seq, status, ts), as `ranges.streaks` gives them for a table.

    Rows may come in any order and in any number of frames and batches, late by up to the delay; rows that are later still are dropped, and a
    row shows once the watermark has passed it. The session needs the RocksDB state store (ROCKS).
    """
    marked = outcomes.select("source", "seq", "status", "ts").withWatermark("ts", delay)
    return marked.groupBy("source").transformWithStateInPandas(StreakProcessor(hit, reset, threshold), OUT, "Append", "EventTime")
