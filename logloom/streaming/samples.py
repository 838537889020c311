"""The first raw error rows of each window and key, kept in state until the window closes."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import nsmallest

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logloom.config import DEFAULT_WATERMARK, DEFAULT_WINDOW
from logloom.operators.rollups import watermarked
from logloom.plans.reports import SAMPLE_GROUP

KEYS = ("end_micros", *SAMPLE_GROUP[1:])
OUTPUT = "end_micros bigint, hostname string, level string, message_class string, at_micros bigint, message string"


def _place(row: tuple) -> tuple:
    """Order of the rows of a group: time, then text, null texts first."""
    at, message = row
    return at, message is not None, message or ""


class SampleKeeper(StatefulProcessor):
    """Holds the first k rows of one group, at most k in state, and emits them once."""

    def __init__(self, k: int) -> None:
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("kept", "at_micros bigint, message string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = [tuple(r) for r in self.kept.get()] if self.kept.exists() else []
        if not known:
            self.handle.registerTimer(-(-key[0] // 1000))
        both = (r for part in (known, ((r.at_micros, r.message) for r in rows)) for r in part)
        self.kept.put(nsmallest(self.k, both, key=_place))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for at, message in sorted((tuple(r) for r in self.kept.get()), key=_place):
            yield Row(end_micros=key[0], hostname=key[1], level=key[2], message_class=key[3], at_micros=at, message=message)
        self.kept.clear()

    def close(self) -> None:
        pass


def sample_stream(errors: DataFrame, k: int = 5, window: str = DEFAULT_WINDOW,
                  watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """The rows of ``reports.error_samples`` as the windows of a stream of error rows close."""
    rows = watermarked(errors, watermark).select(
        F.unix_micros(F.window("event_time", window)["end"]).alias("end_micros"), *SAMPLE_GROUP[1:],
        "event_time", F.unix_micros("event_time").alias("at_micros"), "message",
    )
    kept = rows.groupBy(*KEYS).transformWithState(SampleKeeper(k), OUTPUT, "append", "eventTime")
    return kept.select(
        F.timestamp_micros("end_micros").alias("window_end"), *SAMPLE_GROUP[1:],
        F.timestamp_micros("at_micros").alias("event_time"), "message",
    )
