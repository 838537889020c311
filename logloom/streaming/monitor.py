"""Counts of lines per micro-batch, from Spark's own progress: nothing is read a second time."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OBSERVED = "lines"


def counted(rows: DataFrame, time: str = "event_time") -> DataFrame:
    """The same rows; each micro-batch reports how many there were and how many lack a time."""
    return rows.observe(
        OBSERVED, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(time).isNull()).alias("undated"))


def line_counts(progress: dict) -> dict:
    """Batch number, rows, undated rows and late rows of one progress report (as JSON text reads).

    Late rows are those that stateful steps dropped behind the watermark, counted after
    partial aggregation: a whole number of (task, group) pairs for windowed counts.
    """
    lines = (progress.get("observedMetrics") or {}).get(OBSERVED) or {}
    return {
        "query": progress.get("name"),
        "batch": progress["batchId"],
        "rows": int(lines.get("rows") or 0),
        "undated": int(lines.get("undated") or 0),
        "late": sum(int(s.get("numRowsDroppedByWatermark") or 0) for s in progress.get("stateOperators") or []),
    }


def recent_counts(query: StreamingQuery) -> list[dict]:
    """The counts of a query's last micro-batches."""
    return [line_counts(json.loads(p.json)) for p in query.recentProgress]


class LineCounts(StreamingQueryListener):
    """Logs the counts of every micro-batch that had rows, as one JSON line."""

    def __init__(self, logger: logging.Logger | None = None) -> None:
        self.logger = logger or logging.getLogger(__name__)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = line_counts(json.loads(event.progress.json))
        if counts["rows"] or counts["late"]:
            self.logger.info(json.dumps(counts))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
