"""Windowed metrics: one row per tumbling window and key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.config import DEFAULT_WATERMARK, DEFAULT_WINDOW
from logloom.functions.access import is_error
from logloom.functions.durations import seconds_in


def watermarked(rows: DataFrame, watermark: str, time: str = "event_time") -> DataFrame:
    """Streams get a watermark; a batch passes unchanged, so operators serve both."""
    return rows.withWatermark(time, watermark) if rows.isStreaming else rows


def rollup(rows: DataFrame, window: str, keys: Sequence[Column | str],
           aggregates: Sequence[Column], watermark: str = DEFAULT_WATERMARK,
           time: str = "event_time") -> DataFrame:
    """Aggregates per window and key, labelled by the window's end.

    Rows of a hot key meet in the map-side partial aggregate, so the shuffle carries
    one row per key, window and task, whatever the key's share of the input.
    """
    span = F.window(time, window).alias("span")
    out = watermarked(rows, watermark, time).groupBy(span, *keys).agg(*aggregates)
    return out.withColumn("window_end", F.col("span.end")).drop("span")


def http_stats(access: DataFrame, window: str = DEFAULT_WINDOW,
               watermark: str = DEFAULT_WATERMARK,
               by: Sequence[str] = ("hostname", "method")) -> DataFrame:
    """Request count, rate, response times and 4xx/5xx share."""
    totals = rollup(
        access, window, by,
        [
            F.count(F.lit(1)).alias("count"),
            F.avg("rt").alias("avg_rt"),
            F.max("rt").alias("max_rt"),
            F.count_if(is_error(F.col("status"))).alias("err_count"),
        ],
        watermark,
    )
    return totals.select(
        "window_end", *by, "count",
        (F.col("count") / seconds_in(window)).alias("rps"),
        "avg_rt", "max_rt", "err_count",
        F.coalesce(F.try_divide("err_count", "count"), F.lit(0.0)).alias("err_rate"),
    )


def top_urls(access: DataFrame, window: str = DEFAULT_WINDOW,
             watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Requests per host, status and path."""
    keys = ("hostname", "status", "path")
    counts = rollup(access, window, keys, [F.count(F.lit(1)).alias("count")], watermark)
    return counts.select("window_end", *keys, "count")


def error_events(errors: DataFrame, window: str = DEFAULT_WINDOW,
                 watermark: str = DEFAULT_WATERMARK,
                 by: Sequence[str] = ("hostname", "level", "message_class")) -> DataFrame:
    """Error lines per key."""
    counts = rollup(errors, window, by, [F.count(F.lit(1)).alias("count")], watermark)
    return counts.select("window_end", *by, "count")
