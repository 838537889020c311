"""Metric points: the four measurements, their shapes and their upkeep."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import line_protocol
from logloom.functions.durations import interval
from logloom.functions.tags import clean_tag


@dataclass(frozen=True)
class Measurement:
    name: str
    tags: tuple[str, ...]
    fields: tuple[str, ...]

    @property
    def key(self) -> tuple[str, ...]:
        return ("time", *self.tags)


# Tags and fields of the metric tables. The client address is part of
# an anomaly's key, so two clients in one window stay two points.
HTTP_STATS = Measurement(
    "http_stats", ("env", "hostname", "method"),
    ("count", "rps", "avg_rt", "max_rt", "err_rate"),
)
TOP_URLS = Measurement("top_urls", ("env", "hostname", "status", "path"), ("count",))
ANOMALY = Measurement("anomaly", ("env", "hostname", "kind", "ip"),
                      ("count", "score", "window_s"))
ERROR_EVENTS = Measurement(
    "error_events", ("env", "hostname", "level", "message_class"), ("count",)
)
MEASUREMENTS = (HTTP_STATS, TOP_URLS, ANOMALY, ERROR_EVENTS)


def clean_tags(rows: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Clean text tags before aggregation, so equal tags count as one series."""
    return rows.withColumns({t: clean_tag(t, F.col(t)) for t in tags})


def to_points(metrics: DataFrame, m: Measurement, env: str = "dev",
              time: Column | None = None) -> DataFrame:
    """Wide points: time, tags, fields. The time is the window's end by default."""
    stamp = F.col("window_end") if time is None else time
    tags = [F.lit(env).alias("env") if t == "env" else F.col(t) for t in m.tags]
    return metrics.select(stamp.alias("time"), *tags, *m.fields)


def to_lines(points: DataFrame, m: Measurement) -> DataFrame:
    """Line-protocol text, built in the executors; points without a field go."""
    # The client address is key here but a field of the written point.
    tags = [t for t in m.tags if t != "ip"]
    fields = [t for t in m.tags if t == "ip"] + list(m.fields)
    schema = points.schema
    return points.where(line_protocol.has_line(schema, fields)).select(
        line_protocol.line(m.name, schema, tags, fields).alias("line")
    )


def to_long(points: DataFrame, m: Measurement) -> DataFrame:
    """One row per point and numeric field."""
    typed = points.select(*m.key, *[F.col(f).cast("double").alias(f) for f in m.fields])
    return (
        typed.unpivot(list(m.key), list(m.fields), "field", "value")
        .where(F.col("value").isNotNull())
    )


def to_series(points: DataFrame, m: Measurement) -> DataFrame:
    """Long form with one common schema, so measurements can be stacked."""
    return to_long(points, m).select(
        "time", F.lit(m.name).alias("measurement"),
        line_protocol.series_key(m.tags).alias("series"), "field", "value",
    )


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def to_wide(long: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Fields of one point side by side.

    One hash aggregate with a conditional per field; ``pivot`` would shuffle twice.
    """
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    )


def latest_wins(versions: DataFrame, keys: Sequence[str], fields: Sequence[str],
                version: str = "batch_id") -> DataFrame:
    """One row per point: per field, the newest written value.

    A field left null by a later write keeps its earlier value.
    """
    return versions.groupBy(*keys).agg(*[
        F.max_by(f, F.when(F.col(f).isNotNull(), F.col(version))).alias(f) for f in fields
    ])


def retain(points: DataFrame, now: Column, keep: str, time: str = "time") -> DataFrame:
    """Points no older than ``keep`` before ``now``; whole dates are pruned first."""
    floor = now - interval(keep)
    if "date" in points.columns:
        points = points.where(F.col("date") >= F.to_date(floor))
    return points.where(F.col(time) >= floor)
