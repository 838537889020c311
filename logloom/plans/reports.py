"""Reports: panel queries, checks and runbook queries over metric points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.config import DEFAULT_WINDOW
from logloom.operators import timeseries as ts
from logloom.operators.points import (
    ERROR_EVENTS,
    HTTP_STATS,
    Measurement,
    stack,
    to_long,
    to_series,
)
from logloom.operators.quantiles import exact_quantile, largest_group
from logloom.operators.rollups import rollup

SERIES = ("env", "hostname", "method")


def label(*parts: str, by: str = " | ") -> Column:
    """Tag values side by side; null if one is missing."""
    out = [F.col(parts[0]).cast("string")]
    for p in parts[1:]:
        out += [F.lit(by), F.col(p).cast("string")]
    return F.concat(*out)


def status_like(pattern: str) -> Column:
    return F.col("status").cast("string").rlike(pattern)


# HTTP statistics


def mean_error_rate(stats: DataFrame) -> DataFrame:
    """Unweighted mean of the window rates, per series."""
    return stats.groupBy(*SERIES).agg(F.avg("err_rate").alias("err_rate"))


def requests_by_host(stats: DataFrame) -> DataFrame:
    return ts.totals(stats, ["hostname"], "requests")


def requests_by_method(stats: DataFrame) -> DataFrame:
    return ts.totals(stats, ["method"], "requests")


def field_trend(stats: DataFrame, field: str, every: str = "5 minutes") -> DataFrame:
    """Bucket means of one field, per series."""
    return ts.downsample(stats, every, SERIES, F.avg(field).alias(field))


def latency_percentiles(stats: DataFrame, q: float = 0.95) -> DataFrame:
    """Exact percentile of the mean and maximum response times, per series."""
    long = to_long(stats, HTTP_STATS).where(F.col("field").isin("avg_rt", "max_rt"))
    # A series has one value of each field a point, so its points are counted, not unfolded.
    return exact_quantile(
        long, [*SERIES, "field"], "value", q, largest=largest_group(stats, SERIES)
    ).withColumnRenamed("field", "metric")


def slow_windows(stats: DataFrame, seconds: float = 0.2) -> DataFrame:
    return stats.where(F.col("avg_rt") > seconds).select("time", *SERIES, "avg_rt")


# Top URLs


def requests_by_status(urls: DataFrame) -> DataFrame:
    return ts.totals(urls, ["status"], "requests")


def top_hosts_by_errors(urls: DataFrame, k: int = 5) -> DataFrame:
    errors = ts.totals(urls.where(status_like("^[45]")), ["hostname"], "errors")
    return ts.top_k(errors, k, [F.desc("errors"), "hostname"])


def top_url_errors(urls: DataFrame, k: int = 10) -> DataFrame:
    sums = ts.totals(urls.where(status_like("^[45]")), ["status", "hostname", "path"], "errors")
    named = sums.select(label("status", "hostname", "path").alias("label"), "errors")
    return ts.top_k(named, k, [F.desc("errors"), "label"])


def top_pages(urls: DataFrame, k: int = 10) -> DataFrame:
    sums = ts.totals(urls, ["hostname", "path"], "requests")
    named = sums.select(label("hostname", "path").alias("label"), "requests")
    return ts.top_k(named, k, [F.desc("requests"), "label"])


def top_pages_by_status(urls: DataFrame, k: int = 10, errors_only: bool = False) -> DataFrame:
    rows = urls.where(status_like("^[45]")) if errors_only else urls
    keys = ["hostname", "path", "status"]
    return ts.top_k(ts.totals(rows, keys, "requests"), k, [F.desc("requests"), *keys])


def error_urls(urls: DataFrame) -> DataFrame:
    """Errors by host, path and status, largest first."""
    keys = ["hostname", "path", "status"]
    sums = ts.totals(urls.where(status_like("^[45]")), keys, "error_count")
    return sums.select(label("hostname", "path").alias("page"), "status", "error_count").orderBy(
        F.desc("error_count"), "page", "status"
    )


def error_status_distribution(urls: DataFrame) -> DataFrame:
    sums = ts.totals(urls.where(status_like("^[45]")), ["status"], "error_count")
    return ts.with_share(sums, "error_count")


def top_urls_per_window(urls: DataFrame, k: int = 3) -> DataFrame:
    """The k most asked paths of each window, host and status."""
    group = ["time", "hostname", "status"]
    return ts.first_k_per_group(urls, k, group, [F.desc("count"), "path"]).select(
        *group, "path", "count"
    )


# Anomalies


def score_trend(anomaly: DataFrame, host: str | None = None,
                every: str = "5 minutes") -> DataFrame:
    """Bucket means of the score per host and kind; one host, or all."""
    rows = anomaly.where(F.col("hostname") == host) if host else anomaly
    named = rows.withColumn("series", label("hostname", "kind"))
    return ts.downsample(named, every, ["series"], F.avg("score").alias("score"))


def max_score(anomaly: DataFrame) -> DataFrame:
    return anomaly.agg(F.max("score").alias("score"))


def max_score_by_host(anomaly: DataFrame) -> DataFrame:
    """Highest score per host and the first time it was reached."""
    first = F.min(F.struct((-F.col("score")).alias("down"), "time")).alias("m")
    best = anomaly.groupBy("hostname").agg(first)
    return best.select("hostname", F.col("m.time").alias("time"),
                       (-F.col("m.down")).alias("score"))


def high_scores(anomaly: DataFrame, above: float = 0.7) -> DataFrame:
    return anomaly.where(F.col("score") > above).select(
        "time", "env", "hostname", "kind", "ip", "score"
    )


def top_anomalous_clients(anomaly: DataFrame, kind: str = "scan", k: int = 10) -> DataFrame:
    """Clients with the highest score of one kind, and in how many windows they appear."""
    best = anomaly.where((F.col("kind") == kind) & (F.col("ip") != "")).groupBy("ip").agg(
        F.max("score").alias("score"), F.count(F.lit(1)).alias("windows")
    )
    return ts.top_k(best, k, [F.desc("score"), F.desc("windows"), "ip"])


# Error events


def error_trend(events: DataFrame, start: str, stop: str,
                every: str = "5 minutes") -> DataFrame:
    """Errors per bucket and series over the whole range, 0.0 where there are none."""
    filled = ts.zero_filled_sums(events, "count", ERROR_EVENTS.tags, every, start, stop)
    return filled.select(
        "time", "env", "level",
        label("hostname", "message_class", by=" / ").alias("series"), "value",
    )


def errors_by(events: DataFrame, by: Sequence[str]) -> DataFrame:
    return ts.totals(events, by, "total_errors")


def error_share_by_host(events: DataFrame) -> DataFrame:
    return ts.with_share(errors_by(events, ["hostname"]), "total_errors")


def error_summary(events: DataFrame) -> DataFrame:
    sums = errors_by(events, ["hostname", "message_class"])
    return sums.select(
        label("hostname", "message_class", by=" / ").alias("detail"),
        F.col("total_errors").alias("total"),
    ).orderBy(F.desc("total"), "detail")


DETAIL = ("hostname", "level", "message_class")


def last_errors(events: DataFrame, k: int = 5) -> DataFrame:
    named = events.select("time", label(*DETAIL).alias("detail"))
    return ts.top_k(named, k, [F.desc("time"), "detail"])


def last_errors_per_series(events: DataFrame, k: int = 5) -> DataFrame:
    rows = ts.first_k_per_group(events, k, ERROR_EVENTS.tags, [F.desc("time")])
    return rows.select("time", "env", label(*DETAIL).alias("detail"))


def latest_at_level(events: DataFrame, level: str = "error") -> DataFrame:
    rows = events.where(F.col("level") == level)
    return rows.select("time", *ERROR_EVENTS.tags, "count").orderBy(
        F.desc("time"), "hostname", "message_class"
    )


# Checks over all measurements


def all_series(tables: Sequence[tuple[Measurement, DataFrame]]) -> DataFrame:
    return stack([to_series(t, m) for m, t in tables])


SERIES_ORDER = ("measurement", "series", "field")


def latest_points(series: DataFrame, k: int = 10) -> DataFrame:
    return ts.top_k(series, k, [F.desc("time"), *SERIES_ORDER])


def samples(series: DataFrame, k: int = 5) -> DataFrame:
    """The first k points of every series."""
    return ts.first_k_per_group(series, k, SERIES_ORDER, ["time"])


def record_counts(tables: Sequence[tuple[Measurement, DataFrame]]) -> DataFrame:
    """Stored values per measurement, counted without unfolding the fields."""
    counts = []
    for m, t in tables:
        stored = [F.count(f) for f in m.fields]
        total = stored[0]
        for more in stored[1:]:
            total = total + more
        counts.append(t.agg(total.alias("records")).select(
            F.lit(m.name).alias("measurement"), "records"
        ))
    return stack(counts).where(F.col("records") > 0)


def series_counts(series: DataFrame) -> DataFrame:
    """Stored values of every series."""
    return series.groupBy(*SERIES_ORDER).agg(F.count("value").alias("records"))


# Reports on raw rows


def latency_percentile_per_window(access: DataFrame, every: str = "5 minutes",
                                  q: float = 0.95) -> DataFrame:
    """Exact response-time percentile per host and window."""
    spans = access.select(F.window("event_time", every)["end"].alias("time"), "hostname", "rt")
    return exact_quantile(spans, ["time", "hostname"], "rt", q).withColumnRenamed(
        "quantile", "rt"
    )


def top_clients(access: DataFrame, k: int = 10, low: int = 400, high: int = 499) -> DataFrame:
    """Clients with the most answers in a status range, and the paths they asked for."""
    hits = access.where(F.col("status").between(low, high))
    per_path = hits.groupBy("remote", "path").agg(F.count(F.lit(1)).alias("n"))
    clients = per_path.groupBy("remote").agg(
        F.sum("n").alias("requests"), F.count("path").alias("paths")
    )
    return ts.top_k(clients, k, [F.desc("requests"), "remote"])


def errors_by_upstream(split: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    keys = ["host", "level", "upstream"]
    counts = rollup(split, window, keys, [F.count(F.lit(1)).alias("count")])
    return counts.select("window_end", F.col("host").alias("hostname"), "level", "upstream",
                         "count")


def top_upstreams(split: DataFrame, k: int = 10) -> DataFrame:
    counts = split.groupBy("upstream").agg(F.count(F.lit(1)).alias("errors"))
    return ts.top_k(counts, k, [F.desc("errors"), "upstream"])


SAMPLE_GROUP = ("window_end", "hostname", "level", "message_class")


def error_samples(errors: DataFrame, k: int = 5, window: str = DEFAULT_WINDOW) -> DataFrame:
    """A few raw rows of each window, host, level and class."""
    spans = errors.withColumn("window_end", F.window("event_time", window)["end"])
    rows = ts.first_k_per_group(spans, k, SAMPLE_GROUP, ["event_time", "message"])
    return rows.select(*SAMPLE_GROUP, "event_time", "message")


def errors_by_level(errors: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    counts = rollup(errors, window, ["level"], [F.count(F.lit(1)).alias("count")])
    return counts.select("window_end", "level", "count")
