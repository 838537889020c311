"""Anomaly detection: request spikes, path scans and server-error surges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.config import DEFAULT_WATERMARK, DEFAULT_WINDOW, Thresholds
from logloom.functions.access import is_server_error
from logloom.functions.durations import seconds_in
from logloom.operators.rollups import rollup, watermarked

COLUMNS = ("window_end", "hostname", "ip", "kind", "count", "score")


def _requests() -> Column:
    return F.count(F.lit(1)).alias("requests")


def _failures() -> Column:
    return F.count_if(is_server_error(F.col("status"))).alias("failures")


def ip_spikes(access: DataFrame, threshold: int = 50, window: str = DEFAULT_WINDOW,
              watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Clients with at least ``threshold`` requests to a host in a window."""
    keys = ["hostname", F.col("remote").alias("ip")]
    return (
        rollup(access, window, keys, [F.count(F.lit(1)).alias("count")], watermark)
        .where(F.col("count") >= threshold)
        .withColumns({"kind": F.lit("ip_spike"), "score": F.col("count") / threshold})
        .select(*COLUMNS)
    )


def error_surges(access: DataFrame, threshold: float = 0.1, window: str = DEFAULT_WINDOW,
                 watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Hosts whose share of 5xx answers in a window reaches ``threshold``."""
    return (
        rollup(access, window, ["hostname"], [_requests(), _failures()], watermark)
        .withColumn("score", F.try_divide("failures", "requests"))
        .where(F.col("score") >= threshold)
        .withColumns({"ip": F.lit(""), "kind": F.lit("error_surge"), "count": F.col("requests")})
        .select(*COLUMNS)
    )


def path_scans(access: DataFrame, threshold: int = 20, window: str = DEFAULT_WINDOW,
               watermark: str = DEFAULT_WATERMARK, rsd: float | None = None) -> DataFrame:
    """Clients that ask a host for at least ``threshold`` different paths in a window.

    Exact by default, in a batch as in a stream: rows first reduce to one per path, so a client
    with very many paths spreads over tasks. ``rsd`` asks for a sketch with that error.
    """
    if rsd is None:
        counts = _path_counts(watermarked(access, watermark), window)
    else:
        keys = ["hostname", F.col("remote").alias("ip")]
        distinct = F.approx_count_distinct("path", rsd).alias("count")
        counts = rollup(access, window, keys, [distinct], watermark)
    return (
        counts.where(F.col("count") >= threshold)
        .withColumns({"kind": F.lit("scan"), "score": F.col("count") / threshold})
        .select(*COLUMNS)
    )


def _two_levels(rows: DataFrame, aggregates: list[Column]) -> DataFrame:
    """The same aggregates per (window, host, client) and per (window, host)."""
    sets = [["span", "hostname", "ip"], ["span", "hostname"]]
    return rows.groupingSets(sets, "span", "hostname", "ip").agg(
        *aggregates, (F.grouping_id() == 0).alias("per_client")
    )


def _by_sketch(rows: DataFrame, window: str, rsd: float) -> DataFrame:
    spans = rows.select(
        F.window("event_time", window).alias("span"), "hostname",
        F.col("remote").alias("ip"), "path", "status",
    )
    paths = F.approx_count_distinct("path", rsd).alias("paths")
    return _two_levels(spans, [_requests(), _failures(), paths])


def _path_counts(rows: DataFrame, window: str) -> DataFrame:
    """Exact number of different paths per window, host and client.

    In a stream the first row of each path passes a deduplication whose state the watermark
    clears with its window; the count behind it then works in any output mode.
    """
    seen = rows.where(F.col("path").isNotNull()).select(
        F.window("event_time", window).alias("span"), "hostname", F.col("remote").alias("ip"), "path"
    ).dropDuplicates(["span", "hostname", "ip", "path"])
    counts = seen.groupBy("span", "hostname", "ip").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("window_end", F.col("span.end")).drop("span")


def _by_path(rows: DataFrame, window: str) -> DataFrame:
    """Exact path counts without per-client sets: reduce to paths, then to clients."""
    span = F.window("event_time", window).alias("span")
    per_path = rows.groupBy(span, "hostname", F.col("remote").alias("ip"), "path").agg(
        _requests(), _failures()
    )
    return _two_levels(per_path, [
        F.sum("requests").alias("requests"),
        F.sum("failures").alias("failures"),
        F.count("path").alias("paths"),
    ])


def _requests_only(rows: DataFrame, window: str) -> DataFrame:
    spans = rows.select(
        F.window("event_time", window).alias("span"), "hostname", F.col("remote").alias("ip"), "status")
    return _two_levels(spans, [_requests(), _failures(), F.lit(None).cast("bigint").alias("paths")])


def anomalies(access: DataFrame, thresholds: Thresholds = Thresholds(),
              window: str = DEFAULT_WINDOW, watermark: str = DEFAULT_WATERMARK,
              rsd: float | None = None) -> DataFrame:
    """All three kinds from one pass over the input.

    Client and host totals come from one scan by grouping sets, and each total emits
    the verdicts it supports, instead of three scans and aggregates in a union.
    ``rsd`` counts paths by sketch; without it they are exact. A stream then counts the paths in
    a branch of their own, behind a deduplication, so any output mode works.
    """
    rows = watermarked(access, watermark)
    exact_stream = rsd is None and access.isStreaming
    if exact_stream:
        totals = _requests_only(rows, window)
    else:
        totals = _by_path(rows, window) if rsd is None else _by_sketch(rows, window, rsd)
    requests, paths = F.col("requests"), F.col("paths")
    rate = F.try_divide("failures", "requests")
    client = F.col("per_client")

    def verdict(condition: Column, kind: str, ip: Column, count: Column, score: Column) -> Column:
        return F.when(condition, F.struct(
            F.lit(kind).alias("kind"), ip.alias("ip"), count.alias("count"),
            score.alias("score"),
        ))

    t = thresholds
    verdicts = F.array_compact(F.array(
        verdict(client & (requests >= t.ip_requests), "ip_spike", F.col("ip"), requests,
                requests / t.ip_requests),
        verdict(client & (paths >= t.scan_paths), "scan", F.col("ip"), paths,
                paths / t.scan_paths),
        verdict(~client & (rate >= t.error_rate), "error_surge", F.lit(""), requests, rate),
    ))
    found = (
        totals.select(F.col("span.end").alias("window_end"), "hostname",
                      F.explode(verdicts).alias("v"))
        .select("window_end", "hostname", "v.ip", "v.kind", "v.count", "v.score")
    )
    if exact_stream:
        found = found.unionByName(path_scans(access, t.scan_paths, window, watermark))
    return found.withColumn("window_s", seconds_in(window).cast("bigint"))
