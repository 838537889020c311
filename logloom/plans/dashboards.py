"""Named result sets: the panels of each dashboard, the store checks, the runbook queries.

Every function takes metric points and gives a dict of name to DataFrame. Nothing runs
until a frame is used.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators import timeseries as ts
from logloom.operators.points import (
    ANOMALY,
    ERROR_EVENTS,
    HTTP_STATS,
    MEASUREMENTS,
    TOP_URLS,
    Measurement,
    to_long,
    to_wide,
)
from logloom.plans import reports
from logloom.sources.metric_store import measurements

Panels = dict[str, DataFrame]


def http_panels(stats: DataFrame, start: str, stop: str, every: str = "5 minutes") -> Panels:
    rows = ts.in_range(stats, start, stop)
    return {
        "error_rate": reports.mean_error_rate(rows),
        "requests": reports.requests_by_host(rows),
        "methods": reports.requests_by_method(rows),
        "avg_rt": reports.field_trend(rows, "avg_rt", every),
        "max_rt": reports.field_trend(rows, "max_rt", every),
        "err_rate": reports.field_trend(rows, "err_rate", every),
        "rps": reports.field_trend(rows, "rps", every),
    }


def anomaly_panels(anomaly: DataFrame, urls: DataFrame, start: str, stop: str,
                   hosts: tuple[str, ...] = ("web1", "web2", "web3"),
                   every: str = "5 minutes") -> Panels:
    scores, pages = ts.in_range(anomaly, start, stop), ts.in_range(urls, start, stop)
    trends = {f"trend_{h}": reports.score_trend(scores, h, every) for h in hosts}
    return {
        **trends,
        "max_score": reports.max_score(scores),
        "pivot_table_data": reports.error_urls(pages),
        "error_status_distribution": reports.error_status_distribution(pages),
        "top_clients": reports.top_anomalous_clients(scores),
    }


def url_panels(urls: DataFrame, now: str, lookback: str = "2 hours") -> Panels:
    rows = ts.since(urls, now, lookback)
    return {
        "by_status": reports.requests_by_status(rows),
        "top_hosts_by_errors": reports.top_hosts_by_errors(rows),
        "top_errors": reports.top_url_errors(rows),
        "top_pages": reports.top_pages(rows),
    }


def error_panels(events: DataFrame, start: str, stop: str, every: str = "5 minutes") -> Panels:
    rows = ts.in_range(events, start, stop)
    return {
        "error_trend": reports.error_trend(events, start, stop, every),
        "error_count_by_message_class": reports.errors_by(rows, ["message_class"]),
        "hostname_errors": reports.error_share_by_host(rows),
        "last_5_error_details": reports.last_errors(rows),
        "error_summary_table": reports.error_summary(rows),
    }


def store_checks(tables: Mapping[str, DataFrame], now: str) -> Panels:
    """What a newly started pipeline should show: measurements, newest points, samples."""
    known = [(m, tables[m.name]) for m in MEASUREMENTS if m.name in tables]

    def recent(lookback: str) -> list[tuple[Measurement, DataFrame]]:
        return [(m, ts.since(t, now, lookback)) for m, t in known]

    samples = {
        f"{m.name}_sample": reports.samples(reports.all_series([(m, t)]))
        for m, t in recent("30 minutes") if m is not ERROR_EVENTS
    }
    return {
        "available_measurements": measurements(known),
        "latest_data": reports.latest_points(reports.all_series(recent("1 hour"))),
        **samples,
        "record_counts": reports.record_counts(recent("1 hour")),
        "overview_samples": reports.samples(reports.all_series(recent("1 hour")), 10),
        "series_counts": reports.series_counts(reports.all_series(recent("1 hour"))),
    }


def runbook(tables: Mapping[str, DataFrame], now: str) -> Panels:
    stats, urls, anomaly, errors = (
        ts.since(tables[m.name], now, "1 hour")
        for m in (HTTP_STATS, TOP_URLS, ANOMALY, ERROR_EVENTS)
    )
    half_hour = ts.since(tables[HTTP_STATS.name], now, "30 minutes")
    long = to_long(stats, HTTP_STATS)
    latency = ("avg_rt", "max_rt")
    return {
        "http_stats": to_wide(long, HTTP_STATS.key, HTTP_STATS.fields),
        "latency": to_wide(long.where(F.col("field").isin(*latency)), HTTP_STATS.key, latency),
        "latency_p95": reports.latency_percentiles(half_hour),
        "top_urls": reports.top_pages_by_status(urls),
        "top_error_urls": reports.top_pages_by_status(urls, errors_only=True),
        "anomaly": to_wide(to_long(anomaly, ANOMALY), ANOMALY.key, ANOMALY.fields),
        "high_scores": reports.high_scores(anomaly),
        "error_events": to_wide(to_long(errors, ERROR_EVENTS), ERROR_EVENTS.key,
                                ERROR_EVENTS.fields),
        "latest_errors": reports.latest_at_level(errors),
        "errors_by_host_level": reports.errors_by(errors, ["hostname", "level"]),
    }
