"""Runnable queries over the given tables: each takes (spark, folder) and gives a DataFrame.

All of them read the whole ``events`` table (``dead_letters`` also ``documents``) as access
and error logs. Metric tables are derived from it by the operators, in one plan with the
report that reads them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.config import Thresholds
from logloom.functions.access import event_time, status_class
from logloom.operators import alerts, anomalies, rollups, sketches
from logloom.operators import timeseries as ts
from logloom.operators.access import decode_access, normalize_access, read_access, undated
from logloom.operators.errors import (
    classify_errors,
    error_json,
    normalize_errors,
    parse_error_lines,
    read_errors,
    split_error_lines,
)
from logloom.operators.points import (
    ANOMALY,
    ERROR_EVENTS,
    HTTP_STATS,
    TOP_URLS,
    latest_wins,
    retain,
    stack,
    to_lines,
    to_long,
    to_points,
    to_wide,
)
from logloom.plans import reports
from logloom.sources import eventlog
from logloom.sources.commits import Replacement
from logloom.sources.logs import override_host, routed_type
from logloom.sources.metric_store import measurements, visible

Query = Callable[[SparkSession, str], DataFrame]

# The events cover January 2024.
START, STOP, NOW = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-01-31 00:00:00"
# Events are sparse next to real logs, so anomalies use longer windows and lower marks.
HOURLY = Thresholds(ip_requests=2, scan_paths=2, error_rate=0.3)
DAILY = Thresholds(ip_requests=6, scan_paths=5, error_rate=0.2)
CLOCK = alerts.Clock(every="1 hour", lookback="2 hours", bucket="1 hour")
MARKS = {"host_max": 1.0, "trend": 0.9, "max": 1.0, "top_error": 1.0, "total_5xx": 6.0}
RULES = tuple(
    replace(r, threshold=MARKS[r.signal], hold="24 minutes" if r.signal == "max" else "1 hour")
    for r in alerts.RULES
)


def _http_stats(rows: DataFrame, *args, **options) -> DataFrame:
    return rounded(rollups.http_stats(rows, *args, **options), "avg_rt")


class Logs:
    """The tables of one folder, seen as logs and as metric points."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        # Log times are compared as UTC, whatever zone the session came with.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    def between(self, start: str, stop: str, window: str = "10 seconds") -> Logs:
        """The same logs, reading only rows that points of the range can come from."""
        bounded = Logs(self.spark, self.folder)
        bounded.events = ts.raw_rows(self.events, start, stop, window, "ts")
        return bounded

    def month(self) -> Logs:
        return self.between(START, STOP)

    @cached_property
    def access(self) -> DataFrame:
        return eventlog.access_rows(self.events)

    @cached_property
    def lines(self) -> DataFrame:
        return eventlog.error_lines(self.events)

    @cached_property
    def errors(self) -> DataFrame:
        return read_errors(self.lines).withColumn("event_time", zoneless("event_time"))

    @cached_property
    def split(self) -> DataFrame:
        return split_error_lines(self.lines).withColumn("event_time", zoneless("event_time"))

    def stats(self, window: str = "10 seconds") -> DataFrame:
        return to_points(_http_stats(self.access, window), HTTP_STATS)

    def urls(self, window: str = "10 seconds") -> DataFrame:
        return to_points(rollups.top_urls(self.access, window), TOP_URLS)

    def error_points(self, window: str = "10 seconds") -> DataFrame:
        return to_points(rollups.error_events(self.errors, window), ERROR_EVENTS)

    def anomaly(self) -> DataFrame:
        return to_points(anomalies.anomalies(self.access, HOURLY, "1 hour"), ANOMALY)

    def tables(self) -> list:
        return [(HTTP_STATS, self.stats()), (TOP_URLS, self.urls()),
                (ANOMALY, self.anomaly()), (ERROR_EVENTS, self.error_points())]

    def alert_tables(self) -> dict[str, DataFrame]:
        return {"anomaly": self.anomaly(), "top_urls": self.urls()}


def zoneless(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def rounded(frame: DataFrame, *names: str) -> DataFrame:
    """Means of doubles depend on the order of addition in the last digit."""
    return frame.withColumns({n: F.round(n, 12) for n in names})


REGISTRY: dict[str, Callable[[Logs], DataFrame]] = {}


def query(build: Callable[[Logs], DataFrame]) -> Callable[[Logs], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    def bind(build: Callable[[Logs], DataFrame]) -> Query:
        return lambda spark, folder: build(Logs(spark, folder))

    return {name: bind(build) for name, build in REGISTRY.items()}


# Sources and decoding


@query
def access_json_decoded(logs: Logs) -> DataFrame:
    return decode_access(eventlog.access_json(logs.events))


@query
def access_normalized(logs: Logs) -> DataFrame:
    rows = read_access(eventlog.access_json(logs.events))
    return rows.withColumn("event_time", zoneless("event_time"))


@query
def access_event_time(logs: Logs) -> DataFrame:
    """Every third record without time text, every third with unreadable text."""
    record = decode_access(eventlog.access_json(logs.events))
    which = F.col("bytes") / 100 % 3
    text = F.when(which == 0, F.col("time")).when(which == 1, F.lit("not a time"))
    times = record.select(
        F.when(which == 0, "text").when(which == 1, "bad text").otherwise("no text")
        .alias("source"),
        event_time(text, F.col("ts")).cast("timestamp_ntz").alias("event_time"),
    )
    return times


@query
def status_class_counts(logs: Logs) -> DataFrame:
    classes = logs.access.select(status_class(F.col("status")).alias("status_class"))
    return classes.groupBy("status_class").agg(F.count(F.lit(1)).alias("requests"))


@query
def route_counts(logs: Logs) -> DataFrame:
    routed = eventlog.envelopes(logs.events).select(
        F.coalesce("log_type", F.lit("none")).alias("log_type"),
        routed_type(F.col("log_type")).alias("target"),
    )
    return routed.groupBy("log_type", "target").agg(F.count(F.lit(1)).alias("lines"))


@query
def host_tagged(logs: Logs) -> DataFrame:
    tagged = override_host(eventlog.envelopes(logs.events).select(
        "host", "value", F.get_json_object("value", "$.hostname").alias("hostname"),
    ))
    return tagged.groupBy("hostname").agg(F.count(F.lit(1)).alias("lines"))


@query
def dead_letters(logs: Logs) -> DataFrame:
    """Input that no window can take: prose offered as access lines gives none."""
    access = eventlog.access_json(logs.events).select(F.lit("access").alias("source"), "value")
    prose = logs.table("documents").select(F.lit("prose").alias("source"),
                                           F.col("text").alias("value"))
    counts = []
    for raw, name in ((access, "access"), (prose, "prose")):
        rows = read_access(raw)
        counts.append(
            undated(rows).agg(F.count(F.lit(1)).alias("undated"))
            .select(F.lit(name).alias("source"), "undated")
        )
    return stack(counts)


@query
def error_parsed(logs: Logs) -> DataFrame:
    rows = normalize_errors(parse_error_lines(logs.lines))
    return rows.withColumn("event_time", zoneless("event_time"))


@query
def error_message_class(logs: Logs) -> DataFrame:
    rows = classify_errors(normalize_errors(parse_error_lines(logs.lines)))
    return rows.groupBy("message_class").agg(F.count(F.lit(1)).alias("lines"))


@query
def error_fields(logs: Logs) -> DataFrame:
    return logs.split.drop("line")


@query
def error_rows_json(logs: Logs) -> DataFrame:
    return error_json(read_errors(logs.lines))


# Windowed metrics


@query
def http_stats(logs: Logs) -> DataFrame:
    return _http_stats(logs.access, "1 hour")


@query
def http_stats_10s(logs: Logs) -> DataFrame:
    return _http_stats(logs.access)


@query
def http_stats_from_json(logs: Logs) -> DataFrame:
    """The whole path: JSON text, decoding, normalizing, window."""
    rows = read_access(eventlog.access_json(logs.events))
    stats = _http_stats(rows, "1 hour")
    return stats.withColumn("window_end", zoneless("window_end"))


@query
def http_stats_by_class(logs: Logs) -> DataFrame:
    rows = logs.access.withColumn("status_class", status_class(F.col("status")))
    return _http_stats(rows, "1 hour", by=("hostname", "method", "status_class"))


@query
def top_urls(logs: Logs) -> DataFrame:
    return rollups.top_urls(logs.access, "1 hour")


@query
def error_events(logs: Logs) -> DataFrame:
    return rollups.error_events(logs.errors, "1 hour")


@query
def anomaly_ip_spike(logs: Logs) -> DataFrame:
    return anomalies.ip_spikes(logs.access, 6, "1 day")


@query
def anomaly_error_surge(logs: Logs) -> DataFrame:
    return anomalies.error_surges(logs.access, 0.3, "1 hour")


@query
def anomaly_scan(logs: Logs) -> DataFrame:
    return anomalies.path_scans(logs.access, 5, "1 day")


@query
def all_anomalies(logs: Logs) -> DataFrame:
    return anomalies.anomalies(logs.access, DAILY, "1 day")


# Points


@query
def line_protocol(logs: Logs) -> DataFrame:
    points = [(HTTP_STATS, logs.stats("1 hour")), (TOP_URLS, logs.urls("1 hour")),
              (ERROR_EVENTS, logs.error_points("1 hour"))]
    return stack([to_lines(p, m) for m, p in points])


@query
def anomaly_lines(logs: Logs) -> DataFrame:
    return to_lines(logs.anomaly(), ANOMALY)


@query
def http_stats_long(logs: Logs) -> DataFrame:
    return to_long(logs.stats("1 hour"), HTTP_STATS)


@query
def http_stats_pivot(logs: Logs) -> DataFrame:
    return to_wide(to_long(logs.stats("1 hour"), HTTP_STATS), HTTP_STATS.key, HTTP_STATS.fields)


@query
def latency_pivot(logs: Logs) -> DataFrame:
    long = to_long(logs.stats("1 hour"), HTTP_STATS)
    fields = ("avg_rt", "max_rt")
    return to_wide(long.where(F.col("field").isin(*fields)), HTTP_STATS.key, fields)


@query
def error_events_pivot(logs: Logs) -> DataFrame:
    long = to_long(logs.error_points("1 hour"), ERROR_EVENTS)
    return to_wide(long, ERROR_EVENTS.key, ERROR_EVENTS.fields)


@query
def anomaly_pivot(logs: Logs) -> DataFrame:
    return to_wide(to_long(logs.anomaly(), ANOMALY), ANOMALY.key, ANOMALY.fields)


@query
def latest_wins_view(logs: Logs) -> DataFrame:
    """Hourly URL points written three times: as seen after each third of the hour."""
    third = F.floor(F.minute("event_time") / 20)
    parts = logs.access.withColumn("third", third).groupBy(
        F.window("event_time", "1 hour").alias("w"), "hostname", "status", "path", "third"
    ).agg(F.count(F.lit(1)).alias("n"))
    # A part is counted in the version of its own third and of every later one.
    versions = (
        parts.withColumn("batch_id", F.explode(F.sequence("third", F.lit(2).cast("bigint"))))
        .groupBy("w", "hostname", "status", "path", "batch_id")
        .agg(F.sum("n").alias("count"))
        .select(F.col("w.end").alias("time"), F.lit("dev").alias("env"), "hostname", "status",
                "path", "count", "batch_id")
    )
    return latest_wins(versions, TOP_URLS.key, TOP_URLS.fields)


#: A published replacement of one week, and a later rewrite by the stream of two days at its end.
REPLACED = Replacement(2, 1_704_672_000_000_000, 1_705_276_800_000_000)
REWRITTEN = "time >= '2024-01-14' AND time < '2024-01-16'"


def url_versions(logs: Logs) -> DataFrame:
    """Hourly URL points as writers leave them in a table, with number and batch of each version.

    The stream (1) writes each point twice, and once a point that it later would not write;
    replacement 2 is published, replacement 3 is not; a new stream (4) rewrites two days.
    """
    points = logs.urls("1 hour")
    stale = F.concat(F.col("path"), F.lit("?old"))

    def version(number: int, batch: int, count: Column, path: Column = F.col("path"), where: str = "true") -> Column:
        return F.when(F.expr(where), F.struct(
            F.lit(number).cast("bigint").alias("generation"), F.lit(batch).cast("bigint").alias("batch_id"),
            path.alias("path"), count.cast("bigint").alias("count")))

    count = F.col("count")
    versions = F.array_compact(F.array(
        version(1, 0, F.floor(count / 2)), version(1, 1, count), version(1, 0, F.lit(1), stale),
        version(2, -1, count + 100, where="time >= '2024-01-08' AND time < '2024-01-15'"),
        version(3, -1, count + 1_000), version(4, 0, count + 7, where=REWRITTEN),
    ))
    unfolded = points.select("time", "env", "hostname", "status", F.explode(versions).alias("v"))
    return unfolded.select("time", "env", "hostname", "status", "v.path", "v.count", "v.generation", "v.batch_id")


def newest(versions: DataFrame) -> DataFrame:
    seen = visible(versions, [REPLACED]).withColumn("version", F.struct("generation", "batch_id"))
    return latest_wins(seen, TOP_URLS.key, TOP_URLS.fields, "version")


@query
def latest_wins_generations(logs: Logs) -> DataFrame:
    """Current points of a table with streams, a published replacement and an unpublished one."""
    return newest(url_versions(logs))


@query
def retention(logs: Logs) -> DataFrame:
    """The week before NOW and all after it; the rows before it are not read."""
    floor = F.lit(NOW).cast("timestamp_ntz") - F.expr("INTERVAL 169 hours")
    recent = Logs(logs.spark, logs.folder)
    recent.events = logs.events.where(F.col("ts") >= floor)
    return retain(recent.stats("1 hour"), F.lit(NOW).cast("timestamp_ntz"), "168 hours")


@query
def range_scan(logs: Logs) -> DataFrame:
    week = "2024-01-08 00:00:00", "2024-01-15 00:00:00"
    return ts.in_range(logs.between(*week).stats(), *week)


@query
def measurement_names(logs: Logs) -> DataFrame:
    """Every dated row is in a point of its table; only anomalies must be computed."""
    access, errors = (r.where(F.col("event_time").isNotNull()) for r in (logs.access, logs.errors))
    return measurements([(HTTP_STATS, access), (TOP_URLS, access),
                         (ANOMALY, logs.anomaly()), (ERROR_EVENTS, errors)])


# HTTP reports


@query
def err_rate_mean(logs: Logs) -> DataFrame:
    return rounded(reports.mean_error_rate(ts.in_range(logs.month().stats(), START, STOP)), "err_rate")


@query
def requests_by_host(logs: Logs) -> DataFrame:
    return reports.requests_by_host(logs.stats())


@query
def requests_by_method(logs: Logs) -> DataFrame:
    return reports.requests_by_method(logs.stats())


def _trend(logs: Logs, field: str, window: str = "10 seconds",
           every: str = "5 minutes") -> DataFrame:
    return rounded(reports.field_trend(logs.stats(window), field, every), field)


@query
def avg_rt_5m(logs: Logs) -> DataFrame:
    return _trend(logs, "avg_rt")


@query
def max_rt_5m(logs: Logs) -> DataFrame:
    return _trend(logs, "max_rt")


@query
def err_rate_5m(logs: Logs) -> DataFrame:
    return _trend(logs, "err_rate")


@query
def rps_5m(logs: Logs) -> DataFrame:
    return _trend(logs, "rps")


@query
def avg_rt_1d(logs: Logs) -> DataFrame:
    return _trend(logs, "avg_rt", "1 hour", "1 day")


@query
def latency_p95(logs: Logs) -> DataFrame:
    return reports.latency_percentiles(logs.stats())


@query
def latency_p95_per_window(logs: Logs) -> DataFrame:
    return reports.latency_percentile_per_window(logs.access, "1 day")


@query
def latency_p95_sketch(logs: Logs) -> DataFrame:
    """Daily p95 from merged hourly sketches, and whether its rank is as close as stated."""
    points = to_points(sketches.sketch_rollup(logs.access, "1 hour"), sketches.SKETCHES)
    days = sketches.merge(points, ["hostname"], "1 day").select(
        F.col("time").alias("day"), F.col("hostname").alias("host"), sketches.response_time(0.95).alias("p95"))
    spans = logs.access.select(F.window("event_time", "1 day")["end"].alias("time"), "hostname", "rt")
    ranks = (
        spans.join(days, (F.col("time") == F.col("day")) & (F.col("hostname") == F.col("host")))
        .groupBy("time", "hostname").agg(
            F.count(F.lit(1)).alias("requests"), F.avg((F.col("rt") < F.col("p95")).cast("int")).alias("below"),
            F.avg((F.col("rt") <= F.col("p95")).cast("int")).alias("upto"))
    )
    error = sketches.RANK_ERROR
    close = (F.col("below") - error <= 0.95) & (F.col("upto") + error >= 0.95)
    return ranks.select("time", "hostname", "requests", close.alias("close"))


@query
def clients_by_sketch(logs: Logs) -> DataFrame:
    """Daily clients from merged hourly sketches, beside the exact number."""
    points = to_points(sketches.sketch_rollup(logs.access, "1 hour"), sketches.SKETCHES)
    days = sketches.merge(points, ["hostname"], "1 day").select("time", "hostname", sketches.clients().alias("guess"))
    exact = (
        logs.access.select(F.window("event_time", "1 day")["end"].alias("time"), "hostname", "remote").distinct()
        .groupBy("time", "hostname").agg(F.count("remote").alias("clients"))
    )
    close = F.abs(F.col("guess") - F.col("clients")) <= sketches.COUNT_ERROR * F.col("clients")
    return exact.join(days, ["time", "hostname"]).select("time", "hostname", "clients", close.alias("close"))


@query
def latency_breaches(logs: Logs) -> DataFrame:
    return reports.slow_windows(logs.stats(), 0.2)


# URL reports


@query
def requests_by_status(logs: Logs) -> DataFrame:
    return reports.requests_by_status(ts.since(logs.month().urls(), STOP, "31 days"))


@query
def top5_error_hosts(logs: Logs) -> DataFrame:
    return reports.top_hosts_by_errors(ts.since(logs.month().urls(), STOP, "31 days"))


@query
def top10_errors(logs: Logs) -> DataFrame:
    return reports.top_url_errors(ts.since(logs.month().urls(), STOP, "31 days"))


@query
def top10_urls(logs: Logs) -> DataFrame:
    return reports.top_pages(ts.since(logs.month().urls(), STOP, "31 days"))


@query
def top10_urls_by_status(logs: Logs) -> DataFrame:
    return reports.top_pages_by_status(logs.urls())


@query
def top10_error_urls_by_status(logs: Logs) -> DataFrame:
    return reports.top_pages_by_status(logs.urls(), errors_only=True)


@query
def error_urls(logs: Logs) -> DataFrame:
    return reports.error_urls(logs.urls())


@query
def error_status_distribution(logs: Logs) -> DataFrame:
    return rounded(reports.error_status_distribution(logs.urls()), "share")


@query
def top_urls_per_window(logs: Logs) -> DataFrame:
    return reports.top_urls_per_window(logs.urls("1 day"))


@query
def top_ips(logs: Logs) -> DataFrame:
    return reports.top_clients(logs.access)


# Anomaly reports


@query
def anomaly_score_trend(logs: Logs) -> DataFrame:
    return rounded(reports.score_trend(logs.anomaly(), every="1 day"), "score")


@query
def anomaly_score_trend_web1(logs: Logs) -> DataFrame:
    return rounded(reports.score_trend(logs.anomaly(), "web1", "1 day"), "score")


@query
def max_score(logs: Logs) -> DataFrame:
    return reports.max_score(logs.anomaly())


@query
def max_score_by_host(logs: Logs) -> DataFrame:
    return reports.max_score_by_host(logs.anomaly())


@query
def anomaly_high_score(logs: Logs) -> DataFrame:
    return reports.high_scores(logs.anomaly())


@query
def top_scan_ips(logs: Logs) -> DataFrame:
    return reports.top_anomalous_clients(logs.anomaly(), "scan")


# Error reports


@query
def error_trend_filled(logs: Logs) -> DataFrame:
    return reports.error_trend(logs.month().error_points(), START, STOP, "5 minutes")


@query
def errors_by_class(logs: Logs) -> DataFrame:
    return reports.errors_by(logs.error_points(), ["message_class"])


@query
def errors_by_host_level(logs: Logs) -> DataFrame:
    return reports.errors_by(logs.error_points(), ["hostname", "level"])


@query
def errors_by_level(logs: Logs) -> DataFrame:
    return reports.errors_by_level(logs.errors, "1 hour")


@query
def error_share_by_host(logs: Logs) -> DataFrame:
    return rounded(reports.error_share_by_host(logs.error_points()), "share")


@query
def error_summary(logs: Logs) -> DataFrame:
    return reports.error_summary(logs.error_points())


@query
def last5_error_events(logs: Logs) -> DataFrame:
    return reports.last_errors(logs.error_points())


@query
def last5_error_events_per_series(logs: Logs) -> DataFrame:
    return reports.last_errors_per_series(logs.error_points())


@query
def latest_errors(logs: Logs) -> DataFrame:
    return reports.latest_at_level(logs.error_points())


@query
def error_by_upstream(logs: Logs) -> DataFrame:
    return reports.errors_by_upstream(logs.split, "1 day")


@query
def top_upstreams(logs: Logs) -> DataFrame:
    return reports.top_upstreams(logs.split)


@query
def error_samples(logs: Logs) -> DataFrame:
    return reports.error_samples(logs.errors, 5, "1 day")


# Checks


@query
def latest_points(logs: Logs) -> DataFrame:
    return reports.latest_points(reports.all_series(logs.tables()))


@query
def measurement_samples(logs: Logs) -> DataFrame:
    return reports.samples(reports.all_series(logs.tables()))


@query
def overview_samples(logs: Logs) -> DataFrame:
    """The first ten points of every series."""
    return reports.samples(reports.all_series(logs.tables()), 10)


@query
def series_counts(logs: Logs) -> DataFrame:
    return reports.series_counts(reports.all_series(logs.tables()))


@query
def record_counts(logs: Logs) -> DataFrame:
    return reports.record_counts(logs.tables())


# Alerts


@query
def alert_breaches(logs: Logs) -> DataFrame:
    return alerts.breaches(logs.alert_tables(), RULES, CLOCK)


#: The first evaluation looks back before START, and anomaly windows are an hour long.
BEFORE_START = "2023-12-31 22:00:00"


@query
def alert_states(logs: Logs) -> DataFrame:
    tables = logs.between(BEFORE_START, STOP, "1 hour").alert_tables()
    return alerts.alert_states(tables, START, STOP, RULES, CLOCK)


@query
def alert_states_absent_host(logs: Logs) -> DataFrame:
    """A rule on a host that no point names reports for itself."""
    trend = next(r for r in RULES if r.name == "trend_web1")
    rules = (trend, replace(trend, name="trend_web9", host="web9"))
    tables = logs.between(BEFORE_START, STOP, "1 hour").alert_tables()
    return alerts.alert_states(tables, START, STOP, rules, CLOCK)


@query
def alert_states_empty_range(logs: Logs) -> DataFrame:
    """All rules on a day that no point reaches."""
    return alerts.alert_states(logs.alert_tables(), "2024-02-05 00:00:00", "2024-02-06 00:00:00", RULES, CLOCK)


@query
def alert_states_from_versions(logs: Logs) -> DataFrame:
    """Rules on URLs over a table that holds several versions of its points."""
    rules = [r for r in RULES if alerts.SIGNAL_TABLE[r.signal] == "top_urls"]
    versions = url_versions(logs.between(BEFORE_START, STOP, "1 hour"))
    return alerts.alert_states({"top_urls": newest(versions)}, START, STOP, rules, CLOCK)
