from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logloom.config import Settings, Thresholds
from logloom.operators import anomalies as an
from logloom.operators import rollups
from logloom.operators.access import read_access
from tests.conftest import rows
from tests.samples import LOGIN_404, at, lines, request


def access(spark, values):
    return read_access(lines(spark, values))


def test_fifteen_requests_nine_errors(spark):
    values = [request(at(i % 10), status=404 if i < 9 else 200) for i in range(15)]
    row = rollups.http_stats(access(spark, values)).first()
    assert (row["count"], row.rps, row.err_rate, row.err_count) == (15, 1.5, 0.6, 9)
    assert row.window_end == datetime(2025, 1, 1, 0, 0, 10)


def test_three_gets(spark):
    values = [request(at(i), rt=rt) for i, rt in enumerate((0.1, 0.2, 0.099))]
    row = rollups.http_stats(access(spark, values)).first()
    assert (row["count"], row.rps, row.avg_rt, row.max_rt) == (3, 0.3, 0.133, 0.2)


def test_null_status_and_null_time(spark):
    values = [request(status=None, rt=None), request(status=599), request(status=600),
              "not json", request(time="?")]
    row = rollups.http_stats(access(spark, values)).first()
    assert (row["count"], row.err_count, row.avg_rt) == (3, 1, pytest.approx(0.1))


def test_window_end_follows_the_time_text(spark):
    row = rollups.top_urls(access(spark, [LOGIN_404])).first()
    assert row.window_end.timestamp() == datetime(2024, 3, 17, 14, 5, 10).timestamp()


def test_subsecond_window(spark):
    row = rollups.http_stats(access(spark, [request()]), "500 milliseconds").first()
    assert row.rps == 2.0


def test_sums_agree(spark, events):
    from logloom.sources.eventlog import access_rows
    log = access_rows(events)
    stats = rollups.http_stats(log).agg(F.sum("count")).first()[0]
    urls = rollups.top_urls(log).agg(F.sum("count")).first()[0]
    assert stats == urls == log.where("event_time is not null").count()


def test_ip_spike_at_threshold(spark):
    values = [request(at(i), ip="2.2.2.2") for i in range(3)] + [request(ip="3.3.3.3")]
    got = rows(an.ip_spikes(access(spark, values), 3))
    assert [(r["ip"], r["count"], r["score"]) for r in got] == [("2.2.2.2", 3, 1.0)]


def test_error_surge_counts_only_server_errors(spark):
    values = [request(status=500)] + [request(status=404)] * 9
    got = rows(an.error_surges(access(spark, values), 0.1))
    assert [(r["ip"], r["count"], r["score"]) for r in got] == [("", 10, 0.1)]
    assert an.error_surges(access(spark, [request(status=404)]), 0.1).count() == 0


def test_scan_counts_paths(spark):
    values = [request(at(i % 10), path=f"/{i % 20}") for i in range(40)]
    values.append(request(path=None))
    got = rows(an.path_scans(access(spark, values), 20))
    assert [(r["count"], r["score"]) for r in got] == [(20, 1.0)]
    assert an.path_scans(access(spark, values), 21).count() == 0


def test_one_pass_equals_three(spark, events):
    from logloom.sources.eventlog import access_rows
    log = access_rows(events)
    t = Thresholds(ip_requests=3, scan_paths=3, error_rate=0.25)
    one = an.anomalies(log, t, "1 day").drop("window_s")
    three = (
        an.ip_spikes(log, 3, "1 day").unionByName(an.error_surges(log, 0.25, "1 day"))
        .unionByName(an.path_scans(log, 3, "1 day"))
    )
    assert rows(one.select(*three.columns)) == rows(three)
    assert one.count() > 0


def test_one_pass_keeps_missing_clients(spark):
    values = [request(at(i), ip=None, status=200) for i in range(4)]
    t = Thresholds(ip_requests=4, scan_paths=9, error_rate=0.5)
    got = rows(an.anomalies(access(spark, values), t))
    assert [(r["kind"], r["ip"], r["count"], r["window_s"]) for r in got] == [
        ("ip_spike", None, 4, 10)
    ]


def test_hot_client(spark):
    """A third of all rows from one client, each for another path."""
    hot = spark.range(20_000).select(
        F.lit("2025-01-01 00:00:00").cast("timestamp").alias("event_time"),
        F.lit("web1").alias("hostname"), F.lit("6.6.6.6").alias("remote"),
        F.concat(F.lit("/"), "id").alias("path"), F.lit(200).alias("status"),
    )
    rest = spark.range(40_000).select(
        F.lit("2025-01-01 00:00:00").cast("timestamp").alias("event_time"),
        F.lit("web1").alias("hostname"), F.col("id").cast("string").alias("remote"),
        F.lit("/").alias("path"), F.lit(200).alias("status"),
    )
    got = rows(an.anomalies(hot.unionByName(rest)))
    assert [(r["kind"], r["count"]) for r in got] == [("ip_spike", 20_000), ("scan", 20_000)]


def test_settings_from_environment():
    s = Settings.from_env({"WINDOW_DURATION": "30 seconds", "IP_SPIKE_THRESHOLD": "7",
                           "THRESHOLD_ERROR_RATE": "0.4", "ENV_TAG": "prod"})
    assert (s.window, s.env, s.watermark) == ("30 seconds", "prod", "2 minutes")
    assert s.thresholds == Thresholds(7, 20, 0.4)
    assert Settings.from_env({"ERROR_RATE_THRESHOLD": "0.2", "THRESHOLD_ERROR_RATE": "0.4"}
                             ).thresholds.error_rate == 0.2
    assert Settings.from_env({}) == Settings()
