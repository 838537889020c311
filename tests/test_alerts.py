from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from logloom.operators import alerts
from tests.conftest import rows

DAY = datetime(2025, 1, 1)
ANOMALY_SCHEMA = "time timestamp, hostname string, kind string, score double"
URL_SCHEMA = "time timestamp, hostname string, path string, status int, count bigint"


def rule(name):
    return next(r for r in alerts.RULES if r.name == name)


def tables(spark, anomaly=(), urls=()):
    a = [(DAY + timedelta(minutes=m), h, k, s) for m, h, k, s in anomaly]
    u = [(DAY + timedelta(minutes=m), h, p, s, c) for m, h, p, s, c in urls]
    return {"anomaly": spark.createDataFrame(a, ANOMALY_SCHEMA),
            "top_urls": spark.createDataFrame(u, URL_SCHEMA)}


def states(spark, name, stop="2025-01-01 00:40:00", **data):
    got = alerts.alert_states(tables(spark, **data), "2025-01-01 00:00:00", stop,
                              [rule(name)], alerts.Clock())
    return [(r["series"], r["evaluated"].minute, r["state"]) for r in sorted(
        rows(got), key=lambda r: (r["series"], r["evaluated"]))]


def test_threshold_is_strict(spark):
    data = [(1, "web1", "ip_spike", 20.0), (1, "web2", "ip_spike", 20.5)]
    got = rows(alerts.breaches(tables(spark, data), [rule("any_host")]))
    assert {r["series"] for r in got} == {"web2"}


def test_hold_then_fire_then_no_data(spark):
    data = [(m, "web1", "ip_spike", 30.0) for m in (1, 6, 11)] + [(21, "web1", "ip_spike", 1.0)]
    got = states(spark, "any_host", anomaly=data)
    assert got == [
        ("web1", 5, "Pending"), ("web1", 10, "Firing"), ("web1", 15, "Firing"),
        ("web1", 20, "Firing"), ("web1", 25, "Normal"), ("web1", 30, "Normal"),
        ("web1", 35, "NoData"), ("web1", 40, "NoData"),
    ]


def test_gap_restarts_the_hold(spark):
    data = [(1, "web1", "ip_spike", 30.0), (21, "web1", "ip_spike", 30.0)]
    got = dict((m, s) for _, m, s in states(spark, "any_host", anomaly=data))
    assert [got[m] for m in (5, 10, 15, 20, 25, 30)] == [
        "Pending", "Firing", "NoData", "NoData", "Pending", "Firing"]


def test_trend_takes_the_newest_bucket_of_one_host(spark):
    data = [(1, "web1", "scan", 10.0), (2, "web1", "scan", 50.0), (6, "web1", "scan", 5.0),
            (1, "web2", "scan", 90.0)]
    got = alerts.signals(tables(spark, data), [rule("trend_web1")], alerts.Clock())
    values = {r["evaluated"].minute: r["value"] for r in rows(got)}
    assert values == {5: 30.0, 10: 5.0, 15: 5.0}
    assert {r["series"] for r in rows(got)} == {"web1 | scan"}


def test_url_rules(spark):
    data = [(1, "web1", "/a", 500, 6), (1, "web2", "/a", 503, 5), (1, "web1", "/b", 404, 8),
            (2, "web1", "/a", 500, 1), (2, "web1", "/c", 200, 99)]
    both = [rule("top_error_path"), rule("total_5xx")]
    got = alerts.signals(tables(spark, urls=data), both, alerts.Clock())
    assert {(r["rule"], r["evaluated"].minute): r["value"] for r in rows(got)} == {
        ("top_error_path", 5): 8.0, ("top_error_path", 10): 8.0,
        ("total_5xx", 5): 12.0, ("total_5xx", 10): 12.0,
    }
    assert rows(alerts.breaches(tables(spark, urls=data), both))[0]["rule"] == "total_5xx"


def test_every_rule_reports_without_any_point(spark):
    for r in alerts.RULES:
        assert states(spark, r.name, "2025-01-01 00:10:00") == [("", 5, "NoData"), ("", 10, "NoData")]
    # A rule with a series reports that one only; another rule's points do not count.
    data = [(1, "web2", "scan", 1.0)]
    assert states(spark, "any_host", "2025-01-01 00:05:00", anomaly=data) == [("web2", 5, "Normal")]
    assert states(spark, "trend_web1", "2025-01-01 00:05:00", anomaly=data) == [("", 5, "NoData")]


def test_clock_is_checked():
    alerts.Clock("10 minutes", "20 minutes", "5 minutes")
    for wrong in (("7 minutes", "14 minutes", "5 minutes"), ("5 minutes", "12 minutes", "5 minutes"),
                  ("10 minutes", "5 minutes", "5 minutes")):
        with pytest.raises(ValueError):
            alerts.Clock(*wrong)


def test_lookback_reaches_before_the_start(spark):
    frame = tables(spark, [(-3, "web1", "scan", 1.0)])
    got = alerts.alert_states(frame, "2025-01-01 00:00:00", "2025-01-01 00:10:00",
                              [rule("max_score")])
    assert [r["state"] for r in sorted(rows(got), key=lambda r: r["evaluated"])] == [
        "Normal", "NoData"]


def test_labels_come_with_the_state(spark):
    got = alerts.alert_states(tables(spark, [(1, "web1", "scan", 1.0)]), "2025-01-01 00:00:00",
                              "2025-01-01 00:05:00", [rule("max_score"), rule("any_host")])
    labels = {r["rule"]: (r["severity"], r["component"]) for r in rows(got)}
    assert labels == {"max_score": ("critical", "anomaly-gauge"), "any_host": (None, None)}


def test_two_minute_hold_also_needs_a_second_breach(spark):
    short = replace(rule("max_score"), threshold=1)
    got = alerts.alert_states(tables(spark, [(1, "w", "scan", 2.0)]), "2025-01-01 00:00:00",
                              "2025-01-01 00:10:00", [short])
    assert [r["state"] for r in sorted(rows(got), key=lambda r: r["evaluated"])] == [
        "Pending", "Firing"]
