from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logloom.functions.line_protocol import float_text
from logloom.operators.points import (
    ANOMALY,
    HTTP_STATS,
    MEASUREMENTS,
    TOP_URLS,
    Measurement,
    clean_tags,
    latest_wins,
    retain,
    to_lines,
    to_long,
    to_points,
    to_series,
    to_wide,
)
from logloom.operators.rollups import http_stats
from logloom.sources import metric_store
from logloom.sources.eventlog import access_rows
from tests.conftest import rows

T0 = datetime(2025, 8, 25, 5, 35, 0)


def urls(spark, values):
    return spark.createDataFrame(
        values, "time timestamp, env string, hostname string, status int, path string, "
        "count bigint")


def test_contract_line(spark):
    frame = urls(spark, [(T0, "dev", "web1", 404, "/login", 15)])
    assert to_lines(frame, TOP_URLS).first().line == (
        "top_urls,env=dev,hostname=web1,status=404,path=/login count=15i 1756100100000000000"
    )


def test_tags_are_escaped_trimmed_and_defaulted(spark):
    frame = urls(spark, [(T0, "a b", " ", None, "/x,y=z ", 1)])
    assert to_lines(frame, TOP_URLS).first().line == (
        "top_urls,env=a\\ b,hostname=unknown_host,path=/x\\,y\\=z count=1i 1756100100000000000"
    )


def test_field_notations(spark):
    m = Measurement("m", ("hostname",), ("b", "i", "f", "s", "e"))
    frame = spark.createDataFrame(
        [(T0, "h", True, 3, 1.5, 'say "\\"', ""), (T0, "h", False, None, float("nan"), None, None),
         (T0, "h", None, None, float("inf"), None, None), (None, "h", True, 1, 1.0, "", "")],
        "time timestamp, hostname string, b boolean, i int, f double, s string, e string",
    )
    assert [r.line for r in to_lines(frame, m).collect()] == [
        'm,hostname=h b=1i,i=3i,f=1.5,s="say \\"\\\\\\"",e="" 1756100100000000000',
        "m,hostname=h b=0i 1756100100000000000",
    ]


def test_anomaly_line_carries_the_address_as_a_field(spark):
    frame = spark.createDataFrame(
        [(T0, "dev", "web1", "error_surge", "", 10, 0.5, 10),
         (T0, "dev", "web1", "ip_spike", "2.2.2.2", 3, 1.0, 10)],
        "time timestamp, env string, hostname string, kind string, ip string, count bigint, "
        "score double, window_s bigint")
    first, second = [r.line for r in to_lines(frame, ANOMALY).collect()]
    assert 'kind=error_surge ip="",count=10i,score=0.5' in first
    assert 'kind=ip_spike ip="2.2.2.2",count=3i,score=1.0' in second


@pytest.mark.parametrize("scale", [1e-300, 1e-9, 1e-5, 1e-4, 1e-3, 1.0, 1e6, 1e7, 1e9, 1e15,
                                   1e16, 1e22, 1e300])
def test_float_text_is_positional_where_short(spark, scale):
    values = [m * scale for m in (1.0, -1.0, 2.5, 3.125, 9.0, 7.0)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.t for r in frame.select(float_text(F.col("v")).alias("t")).collect()]
    assert [float(t) for t in got] == values
    short = [repr(v) for v in values]
    assert all("e" in g or "e" not in s for g, s in zip(got, short))
    assert [g for g, s in zip(got, short) if len(g) == len(s)] == [
        s for g, s in zip(got, short) if len(g) == len(s)]


def test_clean_tags_merge_before_aggregation(spark):
    frame = spark.createDataFrame([("",), (None,), (" web1 ",)], "hostname string")
    got = clean_tags(frame, ["hostname"]).groupBy("hostname").count()
    assert {r.hostname: r["count"] for r in got.collect()} == {"unknown_host": 2, "web1": 1}


def test_long_and_wide_are_inverse(spark, events):
    points = to_points(http_stats(access_rows(events), "1 day"), HTTP_STATS)
    wide = to_wide(to_long(points, HTTP_STATS), HTTP_STATS.key, HTTP_STATS.fields)
    assert rows(wide) == rows(points.withColumn("count", F.col("count").cast("double")))


def test_series_form(spark):
    frame = urls(spark, [(T0, "dev", "web1", 200, "/", 2)])
    assert rows(to_series(frame, TOP_URLS)) == [{
        "time": T0, "measurement": "top_urls",
        "series": "env=dev,hostname=web1,status=200,path=/", "field": "count", "value": 2.0,
    }]


def test_latest_version_wins_per_field(spark):
    frame = spark.createDataFrame(
        [("a", 1, 0.5, 1), ("a", 2, None, 2), ("b", 9, 1.0, 1)],
        "k string, n bigint, x double, batch_id bigint")
    once = latest_wins(frame, ["k"], ["n", "x"])
    assert rows(once) == [{"k": "a", "n": 2, "x": 0.5}, {"k": "b", "n": 9, "x": 1.0}]
    assert rows(latest_wins(frame.unionByName(frame), ["k"], ["n", "x"])) == rows(once)


def test_retention_prunes_dates(spark):
    frame = urls(spark, [(datetime(2025, 1, d), "dev", "h", 200, "/", d) for d in range(1, 11)])
    dated = frame.withColumn("date", F.to_date("time"))
    now = F.lit("2025-01-10 00:00:00").cast("timestamp")
    assert sorted(r["count"] for r in retain(dated, now, "72 hours").collect()) == [7, 8, 9, 10]
    assert retain(frame, now, "72 hours").count() == 4


def test_store_round_trip(spark, tmp_path):
    root = str(tmp_path / "store")
    day = [(datetime(2025, 1, d, 1), "dev", "h", 200, "/", d) for d in (1, 2, 3)]
    metric_store.append_points(urls(spark, day), root, TOP_URLS, batch_id=0)
    newer = [(datetime(2025, 1, 2, 1), "dev", "h", 200, "/", 20)]
    metric_store.append_points(urls(spark, newer), root, TOP_URLS, batch_id=1, files=1)
    metric_store.append_points(urls(spark, newer), root, TOP_URLS, batch_id=1)
    got = metric_store.read_points(spark, root, TOP_URLS, "2025-01-02", "2025-01-04")
    assert sorted(r["count"] for r in got.collect()) == [3, 20]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    target = str(tmp_path / "compacted")
    metric_store.compact(spark, root, target, TOP_URLS)
    again = metric_store.read_points(spark, target, TOP_URLS, "2025-01-01", "2025-01-04")
    assert sorted(r["count"] for r in again.collect()) == [1, 3, 20]


def test_measurements_with_points(spark):
    full, empty = urls(spark, [(T0, "dev", "h", 200, "/", 1)]), urls(spark, [])
    got = metric_store.measurements([(TOP_URLS, full), (HTTP_STATS, empty)])
    assert [r.measurement for r in got.collect()] == ["top_urls"]
    assert {m.name for m in MEASUREMENTS} == {"http_stats", "top_urls", "anomaly", "error_events"}
