from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logloom.operators import rollups
from logloom.functions.access import event_time, status_class
from logloom.operators.access import decode_access, normalize_access, read_access, undated
from tests.samples import API_502, LOGIN_404, lines, request


def test_contract_sample(spark):
    row = read_access(lines(spark, [LOGIN_404])).first()
    assert row.event_time == datetime(2024, 3, 17, 14, 5, 9)
    assert (row.hostname, row.status, row.status_class) == ("web1", 404, "4xx")
    assert (row.remote, row.bytes, row.rt) == ("198.51.100.23", 12, 0.007)


def test_columns_and_order(spark):
    frame = read_access(lines(spark, [API_502]))
    assert frame.columns == ["event_time", "hostname", "method", "path", "status",
                             "status_class", "remote", "bytes", "rt"]


@pytest.mark.parametrize("text", ["not json", "", '{"time":', "[1,2]", None])
def test_bad_json_is_one_null_row(spark, text):
    frame = decode_access(lines(spark, [text]))
    assert [tuple(r) for r in frame.collect()] in ([(None,) * 9],)
    assert undated(normalize_access(frame)).count() == 1


@pytest.mark.parametrize("status", ['"404"', "404.5"])
def test_wrongly_typed_status(spark, status):
    text = '{"time":"2025-01-01T00:00:00+00:00","status":%s,"hostname":"web1"}' % status
    row = read_access(lines(spark, [text])).first()
    assert row.status is None and row.status_class == "other" and row.hostname == "web1"


def test_text_columns_are_cast(spark):
    frame = spark.createDataFrame(
        [("2025-01-01T00:00:00Z", "1.5", "ip", "h", "GET", "/", "404", "7", "x")],
        "time string, ts string, remote string, hostname string, method string, path string, "
        "status string, bytes string, rt string",
    )
    row = normalize_access(frame).first()
    assert (row.status, row.bytes, row.rt) == (404, 7, None)


@pytest.mark.parametrize("iso, epoch, expected", [
    (None, 1692946496.923, datetime(2023, 8, 25, 6, 54, 56)),
    ("garbage", None, None),
    ("garbage", 1692946496.9, datetime(2023, 8, 25, 6, 54, 56)),
    ("2024-03-17T21:05:09+07:00", 1.0, datetime(2024, 3, 17, 14, 5, 9)),
    (None, -1.5, datetime(1969, 12, 31, 23, 59, 59)),
    (None, 1e300, None),
    (None, None, None),
])
def test_event_time(spark, iso, epoch, expected):
    frame = spark.createDataFrame([(iso, epoch)], "iso string, epoch double")
    assert frame.select(event_time(F.col("iso"), F.col("epoch"))).first()[0] == expected


def test_status_class_edges(spark):
    status = [199, 200, 299, 300, 399, 400, 499, 500, 599, 600, None]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(status)], "i int, s int")
    got = [r.c for r in frame.select("i", status_class(F.col("s")).alias("c")).orderBy("i")
           .collect()]
    assert got == ["other", "2xx", "2xx", "3xx", "3xx", "4xx", "4xx", "5xx", "5xx", "other",
                   "other"]


def test_mean_response_time_is_plain(spark):
    def mean(*values):
        rows = [(datetime(2025, 1, 1), "GET", "web1", 200, v) for v in values]
        frame = spark.createDataFrame(rows, "event_time timestamp, method string, hostname string, status int, rt double")
        return rollups.http_stats(frame, "1 hour").first()["avg_rt"]

    assert mean(0.1, 0.2, 0.3) == pytest.approx(0.2)
    assert mean(4e-7, 4e-7) == pytest.approx(4e-7)
    assert mean(1e13, 1e13) == 1e13
    assert math.isnan(mean(float("nan"), 0.2))
    assert mean(None, None) is None and mean(None, 0.4) == 0.4


def test_json_is_parsed_once_under_a_window(spark):
    frame = read_access(lines(spark, [request()]))
    plan = frame.groupBy(F.window("event_time", "1 hour")).count()
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
