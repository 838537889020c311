from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logloom.functions.errors import message_class
from logloom.operators.errors import (
    error_json,
    parse_error_lines,
    read_errors,
    split_error_lines,
)
from tests.samples import NO_SERVER, NOTICE, REFUSED, lines


def test_contract_line(spark):
    row = read_errors(lines(spark, [REFUSED], "line")).first()
    assert row.event_time == datetime(2024, 3, 17, 21, 5, 30)
    assert (row.hostname, row.level) == ("web1", "error")
    assert row.message.startswith("connect() failed") and ", request: " in row.message
    assert row.message_class == "connection_failed"


def test_host_is_taken_as_written(spark):
    row = read_errors(lines(spark, [NO_SERVER], "line")).first()
    assert row.hostname == "localhost:9443"


def test_lines_without_parts(spark):
    notice, junk = [
        parse_error_lines(lines(spark, [text], "line")).first().asDict()
        for text in (NOTICE, "junk")
    ]
    assert notice == {"time": "2024/11/30 18:20:44", "level": "notice", "hostname": "",
                      "message": ""}
    assert set(junk.values()) == {""}
    assert read_errors(lines(spark, ["junk", ""], "line")).where("event_time is null").count() == 2


def test_zone_of_line_times(spark):
    row = read_errors(lines(spark, [REFUSED], "line"), zone="Asia/Bangkok").first()
    assert row.event_time == datetime(2024, 3, 17, 14, 5, 30)


@pytest.mark.parametrize("message, expected", [
    ("connect() failed (timed out)", "connection_failed"),
    ("upstream timed out, not found", "timeout"),
    ("file not found", "not_found"),
    ("NOT FOUND", "other"), ("", "other"), (None, "other"),
])
def test_message_class(spark, message, expected):
    frame = spark.createDataFrame([(message,)], "m string")
    assert frame.select(message_class(F.col("m"))).first()[0] == expected


def test_full_split(spark):
    row = split_error_lines(lines(spark, [REFUSED], "line")).first().asDict()
    row.pop("line")
    assert row == {
        "time": "2024/03/17 21:05:30", "level": "error", "cid": 4402,
        "message": "connect() failed (111: Connection refused) while connecting to upstream",
        "client": "198.51.100.40", "server": "shop", "request": "POST /v2/order HTTP/1.1",
        "upstream": "http://10.9.8.7:9000/v2/order", "host": "web1", "referrer": "",
        "event_time": datetime(2024, 3, 17, 21, 5, 30),
    }
    row = split_error_lines(lines(spark, [NO_SERVER], "line")).first()
    assert (row.server, row.host) == ("", "localhost:9443")


def test_split_of_unusual_lines(spark):
    marked = REFUSED.replace("(111", "\u0001(111")
    rows = split_error_lines(lines(spark, [marked, "junk"], "line")).collect()
    assert rows[0].message.startswith("connect() failed \u0001(111") and rows[0].host == "web1"
    assert rows[1].message == "" and rows[1].cid is None and rows[1].event_time is None


def test_error_json(spark):
    text = error_json(read_errors(lines(spark, [REFUSED], "line"))).first().json
    assert text.startswith('{"hostname":"web1","event_time":"2024-03-17T21:05:30.000Z"')
    assert text.endswith('"message_class":"connection_failed"}')
