"""Log-shaped views of an ``events`` table (event_id, ts, user_id, event_type, value, props)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.access import ACCESS_FIELDS


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _host() -> Column:
    return F.concat(F.lit("web"), (F.col("user_id") % 3 + 1).cast("string"))


def access_rows(events: DataFrame) -> DataFrame:
    """One typed access row per event."""
    k, kind, user = F.col("k"), F.col("event_type"), F.col("user_id")
    return events.withColumn("k", _k()).select(
        "event_id",
        F.col("ts").alias("event_time"),
        _host().alias("hostname"),
        F.when(kind == "purchase", "POST").when(kind == "signup", "PUT").otherwise("GET")
        .alias("method"),
        F.concat(F.lit("/"), kind, F.lit("/"), (k % 20).cast("string")).alias("path"),
        F.when(kind == "error", 500 + k % 5).when(k % 10 == 0, 404).when(k % 10 == 1, 301)
        .otherwise(200).cast("int").alias("status"),
        F.concat_ws(".", F.lit("10.0"), F.floor(user / 256).cast("string"),
                    (user % 256).cast("string")).alias("remote"),
        (k * 100).cast("bigint").alias("bytes"),
        (F.col("value") / 1000).alias("rt"),
    )


def access_json(events: DataFrame) -> DataFrame:
    """The same rows as access-log JSON lines."""
    time = F.col("event_time").cast("timestamp")
    record = access_rows(events).select(
        "event_id",
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("time"),
        (F.unix_micros(time) / 1e6).alias("ts"),
        *[c for c in ACCESS_FIELDS if c not in ("time", "ts")],
    )
    return record.select("event_id", F.to_json(F.struct(*ACCESS_FIELDS)).alias("value"))


def error_lines(events: DataFrame) -> DataFrame:
    """One raw error line per error event."""
    k, user = F.col("k"), F.col("user_id")
    reason = (
        F.when(k % 4 == 0, "connect() failed (111: Connection refused) while connecting to upstream")
        .when(k % 4 == 1, "upstream timed out (110: Connection timed out) while reading "
                          "response header from upstream")
        .when(k % 4 == 2, 'open() "/usr/share/nginx/html/x" failed (2: No such file or '
                          'directory), not found')
        .otherwise("client intended to send too large body")
    )
    line = F.format_string(
        '%s [%s] 24#24: *%d %s, client: 10.0.0.%d, server: %s, request: "GET /api/%d HTTP/1.1", '
        'upstream: "http://10.0.0.%d:8080/api", host: "%s"',
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss"),
        F.when(k % 3 == 0, "warn").otherwise("error"),
        F.col("event_id"), reason, user % 256, _host(), k % 20, k % 5, _host(),
    )
    return (
        events.withColumn("k", _k()).where(F.col("event_type") == "error")
        .select("event_id", line.alias("line"))
    )


def envelopes(events: DataFrame) -> DataFrame:
    """Collector events: every access line and error line with its type header.

    Types cover the routing cases: ``access``, ``error``, unknown text and none. The
    host header is present for two hosts of three.
    """
    kind = F.when(F.col("event_id") % 7 == 0, F.lit(None)).when(
        F.col("event_id") % 7 == 1, F.lit("audit")
    ).otherwise("access")
    access = access_json(events).select(
        "event_id", kind.alias("log_type"),
        F.nullif(F.get_json_object("value", "$.hostname"), F.lit("web3")).alias("host"), "value",
    )
    errors = error_lines(events).select(
        "event_id", F.lit("error").alias("log_type"),
        F.nullif(F.regexp_extract("line", r'host: "([^"]+)"', 1), F.lit("web3")).alias("host"),
        F.col("line").alias("value"),
    )
    return access.unionByName(errors)
