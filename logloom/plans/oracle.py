"""The same results as plain SQL, for DuckDB over the same Parquet tables."""

from __future__ import annotations

import re

# The patterns of an error line and the text of the log records below follow the
# format of the logs.
# Named subqueries; each entry lists what it reads so that a query carries only its own.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "evk": ((), """
        SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"""),
    "acc": (("evk",), """
        SELECT event_id, ts AS event_time,
          concat('web', CAST(user_id % 3 + 1 AS VARCHAR)) AS hostname,
          CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END
            AS method,
          concat('/', event_type, '/', CAST(k % 20 AS VARCHAR)) AS path,
          CAST(CASE WHEN event_type = 'error' THEN 500 + k % 5 WHEN k % 10 = 0 THEN 404
            WHEN k % 10 = 1 THEN 301 ELSE 200 END AS INT) AS status,
          concat('10.0.', CAST(user_id // 256 AS VARCHAR), '.', CAST(user_id % 256 AS VARCHAR))
            AS remote,
          CAST(k * 100 AS BIGINT) AS bytes,
          value / CAST(1000 AS DOUBLE) AS rt
        FROM evk"""),
    "err": (("evk",), """
        SELECT event_id, concat(strftime(ts, '%Y/%m/%d %H:%M:%S'), ' [',
          CASE WHEN k % 3 = 0 THEN 'warn' ELSE 'error' END, '] 24#24: *',
          CAST(event_id AS VARCHAR), ' ',
          CASE k % 4
            WHEN 0 THEN 'connect() failed (111: Connection refused) while connecting to upstream'
            WHEN 1 THEN 'upstream timed out (110: Connection timed out) while reading response header from upstream'
            WHEN 2 THEN 'open() "/usr/share/nginx/html/x" failed (2: No such file or directory), not found'
            ELSE 'client intended to send too large body' END,
          ', client: 10.0.0.', CAST(user_id % 256 AS VARCHAR),
          ', server: web', CAST(user_id % 3 + 1 AS VARCHAR),
          ', request: "GET /api/', CAST(k % 20 AS VARCHAR), ' HTTP/1.1", upstream: "http://10.0.0.',
          CAST(k % 5 AS VARCHAR), ':8080/api", host: "web', CAST(user_id % 3 + 1 AS VARCHAR), '"')
          AS line
        FROM evk WHERE event_type = 'error'"""),
    "parsed": (("err",), r"""
        SELECT line, regexp_extract(line, 'host: "([^"]+)"', 1) AS hostname,
          strptime(regexp_extract(line, '^(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})', 1),
            '%Y/%m/%d %H:%M:%S') AS event_time,
          regexp_extract(line, '\[(\w+)\]', 1) AS level,
          regexp_extract(line, '\d+#\d+: \*\d+ (.+?), host: .*', 1) AS message
        FROM err"""),
    "classed": (("parsed",), """
        SELECT hostname, event_time, level, message,
          CASE WHEN contains(message, 'connect() failed') THEN 'connection_failed'
            WHEN contains(message, 'timed out') THEN 'timeout'
            WHEN contains(message, 'not found') THEN 'not_found' ELSE 'other' END AS message_class
        FROM parsed"""),
}

# The order of addition changes a mean's last digit, so registered means are rounded.
MEAN_RT = "round(avg(rt), 12)"


def window_end(width: str, time: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '{width}', {time}) + INTERVAL '{width}'"


def seconds(width: str) -> int:
    count, unit = width.split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def stats_sql(width: str, source: str = "acc", keys: str = "hostname, method") -> str:
    return f"""
        SELECT {window_end(width)} AS window_end, {keys},
          count(*) AS count,
          CAST(count(*) AS DOUBLE) / CAST({seconds(width)} AS DOUBLE) AS rps,
          {MEAN_RT} AS avg_rt, max(rt) AS max_rt,
          CAST(count(*) FILTER (status BETWEEN 400 AND 599) AS BIGINT) AS err_count,
          CAST(count(*) FILTER (status BETWEEN 400 AND 599) AS DOUBLE) / count(*) AS err_rate
        FROM {source} GROUP BY ALL"""


def urls_sql(width: str) -> str:
    return f"""
        SELECT {window_end(width)} AS window_end, hostname, status, path, count(*) AS count
        FROM acc GROUP BY ALL"""


def error_events_sql(width: str) -> str:
    return f"""
        SELECT {window_end(width)} AS window_end, hostname, level, message_class,
          count(*) AS count
        FROM classed GROUP BY ALL"""


def spikes_sql(width: str, mark: int) -> str:
    return f"""
        SELECT {window_end(width)} AS window_end, hostname, remote AS ip, 'ip_spike' AS kind,
          count(*) AS count, CAST(count(*) AS DOUBLE) / {mark} AS score
        FROM acc GROUP BY ALL HAVING count(*) >= {mark}"""


def surges_sql(width: str, mark: float) -> str:
    rate = "CAST(count(*) FILTER (status BETWEEN 500 AND 599) AS DOUBLE) / count(*)"
    return f"""
        SELECT {window_end(width)} AS window_end, hostname, '' AS ip, 'error_surge' AS kind,
          count(*) AS count, {rate} AS score
        FROM acc GROUP BY ALL HAVING {rate} >= CAST({mark} AS DOUBLE)"""


def scans_sql(width: str, mark: int) -> str:
    return f"""
        SELECT {window_end(width)} AS window_end, hostname, remote AS ip, 'scan' AS kind,
          count(DISTINCT path) AS count, CAST(count(DISTINCT path) AS DOUBLE) / {mark} AS score
        FROM acc GROUP BY ALL HAVING count(DISTINCT path) >= {mark}"""


def anomalies_sql(width: str, ip: int, scan: int, rate: float) -> str:
    return f"""
        SELECT *, CAST({seconds(width)} AS BIGINT) AS window_s FROM (
        {spikes_sql(width, ip)} UNION ALL {surges_sql(width, rate)} UNION ALL
        {scans_sql(width, scan)})"""


def points(source: str, columns: str) -> str:
    return f"SELECT window_end AS time, 'dev' AS env, {columns} FROM ({source})"


STATS_COLUMNS = "hostname, method, count, rps, avg_rt, max_rt, err_rate"
for _name, _width in (("stats", "10 seconds"), ("stats_h", "1 hour")):
    PARTS[_name] = (("acc",), points(stats_sql(_width), STATS_COLUMNS))
for _name, _width in (("urls", "10 seconds"), ("urls_h", "1 hour"), ("urls_d", "1 day")):
    PARTS[_name] = (("acc",), points(urls_sql(_width), "hostname, status, path, count"))
for _name, _width in (("errp", "10 seconds"), ("errp_h", "1 hour")):
    PARTS[_name] = (("classed",), points(error_events_sql(_width),
                                         "hostname, level, message_class, count"))
PARTS["anom"] = (("acc",), points(anomalies_sql("1 hour", 2, 2, 0.3),
                                  "hostname, kind, ip, count, score, window_s"))


def long_sql(source: str, keys: str, fields: tuple[str, ...]) -> str:
    """One row per field, nulls left out."""
    return " UNION ALL ".join(
        f"SELECT {keys}, '{f}' AS field, CAST({f} AS DOUBLE) AS value FROM {source} "
        f"WHERE {f} IS NOT NULL" for f in fields
    )


STATS_FIELDS = ("count", "rps", "avg_rt", "max_rt", "err_rate")
SERIES = {
    "http_stats": ("stats", "concat('env=', env, ',hostname=', hostname, ',method=', method)",
                   STATS_FIELDS),
    "top_urls": ("urls", "concat('env=', env, ',hostname=', hostname, ',status=', "
                 "CAST(status AS VARCHAR), ',path=', path)", ("count",)),
    "anomaly": ("anom", "concat('env=', env, ',hostname=', hostname, ',kind=', kind, "
                "CASE WHEN ip = '' THEN '' ELSE concat(',ip=', ip) END)",
                ("count", "score", "window_s")),
    "error_events": ("errp", "concat('env=', env, ',hostname=', hostname, ',level=', level, "
                     "',message_class=', message_class)", ("count",)),
}
PARTS["series"] = (
    ("stats", "urls", "anom", "errp"),
    " UNION ALL ".join(
        long_sql(source, f"time, '{name}' AS measurement, {key} AS series", fields)
        for name, (source, key, fields) in SERIES.items()
    ),
)


def line_sql(source: str, name: str, tags: tuple[str, ...], fields: dict[str, str]) -> str:
    tag_text = ", ',', ".join(f"'{t}=', CAST({t} AS VARCHAR)" for t in tags)
    field_text = ", ',', ".join(f"'{f}=', {text}" for f, text in fields.items())
    return (f"SELECT concat('{name},', {tag_text}, ' ', {field_text}, ' ', "
            f"CAST(epoch_ns(time) AS VARCHAR)) AS line FROM {source}")


def count_text(name: str) -> str:
    return f"CAST({name} AS VARCHAR), 'i'"


# Alerts: values per rule, series and evaluation, each over the two hours before it.


def covered(source: str, columns: str) -> str:
    """Each point at the two hourly evaluations whose look-back covers it."""
    return (f"SELECT evaluated, {columns} FROM (SELECT *, unnest([time_bucket(INTERVAL '1 hour', time) "
            f"+ INTERVAL '1 hour', time_bucket(INTERVAL '1 hour', time) + INTERVAL '2 hours']) "
            f"AS evaluated FROM {source})")


PARTS["acell"] = (("anom",), covered("anom", "time, hostname, kind, score"))
PARTS["ucell"] = (("urls",), covered("urls", "time, hostname, path, status, count"))
PARTS["trend"] = (("acell",), """
        SELECT evaluated, hostname, concat(hostname, ' | ', kind) AS series, arg_max(mean, b) AS value
        FROM (SELECT evaluated, hostname, kind, time_bucket(INTERVAL '1 hour', time) AS b,
                avg(score) AS mean FROM acell GROUP BY ALL)
        GROUP BY ALL""")
PARTS["signal"] = (("acell", "ucell", "trend"), """
        SELECT 'any_host' AS rule, hostname AS series, evaluated, max(score) AS value FROM acell
        GROUP BY ALL
        UNION ALL SELECT concat('trend_', hostname), series, evaluated, value FROM trend
        WHERE hostname IN ('web1', 'web2', 'web3')
        UNION ALL SELECT 'max_score', '', evaluated, max(score) FROM acell GROUP BY ALL
        UNION ALL SELECT 'top_error_path', '', evaluated, CAST(max(n) AS DOUBLE) FROM (
          SELECT evaluated, hostname, path, status, sum(count) AS n FROM ucell
          WHERE status BETWEEN 400 AND 599 GROUP BY ALL) GROUP BY ALL
        UNION ALL SELECT 'total_5xx', '', evaluated, CAST(sum(count) AS DOUBLE) FROM ucell
        WHERE status BETWEEN 500 AND 599 GROUP BY ALL""")
PARTS["rules"] = ((), """
        SELECT * FROM (VALUES
          ('any_host', 'High anomaly score on any host', 1.0::DOUBLE, 60, NULL, NULL),
          ('trend_web1', 'Anomaly trend - Web1 (mean 5m) > 20', 0.9, 60, 'critical', 'web1'),
          ('trend_web2', 'Anomaly trend - Web2 (mean 5m) > 20', 0.9, 60, 'critical', 'web2'),
          ('trend_web3', 'Anomaly trend - Web3 (mean 5m) > 20', 0.9, 60, 'critical', 'web3'),
          ('max_score', 'Max anomaly score (last 10m) > 20', 1.0, 24, 'critical',
           'anomaly-gauge'),
          ('top_error_path', 'Top error path/host - error_count > 10', 1.0, 60, 'warning',
           'http-errors'),
          ('total_5xx', 'HTTP 5xx errors (sum last 10m) > 10', 6.0, 60, 'warning', 'http-5xx'))
        AS t(rule, title, threshold, hold_minutes, severity, component)""")

# Points of a table with versions: a replaced week, two days rewritten later, points that a
# replacement of their time makes invisible.
REPLACED = "time >= TIMESTAMP '2024-01-08' AND time < TIMESTAMP '2024-01-15'"
REWRITTEN = "time >= TIMESTAMP '2024-01-14' AND time < TIMESTAMP '2024-01-16'"
PARTS["vurls"] = (("urls_h",), f"""
        SELECT time, env, hostname, status, path, CAST(CASE WHEN {REWRITTEN} THEN count + 7
          WHEN {REPLACED} THEN count + 100 ELSE count END AS BIGINT) AS count FROM urls_h
        UNION ALL SELECT DISTINCT time, env, hostname, status, path || '?old', CAST(1 AS BIGINT)
        FROM urls_h WHERE NOT ({REPLACED})""")

PARTS["vcell"] = (("vurls",), covered("vurls", "time, hostname, path, status, count"))
PARTS["vsignal"] = (("vcell",), """
        SELECT 'top_error_path' AS rule, '' AS series, evaluated, CAST(max(n) AS DOUBLE) AS value FROM (
          SELECT evaluated, hostname, path, status, sum(count) AS n FROM vcell
          WHERE status BETWEEN 400 AND 599 GROUP BY ALL) GROUP BY ALL
        UNION ALL SELECT 'total_5xx', '', evaluated, CAST(sum(count) AS DOUBLE) FROM vcell
        WHERE status BETWEEN 500 AND 599 GROUP BY ALL""")


def alert_states_sql(rules: str, lo: str = "2024-01-01", first: str = "2024-01-01 01:00:00",
                     hi: str = "2024-02-01", source: str = "signal") -> str:
    """States at every hour in (lo, hi]; rules without a series report as the empty one."""
    inside = f"evaluated > TIMESTAMP '{lo}' AND evaluated <= TIMESTAMP '{hi}'"
    return f"""
        SELECT rule, title, severity, component, series, evaluated, value,
          CASE WHEN value IS NULL THEN 'NoData' WHEN NOT breach THEN 'Normal'
            WHEN date_diff('minute', since, evaluated) >= hold_minutes THEN 'Firing'
            ELSE 'Pending' END AS state
        FROM (SELECT *, max(CASE WHEN breach AND NOT before THEN evaluated END) OVER w AS since
          FROM (SELECT *, coalesce(lag(breach) OVER w, false) AS before
            FROM (SELECT r.*, s.series, g.evaluated, v.value, coalesce(v.value > threshold, false) AS breach
              FROM {rules} r
              JOIN (SELECT DISTINCT rule, series FROM {source} WHERE {inside}
                    UNION SELECT rule, '' FROM {rules}
                    WHERE rule IN ('max_score', 'top_error_path', 'total_5xx')
                      OR rule NOT IN (SELECT rule FROM {source} WHERE {inside})) s USING (rule)
              CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{first}',
                TIMESTAMP '{hi}', INTERVAL '1 hour')) AS evaluated) g
              LEFT JOIN {source} v ON v.rule = r.rule AND v.series = s.series AND v.evaluated = g.evaluated)
            WINDOW w AS (PARTITION BY rule, series ORDER BY evaluated))
          WINDOW w AS (PARTITION BY rule, series ORDER BY evaluated))"""


WHOLE = "time >= TIMESTAMP '2024-01-01' AND time < TIMESTAMP '2024-02-01'"


def trend_sql(field: str, source: str = "stats", every: str = "5 minutes") -> str:
    return (f"SELECT {window_end(every, 'time')} AS time, env, hostname, method, "
            f"round(avg({field}), 12) AS {field} FROM {source} GROUP BY ALL")


SPLIT_GROUPS = (
    r'^(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) \[(\w+)\] \d+#\d+: \*(\d+) (.*?)'
    r'(?:, client: ([^,]+))?(?:, server: ([^,]*))?(?:, request: "([^"]+)")?'
    r'(?:, upstream: "([^"]+)")?(?:, host: "([^"]+)")?(?:, referrer: "([^"]+)")?$'
)


def split_field(i: int) -> str:
    """Field i alone: DuckDB extracts nine groups at most, so the others do not capture."""
    pieces = re.split(r"\((?!\?)", SPLIT_GROUPS)
    pattern = pieces[0] + "".join(
        ("(" if n == i else "(?:") + piece for n, piece in enumerate(pieces[1:], 1)
    )
    return f"regexp_extract(line, '{pattern}', 1)"


PARTS["split"] = (("err",), f"""
        SELECT {split_field(1)} AS time, {split_field(2)} AS level,
          CAST({split_field(3)} AS BIGINT) AS cid, {split_field(4)} AS message,
          {split_field(5)} AS client, {split_field(6)} AS server, {split_field(7)} AS request,
          {split_field(8)} AS upstream, {split_field(9)} AS host, {split_field(10)} AS referrer,
          strptime({split_field(1)}, '%Y/%m/%d %H:%M:%S') AS event_time
        FROM err""")

# Query name: (subqueries it reads, final SELECT).
FINAL: dict[str, tuple[tuple[str, ...], str]] = {
    "access_json_decoded": (("acc",), """
        SELECT strftime(event_time, '%Y-%m-%dT%H:%M:%S+00:00') AS time,
          epoch_us(event_time) / CAST(1e6 AS DOUBLE) AS ts, remote, hostname, method, path,
          status, bytes, rt FROM acc"""),
    "access_normalized": (("acc",), """
        SELECT date_trunc('second', event_time) AS event_time, hostname, method, path, status,
          CASE WHEN status BETWEEN 200 AND 299 THEN '2xx' WHEN status BETWEEN 300 AND 399
            THEN '3xx' WHEN status BETWEEN 400 AND 499 THEN '4xx'
            WHEN status BETWEEN 500 AND 599 THEN '5xx' ELSE 'other' END AS status_class,
          remote, bytes, rt FROM acc"""),
    "access_event_time": (("evk",), """
        SELECT CASE k % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'bad text' ELSE 'no text' END AS source,
          date_trunc('second', ts) AS event_time FROM evk"""),
    "status_class_counts": (("acc",), """
        SELECT concat(CAST(status // 100 AS VARCHAR), 'xx') AS status_class, count(*) AS requests
        FROM acc GROUP BY ALL"""),
    "route_counts": (("evk",), """
        SELECT log_type, CASE log_type WHEN 'error' THEN 'error' ELSE 'access' END AS target,
          count(*) AS lines FROM (
          SELECT CASE event_id % 7 WHEN 0 THEN 'none' WHEN 1 THEN 'audit' ELSE 'access' END
            AS log_type FROM evk
          UNION ALL SELECT 'error' FROM evk WHERE event_type = 'error') GROUP BY ALL"""),
    "host_tagged": (("acc",), """
        SELECT hostname, count(*) AS lines FROM (
          SELECT hostname FROM acc
          UNION ALL SELECT nullif(hostname, 'web3') FROM acc WHERE status >= 500)
        GROUP BY ALL"""),
    "dead_letters": ((), """
        SELECT 'access' AS source, CAST(count(*) FILTER (ts IS NULL) AS BIGINT) AS undated
        FROM events UNION ALL SELECT 'prose', count(*) FROM documents"""),
    "error_parsed": (("parsed",), "SELECT hostname, event_time, level, message FROM parsed"),
    "error_message_class": (("classed",), """
        SELECT message_class, count(*) AS lines FROM classed GROUP BY ALL"""),
    "error_fields": (("split",), "SELECT * FROM split"),
    "error_rows_json": (("classed",), """
        SELECT concat('{"hostname":"', hostname, '","event_time":"',
          strftime(event_time, '%Y-%m-%dT%H:%M:%S.000Z'), '","level":"', level,
          '","message":', CAST(to_json(message) AS VARCHAR), ',"message_class":"',
          message_class, '"}') AS json FROM classed"""),
    "http_stats": (("acc",), stats_sql("1 hour")),
    "http_stats_10s": (("acc",), stats_sql("10 seconds")),
    "http_stats_from_json": (("acc",), stats_sql("1 hour")),
    "http_stats_by_class": (("acc",), stats_sql(
        "1 hour", "(SELECT *, concat(CAST(status // 100 AS VARCHAR), 'xx') AS status_class "
        "FROM acc)", "hostname, method, status_class")),
    "top_urls": (("acc",), urls_sql("1 hour")),
    "error_events": (("classed",), error_events_sql("1 hour")),
    "anomaly_ip_spike": (("acc",), spikes_sql("1 day", 6)),
    "anomaly_error_surge": (("acc",), surges_sql("1 hour", 0.3)),
    "anomaly_scan": (("acc",), scans_sql("1 day", 5)),
    "all_anomalies": (("acc",), anomalies_sql("1 day", 6, 5, 0.2)),
    "line_protocol": (("stats_h", "urls_h", "errp_h"), " UNION ALL ".join([
        line_sql("stats_h", "http_stats", ("env", "hostname", "method"), {
            "count": count_text("count"), **{f: f"CAST({f} AS VARCHAR)" for f in STATS_FIELDS[1:]},
        }),
        line_sql("urls_h", "top_urls", ("env", "hostname", "status", "path"),
                 {"count": count_text("count")}),
        line_sql("errp_h", "error_events", ("env", "hostname", "level", "message_class"),
                 {"count": count_text("count")}),
    ])),
    "anomaly_lines": (("anom",), line_sql("anom", "anomaly", ("env", "hostname", "kind"), {
        "ip": "'\"', ip, '\"'", "count": count_text("count"), "score": "CAST(score AS VARCHAR)",
        "window_s": count_text("window_s"),
    })),
    "http_stats_long": (("stats_h",), long_sql(
        "stats_h", "time, env, hostname, method", STATS_FIELDS)),
    "http_stats_pivot": (("stats_h",), """
        SELECT time, env, hostname, method, CAST(count AS DOUBLE) AS count, rps, avg_rt, max_rt,
          err_rate FROM stats_h"""),
    "latency_pivot": (("stats_h",), """
        SELECT time, env, hostname, method, avg_rt, max_rt FROM stats_h"""),
    "error_events_pivot": (("errp_h",), """
        SELECT time, env, hostname, level, message_class, CAST(count AS DOUBLE) AS count
        FROM errp_h"""),
    "anomaly_pivot": (("anom",), """
        SELECT time, env, hostname, kind, ip, CAST(count AS DOUBLE) AS count, score,
          CAST(window_s AS DOUBLE) AS window_s FROM anom"""),
    "latest_wins_view": (("urls_h",), "SELECT * FROM urls_h"),
    "retention": (("stats_h",), """
        SELECT * FROM stats_h WHERE time >= TIMESTAMP '2024-01-31' - INTERVAL '168 hours'"""),
    "range_scan": (("stats",), """
        SELECT * FROM stats
        WHERE time >= TIMESTAMP '2024-01-08' AND time < TIMESTAMP '2024-01-15'"""),
    "measurement_names": (("series",), "SELECT DISTINCT measurement FROM series"),
    "err_rate_mean": (("stats",), f"""
        SELECT env, hostname, method, round(avg(err_rate), 12) AS err_rate FROM stats
        WHERE {WHOLE} GROUP BY ALL"""),
    "requests_by_host": (("stats",), """
        SELECT hostname, CAST(sum(count) AS BIGINT) AS requests FROM stats GROUP BY ALL"""),
    "requests_by_method": (("stats",), """
        SELECT method, CAST(sum(count) AS BIGINT) AS requests FROM stats GROUP BY ALL"""),
    "avg_rt_5m": (("stats",), trend_sql("avg_rt")),
    "max_rt_5m": (("stats",), trend_sql("max_rt")),
    "err_rate_5m": (("stats",), trend_sql("err_rate")),
    "rps_5m": (("stats",), trend_sql("rps")),
    "avg_rt_1d": (("stats_h",), trend_sql("avg_rt", "stats_h", "1 day")),
    "latency_p95": (("stats",), """
        SELECT env, hostname, method, 'avg_rt' AS metric, quantile_disc(avg_rt, 0.95) AS quantile
        FROM stats GROUP BY ALL
        UNION ALL SELECT env, hostname, method, 'max_rt', quantile_disc(max_rt, 0.95)
        FROM stats GROUP BY ALL"""),
    "latency_p95_per_window": (("acc",), f"""
        SELECT {window_end('1 day')} AS time, hostname, quantile_disc(rt, 0.95) AS rt
        FROM acc GROUP BY ALL"""),
    "latency_breaches": (("stats",), """
        SELECT time, env, hostname, method, avg_rt FROM stats WHERE avg_rt > 0.2"""),
    "requests_by_status": (("urls",), f"""
        SELECT status, CAST(sum(count) AS BIGINT) AS requests FROM urls WHERE {WHOLE}
        GROUP BY ALL"""),
    "top5_error_hosts": (("urls",), f"""
        SELECT hostname, CAST(sum(count) AS BIGINT) AS errors FROM urls
        WHERE {WHOLE} AND status >= 400 GROUP BY ALL ORDER BY errors DESC, hostname LIMIT 5"""),
    "top10_errors": (("urls",), f"""
        SELECT concat(CAST(status AS VARCHAR), ' | ', hostname, ' | ', path) AS label,
          CAST(sum(count) AS BIGINT) AS errors FROM urls WHERE {WHOLE} AND status >= 400
        GROUP BY ALL ORDER BY errors DESC, label LIMIT 10"""),
    "top10_urls": (("urls",), f"""
        SELECT concat(hostname, ' | ', path) AS label, CAST(sum(count) AS BIGINT) AS requests
        FROM urls WHERE {WHOLE} GROUP BY ALL ORDER BY requests DESC, label LIMIT 10"""),
    "top10_urls_by_status": (("urls",), """
        SELECT hostname, path, status, CAST(sum(count) AS BIGINT) AS requests FROM urls
        GROUP BY ALL ORDER BY requests DESC, hostname, path, status LIMIT 10"""),
    "top10_error_urls_by_status": (("urls",), """
        SELECT hostname, path, status, CAST(sum(count) AS BIGINT) AS requests FROM urls
        WHERE status >= 400 GROUP BY ALL
        ORDER BY requests DESC, hostname, path, status LIMIT 10"""),
    "error_urls": (("urls",), """
        SELECT concat(hostname, ' | ', path) AS page, status,
          CAST(sum(count) AS BIGINT) AS error_count FROM urls WHERE status >= 400
        GROUP BY ALL ORDER BY error_count DESC, page, status"""),
    "error_status_distribution": (("urls",), """
        SELECT status, CAST(sum(count) AS BIGINT) AS error_count,
          round(CAST(sum(count) AS DOUBLE) * 100.0
            / CAST(sum(sum(count)) OVER () AS DOUBLE), 12) AS share
        FROM urls WHERE status >= 400 GROUP BY status"""),
    "top_urls_per_window": (("urls_d",), """
        SELECT time, hostname, status, path, count FROM urls_d
        QUALIFY row_number() OVER (PARTITION BY time, hostname, status
          ORDER BY count DESC, path) <= 3"""),
    "top_ips": (("acc",), """
        SELECT remote, count(*) AS requests, count(DISTINCT path) AS paths FROM acc
        WHERE status BETWEEN 400 AND 499 GROUP BY ALL ORDER BY requests DESC, remote LIMIT 10"""),
    "anomaly_score_trend": (("anom",), f"""
        SELECT {window_end('1 day', 'time')} AS time, concat(hostname, ' | ', kind) AS series,
          round(avg(score), 12) AS score FROM anom GROUP BY ALL"""),
    "anomaly_score_trend_web1": (("anom",), f"""
        SELECT {window_end('1 day', 'time')} AS time, concat(hostname, ' | ', kind) AS series,
          round(avg(score), 12) AS score FROM anom WHERE hostname = 'web1' GROUP BY ALL"""),
    "max_score": (("anom",), "SELECT max(score) AS score FROM anom"),
    "max_score_by_host": (("anom",), """
        SELECT hostname, min(time) AS time, score FROM anom
        WHERE (hostname, score) IN (SELECT hostname, max(score) FROM anom GROUP BY hostname)
        GROUP BY hostname, score"""),
    "anomaly_high_score": (("anom",), """
        SELECT time, env, hostname, kind, ip, score FROM anom WHERE score > 0.7"""),
    "top_scan_ips": (("anom",), """
        SELECT ip, max(score) AS score, count(*) AS windows FROM anom WHERE kind = 'scan'
        GROUP BY ip ORDER BY score DESC, windows DESC, ip LIMIT 10"""),
    "error_trend_filled": (("errp",), f"""
        SELECT grid.b + INTERVAL '5 minutes' AS time, grid.env, grid.level,
          concat(grid.hostname, ' / ', grid.message_class) AS series,
          coalesce(sums.value, CAST(0 AS DOUBLE)) AS value
        FROM (SELECT * FROM (SELECT DISTINCT env, hostname, level, message_class FROM errp
                WHERE {WHOLE}),
              (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01',
                INTERVAL '5 minutes')) AS b)) grid
        LEFT JOIN (SELECT env, hostname, level, message_class,
              time_bucket(INTERVAL '5 minutes', time) AS b, CAST(sum(count) AS DOUBLE) AS value
              FROM errp WHERE {WHOLE} GROUP BY ALL) sums
          USING (env, hostname, level, message_class, b)"""),
    "errors_by_class": (("errp",), """
        SELECT message_class, CAST(sum(count) AS BIGINT) AS total_errors FROM errp
        GROUP BY ALL"""),
    "errors_by_host_level": (("errp",), """
        SELECT hostname, level, CAST(sum(count) AS BIGINT) AS total_errors FROM errp
        GROUP BY ALL"""),
    "errors_by_level": (("classed",), f"""
        SELECT {window_end('1 hour')} AS window_end, level, count(*) AS count FROM classed
        GROUP BY ALL"""),
    "error_share_by_host": (("errp",), """
        SELECT hostname, CAST(sum(count) AS BIGINT) AS total_errors,
          round(CAST(sum(count) AS DOUBLE) * 100.0
            / CAST(sum(sum(count)) OVER () AS DOUBLE), 12) AS share
        FROM errp GROUP BY hostname"""),
    "error_summary": (("errp",), """
        SELECT concat(hostname, ' / ', message_class) AS detail,
          CAST(sum(count) AS BIGINT) AS total FROM errp GROUP BY ALL
        ORDER BY total DESC, detail"""),
    "last5_error_events": (("errp",), """
        SELECT time, concat(hostname, ' | ', level, ' | ', message_class) AS detail FROM errp
        ORDER BY time DESC, detail LIMIT 5"""),
    "last5_error_events_per_series": (("errp",), """
        SELECT time, env, concat(hostname, ' | ', level, ' | ', message_class) AS detail
        FROM errp QUALIFY row_number() OVER (PARTITION BY env, hostname, level, message_class
          ORDER BY time DESC) <= 5"""),
    "latest_errors": (("errp",), """
        SELECT time, env, hostname, level, message_class, count FROM errp WHERE level = 'error'
        ORDER BY time DESC, hostname, message_class"""),
    "error_by_upstream": (("split",), f"""
        SELECT {window_end('1 day')} AS window_end, host AS hostname, level, upstream,
          count(*) AS count FROM split GROUP BY ALL"""),
    "top_upstreams": (("split",), """
        SELECT upstream, count(*) AS errors FROM split GROUP BY ALL
        ORDER BY errors DESC, upstream LIMIT 10"""),
    "error_samples": (("classed",), f"""
        SELECT {window_end('1 day')} AS window_end, hostname, level, message_class, event_time,
          message FROM classed
        QUALIFY row_number() OVER (PARTITION BY window_end, hostname, level, message_class
          ORDER BY event_time, message) <= 5"""),
    "latest_points": (("series",), """
        SELECT * FROM series ORDER BY time DESC, measurement, series, field LIMIT 10"""),
    "measurement_samples": (("series",), """
        SELECT * FROM series QUALIFY row_number() OVER (
          PARTITION BY measurement, series, field ORDER BY time) <= 5"""),
    "overview_samples": (("series",), """
        SELECT * FROM series QUALIFY row_number() OVER (
          PARTITION BY measurement, series, field ORDER BY time) <= 10"""),
    "series_counts": (("series",), """
        SELECT measurement, series, field, count(value) AS records FROM series GROUP BY ALL"""),
    "record_counts": (("series",), """
        SELECT measurement, count(*) AS records FROM series GROUP BY ALL"""),
    "alert_breaches": (("signal", "rules"), """
        SELECT rule, series, evaluated, value FROM signal JOIN rules USING (rule)
        WHERE value > threshold"""),
    "alert_states": (("signal", "rules"), alert_states_sql("rules")),
    "alert_states_absent_host": (("signal", "rules"), alert_states_sql("""
        (SELECT * FROM rules WHERE rule = 'trend_web1' UNION ALL
         SELECT * REPLACE ('trend_web9' AS rule) FROM rules WHERE rule = 'trend_web1')""")),
    "alert_states_empty_range": (("signal", "rules"), alert_states_sql(
        "rules", "2024-02-05 00:00:00", "2024-02-05 01:00:00", "2024-02-06 00:00:00")),
    "alert_states_from_versions": (("vsignal", "rules"), alert_states_sql(
        "(SELECT * FROM rules WHERE rule IN ('top_error_path', 'total_5xx'))", source="vsignal")),
    "latest_wins_generations": (("vurls",), "SELECT * FROM vurls"),
    "latency_p95_sketch": (("acc",), f"""
        SELECT {window_end('1 day')} AS time, hostname, count(*) AS requests, true AS close
        FROM acc GROUP BY ALL"""),
    "clients_by_sketch": (("acc",), f"""
        SELECT {window_end('1 day')} AS time, hostname, count(DISTINCT remote) AS clients, true AS close
        FROM acc GROUP BY ALL"""),
}


def needed(names: tuple[str, ...], seen: list[str] | None = None) -> list[str]:
    """Subqueries to define, each after the ones it reads."""
    seen = [] if seen is None else seen
    for name in names:
        if name not in seen:
            needed(PARTS[name][0], seen)
            seen.append(name)
    return seen


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (reads, select) in FINAL.items():
        parts = [f"{p} AS ({PARTS[p][1]})" for p in needed(reads)]
        out[name] = (f"WITH {', '.join(parts)} " if parts else "") + select.strip()
    return out
