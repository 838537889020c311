from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logloom import submit
from logloom.config import Settings, Thresholds
from logloom.operators import alerts, sketches
from logloom.operators.points import ANOMALY, HTTP_STATS, MEASUREMENTS, TOP_URLS
from logloom.plans import catalog, dashboards
from logloom.sources import metric_store
from logloom.sources.eventlog import access_json, error_lines
from logloom.streaming import jobs, sinks, staging
from tests.conftest import SMALL, rows

SETTINGS = Settings(window="1 hour", thresholds=Thresholds(2, 2, 0.3))
START, STOP = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def backfilled(events, tmp_path):
    store = str(tmp_path / "store")
    jobs.backfill_access(access_json(events), str(tmp_path / "staging"), store, SETTINGS)
    raw = error_lines(events).withColumnRenamed("line", "value")
    jobs.backfill_errors(raw, store, SETTINGS)
    return store


def test_backfill_and_every_dashboard(spark, events, tmp_path):
    store = backfilled(events, tmp_path)
    tables = {
        m.name: metric_store.read_points(spark, store, m, START, STOP, unique=True)
        for m in MEASUREMENTS
    }
    merged = metric_store.read_points(spark, store, TOP_URLS, START, STOP)
    assert rows(merged) == rows(tables["top_urls"])
    assert tables["http_stats"].agg(F.sum("count")).first()[0] == events.count()
    http = dashboards.http_panels(tables["http_stats"], START, STOP)
    anomaly = dashboards.anomaly_panels(tables["anomaly"], tables["top_urls"], START, STOP)
    urls = dashboards.url_panels(tables["top_urls"], STOP, "31 days")
    errors = dashboards.error_panels(tables["error_events"], START, STOP, "1 day")
    assert len(http) == 7 and len(anomaly) == 7 and len(urls) == 4 and len(errors) == 5
    for name, frame in {**http, **anomaly, **urls, **errors}.items():
        assert frame.count() > 0, name
    checks = dashboards.store_checks(tables, "2024-01-30 12:00:00")
    assert checks["available_measurements"].count() == 4
    assert set(checks) == {"available_measurements", "latest_data", "http_stats_sample",
                           "top_urls_sample", "anomaly_sample", "record_counts",
                           "overview_samples", "series_counts"}
    assert checks["latest_data"].count() > 0
    book = dashboards.runbook(tables, "2024-01-30 12:00:01")
    for name, frame in book.items():
        assert frame.columns, name
    assert book["top_urls"].count() > 0


def test_alert_job_on_stored_points(spark, tmp_path):
    store, start = str(tmp_path / "store"), datetime(2025, 1, 1)
    schema = ("time timestamp, env string, hostname string, kind string, ip string, "
              "count bigint, score double, window_s bigint")

    def put(minutes, score, batch):
        frame = spark.createDataFrame([(
            start + timedelta(minutes=m), "dev", "web1", "ip_spike", "1.1.1.1", 9, score, 10,
        ) for m in minutes], schema)
        metric_store.append_points(frame, store, ANOMALY, batch, files=1)

    rule = [r for r in alerts.RULES if r.name == "max_score"]

    def go():
        for q in jobs.start_alerts(spark, store, str(tmp_path / "alerts"),
                                   str(tmp_path / "ckpt"), rule, availableNow=True):
            q.awaitTermination()
        got = spark.read.parquet(str(tmp_path / "alerts" / "anomaly"))
        return [(r.evaluated.minute, r.state) for r in got.orderBy("evaluated").collect()]

    put((1, 6, 11), 30.0, 0)
    put((30,), 1.0, 1)
    first = go()
    assert first[:3] == [(5, "Pending"), (10, "Firing"), (15, "Firing")]
    put((31, 33, 90), 1.0, 2)
    assert len(go()) > len(first)


def test_sketches_of_a_stream_merge(spark, events, tmp_path):
    """Sketches of small windows, written by a stream, against exact values of the whole."""
    lines, store = str(tmp_path / "lines"), str(tmp_path / "store")
    access_json(events).select("value").repartition(3).write.text(lines)
    access = jobs.access_rows(spark.readStream.text(lines))
    metrics = {sketches.SKETCHES: sketches.sketch_rollup(access, "10 minutes")}
    for q in jobs.start_metrics(metrics, lambda m: sinks.store_writer(m, store), str(tmp_path / "ckpt"), availableNow=True):
        q.awaitTermination()
    read = metric_store.read_points(spark, store, sketches.SKETCHES, START, STOP)
    exact = {}
    for r in jobs.access_rows(access_json(events)).select("hostname", "rt", "remote").collect():
        exact.setdefault(r.hostname, []).append((r.rt, r.remote))
    merged = sketches.merge(read, ["hostname"])
    got = merged.select("hostname", "count", *[sketches.response_time(q).alias(f"q{q}") for q in (0.5, 0.95)],
                        sketches.clients().alias("clients")).collect()
    assert {r.hostname for r in got} == set(exact)
    for r in got:
        times = sorted(rt for rt, _ in exact[r.hostname])
        assert r["count"] == len(times)
        assert abs(r.clients - len({ip for _, ip in exact[r.hostname]})) <= sketches.COUNT_ERROR * r.clients + 1
        for q in (0.5, 0.95):
            low = sum(t < r[f"q{q}"] for t in times) / len(times)
            high = sum(t <= r[f"q{q}"] for t in times) / len(times)
            assert low - sketches.RANK_ERROR <= q <= high + sketches.RANK_ERROR
    days = sketches.merge(read, ["hostname"], "1 day")
    assert days.agg(F.sum("count")).first()[0] == events.count()
    assert days.groupBy("time", "hostname").count().where("count > 1").isEmpty()


def test_one_ingest_feeds_the_metrics(spark, events, tmp_path):
    lines, store = str(tmp_path / "lines"), str(tmp_path / "store")
    access_json(events).select("value").repartition(3).write.text(lines)
    raw = spark.readStream.text(lines)
    settings = Settings(window="1 hour", thresholds=Thresholds(2, 2, 0.3))
    staged, checkpoints = str(tmp_path / "rows"), str(tmp_path / "ckpt")
    followed = jobs.ingested(spark, staged)
    jobs.start_ingest(raw, staged, checkpoints, availableNow=True).awaitTermination()
    metrics = jobs.access_rollups(followed, settings, settings.path_error)
    one = {HTTP_STATS: metrics[HTTP_STATS]}
    for q in jobs.start_metrics(one, lambda m: sinks.store_writer(m, store, "dev", files=2),
                                checkpoints, availableNow=True):
        q.awaitTermination()
    got = metric_store.read_points(spark, store, HTTP_STATS, START, STOP)
    whole = backfilled(events, tmp_path / "batch")
    expected = metric_store.read_points(spark, whole, HTTP_STATS, START, STOP)
    columns = [c for c in got.columns if c != "avg_rt"]
    assert rows(got.select(columns)) == rows(expected.select(columns))


def test_staged_rows_go_when_all_have_read_them(spark, events, tmp_path):
    staged, checkpoints, store = tmp_path / "rows", str(tmp_path / "ckpt"), str(tmp_path / "store")
    settings = replace(SETTINGS, watermark="60 days")  # the parts overlap in time
    lines = access_json(events).select("value")
    for part in range(3):
        lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == part).coalesce(1).write.text(str(tmp_path / "lines" / str(part)))
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "lines" / "*"))
    jobs.start_ingest(raw, str(staged), checkpoints, availableNow=True).awaitTermination()
    left = lambda: sorted(p.name for p in staged.glob("batch=*"))
    assert left() == [f"batch={i:012d}" for i in range(3)]
    listener = staging.StagedRows(spark, str(staged), ["http_stats", "top_urls"])

    def go(m):
        followed = jobs.ingested(spark, str(staged), files_per_trigger=1)
        metrics = {m: jobs.access_rollups(followed, settings, None)[m]}
        for q in jobs.start_metrics(metrics, lambda m: sinks.store_writer(m, store), checkpoints, availableNow=True):
            q.awaitTermination()
            return [n for p in q.recentProgress for n in listener.heard(json.loads(p.json))]

    assert go(HTTP_STATS) == [] and len(left()) == 3
    assert go(TOP_URLS) == [0, 1] and left() == [f"batch={2:012d}"]
    # Replays and restarts go on with what is left; nothing is counted twice.
    jobs.start_ingest(raw, str(staged), checkpoints, availableNow=True).awaitTermination()
    go(HTTP_STATS)
    for m in (HTTP_STATS, TOP_URLS):
        assert metric_store.read_points(spark, store, m, START, STOP).agg(F.sum("count")).first()[0] == events.count()
    frame = jobs.access_rows(lines.limit(2))
    write = staging.stage_batches(str(tmp_path / "again"))
    for _ in range(2):
        write(frame, 7)
    assert spark.read.parquet(str(tmp_path / "again")).count() == 2
    assert staging.remove_read(spark, str(tmp_path / "again"), 8, 3_600_000_000) == []
    assert staging.remove_read(spark, str(tmp_path / "again"), 8) == [7]
    assert staging.remove_read(spark, str(tmp_path / "none"), 8) == []


def test_files_per_date_are_bounded(spark, events, tmp_path):
    store = str(tmp_path / "store")
    points = spark.range(500).selectExpr(
        "timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,id % 2) AS time", "'dev' AS env",
        "concat('h', id) AS hostname", "200 AS status", "'/' AS path", "id AS count")
    metric_store.append_points(points.repartition(40), store, TOP_URLS, files=3)
    for date in ("2025-01-01", "2025-01-02"):
        assert 1 <= len(list((tmp_path / "store" / "top_urls" / f"date={date}").glob("*.parquet"))) <= 3


def test_expired_dates_go(spark, tmp_path):
    store = str(tmp_path / "store")
    points = spark.range(4).selectExpr(
        "timestamp'2025-01-01 06:00:00' + make_interval(0,0,0,id) AS time", "'dev' AS env",
        "'h' AS hostname", "200 AS status", "'/' AS path", "id AS count")
    metric_store.append_points(points, store, TOP_URLS)
    assert metric_store.expire(spark, store, ANOMALY, "2025-01-05 00:00:00", 2) == []
    gone = metric_store.expire(spark, store, TOP_URLS, "2025-01-05 00:00:00", 2)
    assert gone == ["2025-01-01", "2025-01-02"]
    left = metric_store.read_points(spark, store, TOP_URLS, "2025-01-01", "2025-02-01")
    assert sorted(r["count"] for r in left.collect()) == [2, 3]


def test_submit_lines():
    args = submit.parser().parse_args(["access", "--store", "/s", "--mode", "append"])
    assert (args.command, args.store, args.mode) == ("access", "/s", "append")
    args = submit.parser().parse_args(["expire", "--store", "/s", "--now", "2025-01-01",
                                       "--keep-days", "7"])
    assert args.keep_days == 7


def test_ranges_reach_the_scan(spark):
    for name in ("range_scan", "top10_urls", "err_rate_mean"):
        plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan, name
    plan = catalog.queries()["retention"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan
