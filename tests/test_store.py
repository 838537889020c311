"""The commit log of metric tables: replacements, attempts, upkeep."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom import submit
from logloom.config import Settings, Thresholds
from logloom.operators.points import ANOMALY, ERROR_EVENTS, HTTP_STATS, TOP_URLS
from logloom.sources import metric_store
from logloom.sources.commits import CommitLog, Replacement, segments
from logloom.streaming import jobs, sinks
from tests.conftest import rows
from tests.samples import at, request

URLS = "time timestamp, env string, hostname string, status int, path string, count bigint"
T0 = datetime(2025, 1, 1)
DAY = ("2025-01-01", "2025-01-02")


def micros(time):
    return int((time - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def windows(spark, counts, start=T0):
    """Output rows of the URL metric: one window every ten minutes."""
    schema = "window_end timestamp, hostname string, status int, path string, count bigint"
    return spark.createDataFrame(
        [(start + timedelta(minutes=10 * i), "web1", 200, "/x", n) for i, n in enumerate(counts) if n is not None], schema)


def points(spark, counts, start=T0):
    return windows(spark, counts, start).select(
        F.col("window_end").alias("time"), F.lit("dev").alias("env"), "hostname", "status", "path", "count")


def current(spark, store, days=DAY):
    got = metric_store.read_points(spark, store, TOP_URLS, *days)
    return {(r.time - T0) // timedelta(minutes=10): r["count"] for r in got.collect()}


def test_segments_keep_the_newest():
    parts = [Replacement(1, 0, 10), Replacement(2, 5, 8), Replacement(3, 10, 12), Replacement(4, 20, 21), Replacement(5, 20, 21)]
    assert segments(parts) == [(0, 5, 1), (5, 8, 2), (8, 10, 1), (10, 12, 3), (20, 21, 5)]
    assert segments([]) == []


def test_a_stream_wins_over_an_earlier_backfill(spark, tmp_path):
    """A window that was open during the backfill keeps what the stream says later."""
    store, ckpt = str(tmp_path / "store"), str(tmp_path / "ckpt")
    generation = metric_store.checkpoint_generation(spark, ckpt, store, TOP_URLS)
    write = sinks.store_writer(TOP_URLS, store, generation=generation)
    write(windows(spark, [3, 3]), 0)
    metric_store.replace_points(points(spark, [4, 4]), store, TOP_URLS, micros(T0), micros(T0) + 3_600_000_000)
    assert current(spark, store) == {0: 4, 1: 4}
    write(windows(spark, [None, 9]), 1)
    assert current(spark, store) == {0: 4, 1: 9}


def test_open_windows_are_left_to_the_stream(spark, tmp_path):
    store = str(tmp_path / "store")
    write = sinks.store_writer(TOP_URLS, store, generation=metric_store.checkpoint_generation(spark, str(tmp_path / "c"), store, TOP_URLS))
    write(windows(spark, [1, 1, 1, 1]), 0)
    write(windows(spark, [None, None, None, 2]), 1)
    metric_store.replace_points(points(spark, [7, 7, 7, 7]), store, TOP_URLS, micros(T0), micros(T0) + 7_200_000_000,
                                open_for="10 minutes + 5 minutes")
    assert current(spark, store) == {0: 7, 1: 7, 2: 1, 3: 2}
    assert metric_store.replace_points(points(spark, [8]), store, TOP_URLS, micros(T0 + timedelta(hours=1)),
                                       micros(T0 + timedelta(hours=2)), open_for="1 minute") is None


def test_a_backfill_replaces_what_it_does_not_produce(spark, tmp_path):
    store, settings = str(tmp_path / "store"), Settings(window="1 hour", thresholds=Thresholds(50, 2, 0.5))
    stale = [(T0 + timedelta(hours=h), "dev", "web1", "error_surge", "", 5, 0.9, 3600) for h in (1, 4)]
    schema = "time timestamp, env string, hostname string, kind string, ip string, count bigint, score double, window_s bigint"
    metric_store.append_points(spark.createDataFrame(stale, schema), store, ANOMALY)
    lines = [(request(at(s), path=f"/{s}"),) for s in range(3)]

    def kinds():
        got = metric_store.read_points(spark, store, ANOMALY, *DAY)
        return sorted((r.kind, r.time.hour) for r in got.collect())

    for _ in range(2):  # a rerun leaves the same points
        jobs.backfill_access(spark.createDataFrame(lines, "value string"), str(tmp_path / "staging"), store, settings)
        assert kinds() == [("error_surge", 4), ("scan", 1)]
        assert metric_store.read_points(spark, store, HTTP_STATS, *DAY, unique=True).agg(F.sum("count")).first()[0] == 3
    empty = spark.createDataFrame([], "value string")
    jobs.backfill_access(empty, str(tmp_path / "staging2"), store, settings)
    jobs.backfill_errors(empty, store, settings)
    assert kinds() == [("error_surge", 4), ("scan", 1)]
    assert metric_store.read_points(spark, store, ERROR_EVENTS, *DAY).count() == 0


def test_half_a_backfill_is_not_seen(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    metric_store.append_points(points(spark, [1, 1]), store, TOP_URLS)

    def fail(self, number, entry=None):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "publish", fail)
        with pytest.raises(OSError):
            metric_store.replace_points(points(spark, [5, 5]), store, TOP_URLS, micros(T0), micros(T0) + 1)
    assert current(spark, store) == {0: 1, 1: 1}
    second = metric_store.replace_points(points(spark, [6, 6]), store, TOP_URLS, micros(T0), micros(T0) + 1)
    assert second == 2 and current(spark, store) == {0: 6, 1: 1}
    assert CommitLog(spark, metric_store.table_path(store, TOP_URLS)).abandoned() == [1]
    assert metric_store.clean(spark, store, TOP_URLS, "0 seconds") == 1
    assert current(spark, store) == {0: 6, 1: 1}


def test_numbers_are_taken_once(spark, tmp_path):
    table = str(tmp_path / "t")
    one, other = CommitLog(spark, table), CommitLog(spark, table)
    assert [one.take(), other.take(), one.take()] == [1, 2, 3]
    other.publish(2)
    assert one.latest() == 2 and one.abandoned() == [1, 3] and one.replacements() == []
    with pytest.raises(Exception):
        one.publish(2)


def test_a_replayed_batch_writes_the_same_points(spark, tmp_path):
    store = str(tmp_path / "store")
    generation = metric_store.checkpoint_generation(spark, str(tmp_path / "c"), store, ERROR_EVENTS)
    frame = spark.createDataFrame(
        [(T0, "h", "error", "other", 2)],
        "window_end timestamp, hostname string, level string, message_class string, count bigint")
    for _ in range(2):  # a new writer each time, as after a restart
        write = sinks.store_writer(ERROR_EVENTS, store, time_source="processing_time", generation=generation)
        write(frame, 0)
    write(frame, 1)
    got = metric_store.read_versions(spark, store, ERROR_EVENTS)
    assert got.count() == 3 and got.select("time").distinct().count() == 2
    # A replay after a backfill of its closed window does not win over the backfill.
    urls = metric_store.checkpoint_generation(spark, str(tmp_path / "u"), store, TOP_URLS)
    sinks.store_writer(TOP_URLS, store, generation=urls)(windows(spark, [3]), 0)
    metric_store.replace_points(points(spark, [4]), store, TOP_URLS, micros(T0), micros(T0) + 1)
    sinks.store_writer(TOP_URLS, store, generation=urls)(windows(spark, [3]), 0)
    assert current(spark, store) == {0: 4}


def test_dates_with_many_files_are_compacted(spark, tmp_path):
    store, table = str(tmp_path / "store"), tmp_path / "store" / "top_urls"
    write = sinks.store_writer(TOP_URLS, store, files=1, generation=metric_store.checkpoint_generation(
        spark, str(tmp_path / "c"), store, TOP_URLS))
    for batch in range(6):
        write(windows(spark, [batch, batch + 10]), batch)
    write(windows(spark, [1], T0 + timedelta(days=2)), 6)
    write(windows(spark, [2], T0 + timedelta(days=2)), 7)
    before = current(spark, store)
    assert metric_store.compact_dates(spark, store, TOP_URLS, 3) == ["2025-01-01"]
    assert current(spark, store) == before == {0: 5, 1: 15}
    assert metric_store.compact_dates(spark, store, TOP_URLS, 3) == []
    assert len(list((table / "date=2025-01-01").glob("*.parquet"))) == 6
    assert metric_store.clean(spark, store, TOP_URLS, "1 day") == 0
    assert metric_store.clean(spark, store, TOP_URLS, "0 seconds") == 6
    assert current(spark, store) == before
    assert len(list((table / "_base").rglob("*.parquet"))) <= 2
    # A late rewrite of the compacted date still wins, and a later compaction takes it in.
    write(windows(spark, [50]), 8)
    assert current(spark, store) == {0: 50, 1: 15}
    assert metric_store.compact_dates(spark, store, TOP_URLS, 0, "1 minute") == ["2025-01-01"]
    assert metric_store.clean(spark, store, TOP_URLS, "0 seconds") == 2
    assert current(spark, store) == {0: 50, 1: 15}
    unique = metric_store.read_points(spark, store, TOP_URLS, *DAY, unique=True)
    assert sorted(r["count"] for r in unique.collect()) == [15, 50]
    assert metric_store.expire(spark, store, TOP_URLS, "2025-02-01", 7) == ["2025-01-01", "2025-01-03"]
    assert current(spark, store, ("2025-01-01", "2025-02-01")) == {}


def test_replaced_points_do_not_reach_the_alert_stream(spark, tmp_path):
    store = str(tmp_path / "store")
    metric_store.append_points(points(spark, [1, 2]), store, TOP_URLS)
    metric_store.replace_points(points(spark, [9, 9]), store, TOP_URLS, micros(T0), micros(T0) + 3_600_000_000)
    out = str(tmp_path / "out")
    stream = metric_store.stream_points(spark, store, TOP_URLS)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(
        availableNow=True).start().awaitTermination()
    assert sorted(r["count"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_ranges_still_prune(spark, tmp_path):
    store = str(tmp_path / "store")
    metric_store.append_points(points(spark, [1, 2]), store, TOP_URLS)
    metric_store.replace_points(points(spark, [9]), store, TOP_URLS, micros(T0), micros(T0) + 1)
    got = metric_store.read_points(spark, store, TOP_URLS, *DAY)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(date") == 2


def test_new_commands():
    read = submit.parser().parse_args
    args = read(["compact", "--store", "/s", "--most-files", "4"])
    assert (args.command, args.most_files, args.grace) == ("compact", 4, "1 day")
    args = read(["errors", "--store", "/s", "--sink", "remote", "--time-source", "processing_time"])
    assert (args.sink, args.time_source) == ("remote", "processing_time")
    assert read(["samples", "--target", "/t"]).target == read(["dead-letters", "--target", "/t"]).target == "/t"
    assert read(["expire", "--store", "/s", "--now", "2025-01-01", "--keep-days", "7", "--rows", "/t"]).rows == ["/t"]
