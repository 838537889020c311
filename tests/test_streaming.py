from __future__ import annotations

import glob
import os
import urllib.error
import uuid
from dataclasses import replace
from datetime import datetime, timedelta
from itertools import count

import pytest
from pyspark.sql import functions as F

from logloom.config import Settings, Thresholds
from logloom.operators import alerts as batch_alerts
from logloom.operators.errors import error_json
from logloom.operators.points import ANOMALY, ERROR_EVENTS, HTTP_STATS, TOP_URLS, to_points
from logloom.session import checkpoint_root
from logloom.plans import reports
from logloom.sources import logs, metric_store
from logloom.sources.eventlog import access_json, error_lines
from logloom.sources.logs import LogSource
from logloom.streaming import alerts, jobs, monitor, sinks
from tests.conftest import rows
from tests.samples import NO_SERVER, NOTICE, REFUSED, at, request

CLOCK = count()
ONCE = {"availableNow": True}
SETTINGS = Settings(window="1 hour", thresholds=Thresholds(2, 2, 0.3))
END = "2030-01-01T00:00:00+00:00"


def put(folder, name, lines):
    """A log file; later ones have later times, which is the order streams read them in."""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    stamp = 1_700_000_000 + next(CLOCK)
    os.utime(folder / name, (stamp, stamp))


def stream(spark, folder, **options):
    return logs.open_stream(spark, LogSource("text", str(folder), **options))


def drain(queries):
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None


def run(frame, tmp_path, name, mode="append"):
    """All rows a stream emits, through Parquet files."""
    out = str(tmp_path / f"{name}-out")

    def write(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    drain([frame.writeStream.foreachBatch(write).outputMode(mode).trigger(**ONCE)
           .option("checkpointLocation", str(tmp_path / f"{name}-ckpt")).start()])
    return frame.sparkSession.read.parquet(out)


@pytest.fixture
def access_files(events, tmp_path):
    folder = tmp_path / "logs" / "web1"
    lines = [r.value for r in access_json(events).orderBy("event_id").collect()]
    for i in range(0, 1000, 400):
        put(folder, f"access.{i}.json.log", lines[i:i + 400])
    # A late record closes every window before it; junk must not stop the stream.
    put(folder, "access.z.json.log", ["junk", "", request(END)])
    return tmp_path / "logs" / "*"


@pytest.mark.parametrize("exact", [True, False])
def test_access_stream_equals_batch(spark, events, access_files, tmp_path, exact):
    store = str(tmp_path / "store")
    raw = stream(spark, access_files, per_trigger=1)
    metrics = jobs.access_metrics(raw, replace(SETTINGS, path_error=None if exact else 0.05))
    sink = lambda m: sinks.store_writer(m, store, "dev", files=2)
    drain(jobs.start_metrics(metrics, sink, str(tmp_path / "ckpt"), "append", **ONCE))
    batch = jobs.access_metrics(access_json(events), SETTINGS)
    for m in (HTTP_STATS, TOP_URLS, ANOMALY):
        got = metric_store.read_points(spark, store, m, "2024-01-01", "2024-03-01")
        expected = to_points(batch[m], m).select(*got.columns)
        # The sketch is exact for the handful of paths a client asks for here.
        assert rows(got) == rows(expected) and got.count() > 100


def test_update_mode_rewrites_points(spark, events, access_files, tmp_path):
    store = str(tmp_path / "store")
    metrics = jobs.access_metrics(stream(spark, access_files, per_trigger=1), SETTINGS)
    drain(jobs.start_metrics({TOP_URLS: metrics[TOP_URLS]},
                             lambda m: sinks.store_writer(m, store), str(tmp_path / "ckpt"),
                             "update", **ONCE))
    got = metric_store.read_points(spark, store, TOP_URLS, "2024-01-01", "2024-03-01")
    batch = jobs.access_metrics(access_json(events), SETTINGS)[TOP_URLS]
    assert rows(got) == rows(to_points(batch, TOP_URLS).select(*got.columns))


def test_restart_reads_only_new_files(spark, tmp_path):
    folder, store = tmp_path / "logs" / "web1", str(tmp_path / "store")

    def go():
        metrics = jobs.access_metrics(stream(spark, tmp_path / "logs" / "*"), Settings())
        drain(jobs.start_metrics({HTTP_STATS: metrics[HTTP_STATS]},
                                 lambda m: sinks.store_writer(m, store),
                                 str(tmp_path / "ckpt"), "update", **ONCE))
        got = metric_store.read_points(spark, store, HTTP_STATS, "2025-01-01", "2025-01-02")
        return [r["count"] for r in got.collect()]

    put(folder, "access.1.json.log", [request(at(1)), request(at(2))])
    assert go() == [2]
    put(folder, "access.2.json.log", [request(at(3))])
    assert go() == [3]


def test_late_rows(spark, tmp_path):
    """A row of an expired window is dropped; a late row of an open window counts."""
    folder = tmp_path / "logs" / "web1"
    put(folder, "access.1.json.log", [request(at(5)), request(at(0, 10))])
    # Spark drops by the watermark that the batch before last left.
    put(folder, "access.2.json.log", [request(at(1, 10))])
    put(folder, "access.3.json.log", [request(at(6))])
    put(folder, "access.4.json.log", [request(at(9, 8)), request(at(0, 30))])
    raw = stream(spark, tmp_path / "logs" / "*", per_trigger=1)
    got = run(jobs.access_metrics(raw, Settings())[HTTP_STATS], tmp_path, "late")
    counts = {(r.window_end.hour, r.window_end.minute, r.window_end.second): r["count"]
              for r in got.collect()}
    assert counts[(0, 0, 10)] == 1 and counts[(0, 8, 10)] == 1


def test_error_stream_equals_batch(spark, events, tmp_path):
    folder, store = tmp_path / "logs" / "web2", str(tmp_path / "store")
    lines = [r.line for r in error_lines(events).collect()]
    late = "2030/01/01 00:00:00" + REFUSED[19:]
    put(folder, "error.1.log", lines + [NOTICE, "junk"])
    put(folder, "error.2.log", [late])
    metrics = jobs.error_metrics(stream(spark, tmp_path / "logs" / "*", per_trigger=1), SETTINGS)
    drain(jobs.start_metrics(metrics, lambda m: sinks.store_writer(m, store),
                             str(tmp_path / "ckpt"), "append", **ONCE))
    got = metric_store.read_points(spark, store, ERROR_EVENTS, "2024-01-01", "2024-03-01")
    raw = error_lines(events).withColumnRenamed("line", "value")
    batch = jobs.error_metrics(raw, SETTINGS)[ERROR_EVENTS]
    assert rows(got) == rows(to_points(batch, ERROR_EVENTS).select(*got.columns))
    notices = metric_store.read_points(spark, store, ERROR_EVENTS, "2024-11-30", "2024-12-02")
    assert [(r.hostname, r.level) for r in notices.collect()] == [("unknown_host", "notice")]


def test_processing_time_points(spark, tmp_path):
    frame = spark.createDataFrame(
        [(datetime(2020, 1, 1), "h", "error", "other", 2)],
        "window_end timestamp, hostname string, level string, message_class string, count bigint")
    sinks.store_writer(ERROR_EVENTS, str(tmp_path), time_source="processing_time")(frame, 0)
    row = metric_store.read_versions(spark, str(tmp_path), ERROR_EVENTS).first()
    assert row.time.year > 2020
    with pytest.raises(ValueError):
        sinks.store_writer(ERROR_EVENTS, str(tmp_path), time_source="other")(frame, 0)


def test_row_level_json_stream(spark, tmp_path):
    folder = tmp_path / "logs" / "web1"
    put(folder, "error.log", [REFUSED, NO_SERVER])
    json = error_json(jobs.error_rows(stream(spark, tmp_path / "logs" / "*")))
    query = (json.writeStream.format("memory").queryName("error_json").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(**ONCE).start())
    drain([query])
    assert spark.table("error_json").where("json like '%localhost:9443%'").count() == 1
    console = sinks.to_console(json).trigger(**ONCE).start()
    drain([console])


def test_line_and_remote_writers(spark, tmp_path):
    frame = spark.createDataFrame(
        [(datetime(2025, 8, 25, 5, 35), "web1", 404, f"/{i}", i) for i in range(25)],
        "window_end timestamp, hostname string, status int, path string, count bigint")
    sinks.line_writer(TOP_URLS, str(tmp_path / "text"))(frame, 0)
    text = {r.value for r in spark.read.text(str(tmp_path / "text/top_urls")).collect()}
    folder = tmp_path / "sent"
    folder.mkdir()
    target = str(folder)

    def send(body: bytes) -> None:
        with open(f"{target}/{uuid.uuid4()}", "wb") as f:
            f.write(body)

    sinks.remote_writer(TOP_URLS, send, block=4)(frame, 0)
    bodies = [open(p).read().split("\n") for p in glob.glob(f"{target}/*")]
    assert {line for b in bodies for line in b} == text and len(text) == 25
    assert max(map(len, bodies)) <= 4


def test_rolling_text_sink(spark, tmp_path):
    put(tmp_path / "logs" / "web1", "access.json.log", ["a", "b"])
    put(tmp_path / "logs" / "web1", "error.log", ["c"])
    writer = sinks.to_rolling_text(stream(spark, tmp_path / "logs" / "*"),
                                   str(tmp_path / "out"), str(tmp_path / "ckpt"), "1 second")
    query = writer.start()
    query.processAllAvailable()
    query.stop()
    got = spark.read.text(str(tmp_path / "out"))
    assert {(r.value, r.log_type) for r in got.collect()} == {
        ("a", "access"), ("b", "access"), ("c", "error")}


def test_origin_and_routing(spark, tmp_path):
    put(tmp_path / "logs" / "web3", "error.log", ["e"])
    put(tmp_path / "logs" / "web3", "access.json.log", ["a"])
    put(tmp_path / "logs" / "web3", "other.log", ["o"])
    frame = logs.open_batch(spark, LogSource("text", str(tmp_path / "logs" / "*")))
    assert {(r.host, r.log_type, r.value) for r in frame.collect()} == {
        ("web3", "error", "e"), ("web3", "access", "a"), ("web3", "access", "o")}
    kinds = spark.createDataFrame([("error",), ("access",), ("x",), (None,)], "log_type string")
    routed = logs.route(kinds)
    assert routed["error"].count() == 1 and routed["access"].count() == 3
    assert sinks.keyed_messages(frame).columns == ["key", "value"]
    hosts = spark.createDataFrame([("a", "x"), (None, "y")], "host string, hostname string")
    assert [r.hostname for r in logs.override_host(hosts).collect()] == ["a", "y"]


def test_topic_options():
    options = logs.kafka_options(logs.access_topic(Settings()))
    assert options == {"kafka.bootstrap.servers": "kafka:9092", "subscribe": "web-logs",
                       "startingOffsets": "latest", "failOnDataLoss": "false"}
    errors = logs.error_topic(Settings())
    assert (errors.location, errors.offsets) == ("web-errors", "earliest")
    with pytest.raises(ValueError):
        logs.open_stream(None, LogSource("other", "x"))


def test_checkpoint_folder(spark):
    assert checkpoint_root(spark, "/shared/x/") == "/shared/x"
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_alert_stream_equals_batch(spark, tmp_path):
    start = datetime(2025, 1, 1)
    breach = {1, 2, 3, 5, 6, 9}
    values = [(start + timedelta(minutes=5 * i + 1), h, "ip_spike",
               30.0 if i in breach else 1.0) for i in range(12) if i != 8 for h in ("web1", "web2")]
    schema = "time timestamp, hostname string, kind string, score double"
    rules = [r for r in batch_alerts.RULES if r.signal in ("host_max", "trend", "max")]
    source = tmp_path / "points"
    spark.createDataFrame(values[:9], schema).coalesce(1).write.parquet(str(source / "a"))
    spark.createDataFrame(values[9:], schema).coalesce(1).write.parquet(str(source / "b"))
    # A later point closes all evaluations of the hour.
    last = [(start + timedelta(hours=3), "web9", "scan", 1.0)]
    spark.createDataFrame(last, schema).coalesce(1).write.parquet(str(source / "c"))
    points = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(str(source / "*")))
    got = run(alerts.alert_stream({"anomaly": points}, rules), tmp_path, "alerts").where(
        "evaluated <= timestamp'2025-01-01 01:00:00'")
    batch = batch_alerts.alert_states(
        {"anomaly": spark.createDataFrame(values, schema)}, "2025-01-01 00:00:00",
        "2025-01-01 01:00:00", rules).where("series <> '' OR rule = 'max_score'")  # no beats, no empty series
    keep = ["rule", "title", "severity", "component", "series", "evaluated", "value", "state"]
    assert rows(got.select(*keep)) == rows(batch.select(*keep))


def test_alert_stream_reports_silence(spark, tmp_path):
    start = datetime(2025, 1, 1)
    schema = "time timestamp, hostname string, kind string, score double"
    source = tmp_path / "points"
    spark.createDataFrame([(start + timedelta(minutes=1), "web1", "scan", 50.0)], schema
                          ).coalesce(1).write.parquet(str(source / "a"))
    spark.createDataFrame([(start + timedelta(hours=3), "web9", "scan", 1.0)], schema
                          ).coalesce(1).write.parquet(str(source / "b"))
    points = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(str(source / "*")))
    rule = [r for r in batch_alerts.RULES if r.name == "any_host"]
    got = run(alerts.alert_stream({"anomaly": points}, rule, patience=2), tmp_path, "silence")
    mine = sorted((r.evaluated.minute, r.state) for r in got.where("series = 'web1'").collect())
    assert mine == [(5, "Pending"), (10, "Firing"), (15, "NoData"), (20, "NoData")]

    whole = run(alerts.alert_stream({"anomaly": points}, rule), tmp_path, "unending")
    states = [r.state for r in whole.where("series = 'web1'").orderBy("evaluated").collect()]
    assert states[:2] == ["Pending", "Firing"] and len(states) > 20 and set(states[2:]) == {"NoData"}


@pytest.fixture
def newest_watermark(spark):
    key = "spark.sql.streaming.multipleWatermarkPolicy"
    alerts.follow_beats(spark)
    yield
    spark.conf.unset(key)


@pytest.mark.parametrize("points", [[], [(16, "web1", "scan", 30.0), (36, "web1", "scan", 30.0)]])
def test_beats_make_every_rule_report(spark, tmp_path, newest_watermark, points):
    """Empty tables: all rules say NoData, as in batch. With points: until the rule has a series."""
    start = datetime(2025, 1, 1)
    schemas = {"anomaly": "time timestamp, hostname string, kind string, score double",
               "top_urls": "time timestamp, hostname string, path string, status int, count bigint"}
    data = [(start + timedelta(minutes=m), h, k, v) for m, h, k, v in points]
    batch, streams = {}, {}
    for name, schema in schemas.items():
        batch[name] = spark.createDataFrame(data if name == "anomaly" else [], schema)
        folder = str(tmp_path / name)
        batch[name].coalesce(1).write.parquet(folder)
        streams[name] = spark.readStream.schema(schema).parquet(folder)
    ticks = [[(start + timedelta(minutes=m),) for m in range(1, 60)], [(start + timedelta(hours=3),)]]
    for i, part in enumerate(ticks):
        spark.createDataFrame(part, "time timestamp").coalesce(1).write.parquet(str(tmp_path / "beats" / str(i)))
    beats = spark.readStream.schema("time timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "beats" / "*"))
    got = run(alerts.alert_stream(streams, beats=beats), tmp_path, "beats").where(
        "evaluated <= timestamp'2025-01-01 01:00:00'")
    whole = batch_alerts.alert_states(batch, "2025-01-01 00:00:00", "2025-01-01 01:00:00")
    keep = ["rule", "title", "severity", "component", "series", "evaluated", "value", "state"]
    if not points:
        assert rows(got.select(*keep)) == rows(whole.select(*keep)) and got.count() == 7 * 12
        return
    found = {}
    for r in got.collect():
        found.setdefault((r.rule, r.series), []).append((r.evaluated.minute, r.state))
    # Real series agree with the batch from their first value on; the empty series ends there.
    first = {("any_host", "web1"): 20, ("trend_web1", "web1 | scan"): 20}
    expected = {}
    for r in whole.collect():
        key = (r.rule, r.series)
        minute = r.evaluated.minute or 60
        if minute >= first.get(key, 0):
            expected.setdefault(key, []).append((minute % 60, r.state))
    for name in ("any_host", "trend_web1"):
        assert sorted(found.pop((name, ""))) == [(m, "NoData") for m in (5, 10, 15)]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


def test_rewritten_points_count_once_in_alerts(spark, tmp_path):
    store, start = str(tmp_path / "store"), datetime(2025, 1, 1)
    schema = "time timestamp, env string, hostname string, status int, path string, count bigint"

    def put_urls(minute, count, batch, generation=0):
        frame = spark.createDataFrame([(start + timedelta(minutes=minute), "dev", "web1", 503, "/x", count)], schema)
        metric_store.append_points(frame, store, TOP_URLS, batch, files=1, generation=generation)

    rule = [r for r in batch_alerts.RULES if r.signal == "total_5xx"]
    # The alert job starts before any point exists.
    for q in jobs.start_alerts(spark, store, str(tmp_path / "alerts"), str(tmp_path / "ckpt"), rule, availableNow=True):
        q.awaitTermination()
    for batch, count in enumerate((3, 6, 8)):
        put_urls(1, count, batch)
    put_urls(300, 1, 3)
    for _ in range(2):
        for q in jobs.start_alerts(spark, store, str(tmp_path / "alerts"), str(tmp_path / "ckpt"), rule, availableNow=True):
            q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "alerts" / "top_urls")).where("value is not null").orderBy("evaluated").collect()
    points = metric_store.read_points(spark, store, TOP_URLS, "2025-01-01", "2025-01-02")
    want = batch_alerts.alert_states({"top_urls": points}, "2025-01-01 00:00:00", "2025-01-01 00:10:00", rule)
    want = [(r.evaluated, r.value, r.state) for r in want.where("value is not null").orderBy("evaluated").collect()]
    assert [(r.evaluated, r.value, r.state) for r in got][:len(want)] == want and want[0][1] == 8


def test_a_newer_generation_wins(spark, tmp_path):
    store, schema = str(tmp_path / "store"), "time timestamp, env string, hostname string, status int, path string, count bigint"

    def put_count(count, batch, generation):
        frame = spark.createDataFrame([(datetime(2025, 1, 1), "dev", "web1", 200, "/x", count)], schema)
        metric_store.append_points(frame, store, TOP_URLS, batch, files=1, generation=generation)

    def read():
        return [r["count"] for r in metric_store.read_points(spark, store, TOP_URLS, "2025-01-01", "2025-01-02").collect()]

    assert read() == []
    checkpoint = str(tmp_path / "ckpt")
    first = metric_store.checkpoint_generation(spark, checkpoint, store, TOP_URLS)
    assert metric_store.checkpoint_generation(spark, checkpoint, store, TOP_URLS) == first
    put_count(3, 500, first)
    second = metric_store.checkpoint_generation(spark, str(tmp_path / "other"), store, TOP_URLS)
    put_count(10, 0, second)
    assert second > first and read() == [10]
    put_count(11, 0, metric_store.checkpoint_generation(spark, str(tmp_path / "third"), store, TOP_URLS))
    assert read() == [11]


def test_host_of_the_envelope_wins(spark, tmp_path):
    folder = tmp_path / "logs" / "web7"
    put(folder, "access.json.log", [request(at(1), host="inner")])
    put(folder, "error.log", [NO_SERVER])
    raw = logs.open_batch(spark, LogSource("text", str(tmp_path / "logs" / "*")))
    routed = logs.route(raw)
    access = jobs.access_metrics(routed["access"], SETTINGS, override=True)[HTTP_STATS]
    errors = jobs.error_metrics(routed["error"], SETTINGS, override=True)[ERROR_EVENTS]
    assert access.first().hostname == errors.first().hostname == "web7"
    plain = jobs.error_metrics(routed["error"], SETTINGS)[ERROR_EVENTS]
    assert plain.first().hostname == "localhost:9443"


def test_dead_letters(spark, tmp_path):
    put(tmp_path / "logs" / "web1", "access.json.log", [request(at(1)), "junk", "{}"])
    put(tmp_path / "errs" / "web1", "error.log", [REFUSED, NO_SERVER, "?"])
    checkpoints, out = str(tmp_path / "ckpt"), tmp_path / "out"
    access, errors = (stream(spark, tmp_path / d / "*") for d in ("logs", "errs"))
    drain([
        jobs.start_dead_letters(access, "access", str(out / "a"), checkpoints, **ONCE),
        jobs.start_dead_letters(errors, "error", str(out / "e"), checkpoints, **ONCE),
    ])
    assert {r.value for r in spark.read.text(str(out / "a")).collect()} == {"junk", "{}"}
    assert [r.value for r in spark.read.text(str(out / "e")).collect()] == ["?"]


def test_stored_samples_equal_batch(spark, tmp_path):
    """At most k rows a group, over micro-batches and restarts; later files hold earlier rows too."""
    folder = tmp_path / "logs" / "web1"
    lines = [REFUSED.replace("21:05:30", f"21:05:{s:02d}") for s in (9, 7, 5, 8, 6, 4, 3)]
    checkpoints, out = str(tmp_path / "ckpt"), str(tmp_path / "samples")
    settings = Settings(error_samples=3, window="1 minute", watermark="1 minute")

    def go():
        raw = stream(spark, tmp_path / "logs" / "*", per_trigger=1)
        drain([jobs.start_error_samples(raw, settings, out, checkpoints, **ONCE)])

    put(folder, "a.log", lines[:3])
    go()
    put(folder, "b.log", [*lines[3:], "?", NO_SERVER])
    go()
    every = [line for p in sorted(folder.glob("*.log")) for line in p.read_text().splitlines()]
    put(folder, "z.log", [NOTICE.replace("2024/", "2030/")])
    go()
    errors = jobs.error_rows(spark.createDataFrame([(x,) for x in every], "value string"))
    expected = reports.error_samples(errors, 3, "1 minute")
    got = sinks.read_samples(spark, out)
    assert rows(got) == rows(expected.select(*got.columns)) and got.count() >= 4
    assert metric_store.expire_rows(spark, out, "2031-01-01", 30) == sorted(
        {str(r.window_end.date()) for r in expected.collect()})


def test_lines_are_counted_per_batch(spark, tmp_path):
    folder, counts, late = tmp_path / "logs" / "web1", [], []
    for name, lines in (("a", [request(at(1)), "junk", "{}", request(END)]), ("b", [request(at(2)), "junk"])):
        put(folder, f"{name}.json.log", lines)
        raw = stream(spark, tmp_path / "logs" / "*")
        query = jobs.start_ingest(raw, str(tmp_path / "rows"), str(tmp_path / "ckpt"), **ONCE)
        drain([query])
        counts += [(c["rows"], c["undated"]) for c in monitor.recent_counts(query) if c["rows"]]
        followed = jobs.ingested(spark, str(tmp_path / "rows"))
        metrics = {TOP_URLS: jobs.access_rollups(followed, SETTINGS, None)[TOP_URLS]}
        queries = jobs.start_metrics(metrics, lambda m: sinks.store_writer(m, str(tmp_path / "store")),
                                     str(tmp_path / "ckpt"), **ONCE)
        drain(queries)
        late.append(sum(c["late"] for c in monitor.recent_counts(queries[0])))
    assert counts == [(4, 2), (2, 1)] and late == [0, 1]


def test_update_mode_counts_paths_exactly(spark, tmp_path):
    """Clients with 19, 20 and 21 different paths, dealt over files with repeats."""
    folder, store = tmp_path / "logs" / "web1", str(tmp_path / "store")
    hits = [(f"10.0.0.{n}", f"/{i}") for n in (19, 20, 21) for i in range(n)]
    for part in range(3):
        put(folder, f"{part}.json.log", [request(at(part), ip=ip, path=path) for i, (ip, path) in enumerate(hits)
                                         if i % 3 == part or i % 2 == 0])
    settings = Settings(window="1 hour", thresholds=Thresholds(1_000, 20, 2.0))
    raw = stream(spark, tmp_path / "logs" / "*", per_trigger=1)
    metrics = {ANOMALY: jobs.access_metrics(raw, settings)[ANOMALY]}
    drain(jobs.start_metrics(metrics, lambda m: sinks.store_writer(m, store), str(tmp_path / "ckpt"), "update", **ONCE))
    got = metric_store.read_points(spark, store, ANOMALY, "2025-01-01", "2025-01-02")
    assert sorted((r.ip, r.kind, r["count"]) for r in got.collect()) == [
        ("10.0.0.20", "scan", 20), ("10.0.0.21", "scan", 21)]
    batch = jobs.access_metrics(logs.open_batch(spark, LogSource("text", str(tmp_path / "logs" / "*"))), settings)[ANOMALY]
    assert rows(got) == rows(to_points(batch, ANOMALY).select(*got.columns))


def test_remote_writes_are_tried_again(spark, tmp_path):
    tried = []

    def busy(body):
        tried.append(body)
        if len(tried) < 3:
            raise urllib.error.HTTPError("u", 503, "busy", None, None)

    sinks.patient(busy, 3, pause=0.001)(b"x")
    assert tried == [b"x"] * 3
    for error, times in ((urllib.error.HTTPError("u", 400, "bad", None, None), 1), (ConnectionResetError(), 4)):
        tried.clear()

        def refuse(body, error=error):
            tried.append(body)
            raise error

        with pytest.raises(type(error)):
            sinks.patient(refuse, 4, pause=0.001)(b"x")
        assert len(tried) == times


def test_remote_sink_of_a_job(spark, tmp_path, monkeypatch):
    """The settings choose the remote sink; a replay at processing time sends equal points."""
    settings = Settings.from_env({"METRIC_SINK": "remote", "INFLUX_ORG": "a b&c", "INFLUX_BUCKET": "x/y", "REMOTE_BLOCK_LINES": "2"})
    asked = []
    monkeypatch.setattr("urllib.request.urlopen", lambda r, timeout: asked.append(r) or open("/dev/null"))
    sinks.http_sender(settings.remote_url, settings.remote_org, settings.remote_bucket, "t")(b"x")
    assert asked[0].full_url.endswith("/api/v2/write?org=a+b%26c&bucket=x%2Fy&precision=ns")
    folder = tmp_path / "sent"
    folder.mkdir()
    target = str(folder)

    def send(body):
        with open(f"{target}/{uuid.uuid4()}", "wb") as f:
            f.write(body)

    frame = spark.createDataFrame(
        [(datetime(2025, 1, 1), f"h{i}", "error", "other", i) for i in range(3)],
        "window_end timestamp, hostname string, level string, message_class string, count bigint").coalesce(1)
    for batch in (0, 0, 1):
        sink = sinks.remote_sink(settings, str(tmp_path / "ckpt"), "processing_time", send)
        sink(ERROR_EVENTS)(frame, batch)
    sent = [line for p in glob.glob(f"{target}/*") for line in open(p).read().split("\n")]
    assert len(sent) == 9 and len(set(sent)) == 6
    assert jobs.metric_sink(spark, settings, "", str(tmp_path / "c"))(ERROR_EVENTS)
    with pytest.raises(ValueError):
        jobs.metric_sink(spark, replace(settings, sink="other"), "", "")
