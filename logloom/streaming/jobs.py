"""The access job and the error job."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logloom.config import Settings
from logloom.operators import rollups
from logloom.operators.access import read_access, undated
from logloom.operators.alerts import RULES, SIGNAL_TABLE, Clock, Rule
from logloom.operators.anomalies import anomalies
from logloom.operators.errors import error_json, read_errors
from logloom.operators.points import (
    ANOMALY,
    ERROR_EVENTS,
    HTTP_STATS,
    TOP_URLS,
    Measurement,
    clean_tags,
    to_points,
)
from logloom.operators.sketches import SKETCHES, sketch_rollup
from logloom.session import (
    build_session,
    checkpoint_root,
    ship_package,
)
from logloom.sources.logs import (
    ACCESS,
    ERROR,
    access_topic,
    error_topic,
    open_stream,
    override_host,
)
from logloom.sources.metric_store import (
    checkpoint_generation,
    micros_of,
    replace_points,
    stream_points,
)
from logloom.streaming.alerts import alert_stream, beats_of_clock, follow_beats
from logloom.streaming.monitor import LineCounts, counted
from logloom.streaming.samples import sample_stream
from logloom.streaming.sinks import (
    BatchWriter,
    remote_sink,
    store_writer,
    to_console,
)
from logloom.streaming.staging import StagedRows, follow, stage_batches

SinkFor = Callable[[Measurement], BatchWriter]


def access_rollups(access: DataFrame, settings: Settings,
                   rsd: float | None) -> dict[Measurement, DataFrame]:
    """The three access measurements of normalized rows."""
    window, watermark = settings.window, settings.watermark
    return {
        HTTP_STATS: rollups.http_stats(access, window, watermark),
        TOP_URLS: rollups.top_urls(access, window, watermark),
        ANOMALY: anomalies(access, settings.thresholds, window, watermark, rsd),
    }


def stored_rollups(access: DataFrame, settings: Settings) -> dict[Measurement, DataFrame]:
    """All measurements of access rows that a metric table can hold: also the sketches."""
    return {
        **access_rollups(access, settings, settings.path_error),
        SKETCHES: sketch_rollup(access, settings.window, settings.watermark),
    }


def access_rows(raw: DataFrame, override: bool = False) -> DataFrame:
    """Normalized access rows with clean tags; ``override`` prefers the envelope's host."""
    rows = override_host(read_access(raw, keep=["host"])) if override else read_access(raw)
    return clean_tags(rows, ["hostname", "method", "path"])


def access_metrics(raw: DataFrame, settings: Settings,
                   override: bool = False) -> dict[Measurement, DataFrame]:
    """The three access measurements of raw JSON lines."""
    return access_rollups(access_rows(raw, override), settings, settings.path_error)


def error_rows(raw: DataFrame, zone: str | None = None, override: bool = False) -> DataFrame:
    if override:
        return override_host(read_errors(raw, "value", zone, keep=["host"]))
    return read_errors(raw, "value", zone)


def error_metrics(raw: DataFrame, settings: Settings, zone: str | None = None,
                  override: bool = False) -> dict[Measurement, DataFrame]:
    rows = error_rows(raw, zone, override)
    errors = clean_tags(counted(rows) if rows.isStreaming else rows, ["hostname", "level"])
    return {ERROR_EVENTS: rollups.error_events(errors, settings.window, settings.watermark)}


def dead_letters(raw: DataFrame, log_type: str = ACCESS) -> DataFrame:
    """Raw lines without a readable time, which no metric can count."""
    read = read_errors if log_type == ERROR else read_access
    return undated(read(raw, "value", keep=["value"])).select("value")


def start_dead_letters(raw: DataFrame, log_type: str, path: str, checkpoints: str,
                       **trigger) -> StreamingQuery:
    writer = (
        dead_letters(raw, log_type).writeStream.queryName(f"dead_{log_type}").format("text")
        .option("path", path).option("checkpointLocation", f"{checkpoints}/dead_{log_type}")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_error_samples(raw: DataFrame, settings: Settings, path: str, checkpoints: str,
                        zone: str | None = None, **trigger) -> StreamingQuery:
    """The first raw rows of each kind of error, by date, for ``read_samples``.

    A window's rows are kept in state and written once, when the watermark has closed it.
    """
    ship_package(raw.sparkSession)
    errors = clean_tags(error_rows(raw, zone), ["hostname", "level"])
    samples = sample_stream(errors, settings.error_samples, settings.window, settings.watermark)
    writer = (
        samples.withColumn("date", F.to_date("window_end")).writeStream.queryName("error_samples")
        .outputMode("append").format("parquet").partitionBy("date").option("path", path)
        .option("checkpointLocation", f"{checkpoints}/error_samples")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_ingest(raw: DataFrame, path: str, checkpoints: str, override: bool = False,
                 **trigger) -> StreamingQuery:
    """Parse access lines once, into typed columnar files that the metric queries follow."""
    writer = (
        counted(access_rows(raw, override)).writeStream.queryName("ingest_access")
        .outputMode("append").foreachBatch(stage_batches(path))
        .option("checkpointLocation", f"{checkpoints}/ingest_access")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def ingested(spark: SparkSession, path: str, files_per_trigger: int = 1_000) -> DataFrame:
    """The typed rows of ``start_ingest`` as they arrive; the folder may not be there yet."""
    schema = access_rows(spark.createDataFrame([], "value string")).schema
    return follow(spark, path, schema, files_per_trigger)


def start_metrics(metrics: Mapping[Measurement, DataFrame], sink: SinkFor, checkpoints: str,
                  mode: str = "update", **trigger) -> list[StreamingQuery]:
    """One query a measurement, each with a checkpoint of its own.

    ``update`` re-emits a window while it still changes; ``append`` emits it once, when
    the watermark has closed it, so that thresholds judge whole windows.
    """
    queries = []
    for m, frame in metrics.items():
        writer = (
            frame.writeStream.queryName(m.name).outputMode(mode)
            .option("checkpointLocation", f"{checkpoints}/{m.name}")
            .foreachBatch(sink(m))
        )
        queries.append((writer.trigger(**trigger) if trigger else writer).start())
    return queries


def _span(rows: DataFrame, window: str) -> tuple[int, int] | None:
    """Microseconds from the first event to the end of the last one's window; None without events.

    Points lie at the ends of windows, so this holds exactly the points that the rows give.
    """
    spans = rows.select(F.unix_micros(F.col("event_time").cast("timestamp")).alias("at"),
                        F.unix_micros(F.window("event_time", window)["end"].cast("timestamp")).alias("end"))
    first, last = spans.agg(F.min("at"), F.max("end")).first()
    return None if first is None else (first, last + 1)


def _replace(metrics: Mapping[Measurement, DataFrame], rows: DataFrame, store: str, settings: Settings) -> None:
    span = _span(rows, settings.window)
    if span is None:
        return
    for m, frame in metrics.items():
        replace_points(to_points(frame, m, settings.env), store, m, *span,
                       open_for=f"{settings.window} + {settings.watermark}")


def backfill_access(raw: DataFrame, staging: str, store: str, settings: Settings) -> None:
    """Metric tables of a bounded log archive.

    The text is parsed once into a columnar table on shared storage. The three metrics then
    read only their columns of it, and a lost executor costs a re-read, not a re-parse. A backfill
    replaces all points in the time of its rows, also those it does not produce itself, at once;
    windows that a running stream may still rewrite are left to the stream.
    """
    access = access_rows(raw)
    access.write.mode("overwrite").parquet(staging)
    staged = raw.sparkSession.read.parquet(staging)
    _replace(stored_rollups(staged, settings), staged, store, settings)


def backfill_errors(raw: DataFrame, store: str, settings: Settings,
                    zone: str | None = None) -> None:
    """Error points of a bounded archive; the one metric needs no staging."""
    _replace(error_metrics(raw, settings, zone), error_rows(raw, zone), store, settings)


def metric_sink(spark: SparkSession, settings: Settings, store: str, checkpoints: str,
                time_source: str = "window_end") -> SinkFor:
    """The sink that the settings name: metric tables or the remote line-protocol endpoint."""
    if settings.sink == "remote":
        ship_package(spark)
        return remote_sink(settings, checkpoints, time_source)
    if settings.sink != "store":
        raise ValueError(f"unknown sink: {settings.sink}")
    return lambda m: store_writer(m, store, settings.env, time_source,
                                  generation=checkpoint_generation(spark, checkpoints, store, m))


def start_alerts(spark: SparkSession, store: str, target: str, checkpoints: str,
                 rules: Sequence[Rule] = RULES, clock: Clock = Clock(),
                 watermark: str = "5 minutes", beats: DataFrame | None = None,
                 **trigger) -> list[StreamingQuery]:
    """Alert states of new points, appended as Parquet; one query per watched table.

    Each point counts with its newest version once the watermark has passed it, so the watermark
    must be longer than the writer keeps re-emitting a window.
    Tables have queries of their own because one query has one watermark: a quiet anomaly
    table must not hold back the rules on URLs. With ``beats`` rules also report ``NoData``
    while a table is silent or empty; points older than the watermark behind the newest beat are late then.
    """
    ship_package(spark)
    if beats is not None:
        follow_beats(spark)
    queries = []
    for m in (ANOMALY, TOP_URLS):
        watching = [r for r in rules if SIGNAL_TABLE[r.signal] == m.name]
        if not watching:
            continue
        points = {m.name: stream_points(spark, store, m)}
        writer = (
            alert_stream(points, watching, clock, watermark, beats=beats).writeStream
            .queryName(f"alerts_{m.name}").outputMode("append").format("parquet")
            .option("path", f"{target.rstrip('/')}/{m.name}")
            .option("checkpointLocation", f"{checkpoints}/alerts_{m.name}")
        )
        queries.append((writer.trigger(**trigger) if trigger else writer).start())
    return queries


def run_access(store: str, settings: Settings | None = None, mode: str = "update",
               every: str = "10 seconds") -> None:
    """Topic to metric tables, until a query stops or fails.

    The topic is read and parsed once, into ``<store>/access_rows``; the metrics read that, and
    what all of them have read goes after ``settings.staged_keep``.
    """
    settings = settings or Settings.from_env()
    spark = build_session("access-metrics")
    spark.streams.addListener(LineCounts())
    raw = open_stream(spark, access_topic(settings))
    checkpoints = f"{checkpoint_root(spark, settings.checkpoint_root)}/access"
    rows = f"{store.rstrip('/')}/access_rows"
    start_ingest(raw, rows, checkpoints, processingTime=every)
    followed = ingested(spark, rows)
    # Sketches are bytes, which the line protocol cannot carry.
    metrics = stored_rollups(followed, settings) if settings.sink == "store" else access_rollups(
        followed, settings, settings.path_error)
    keep = micros_of(spark, settings.staged_keep)
    spark.streams.addListener(StagedRows(spark, rows, [m.name for m in metrics], keep))
    start_metrics(metrics, metric_sink(spark, settings, store, checkpoints), checkpoints, mode,
                  processingTime=every)
    wait(spark)


def run_errors(store: str, settings: Settings | None = None, mode: str = "update",
               zone: str | None = None, every: str = "10 seconds") -> None:
    settings = settings or Settings.from_env()
    spark = build_session("error-metrics")
    spark.streams.addListener(LineCounts())
    raw = open_stream(spark, error_topic(settings))
    root = settings.error_checkpoint_root or settings.checkpoint_root
    checkpoints = f"{checkpoint_root(spark, root)}/errors"
    start_metrics(error_metrics(raw, settings, zone),
                  metric_sink(spark, settings, store, checkpoints, settings.error_time),
                  checkpoints, mode, processingTime=every)
    to_console(error_json(error_rows(raw, zone))).start()
    wait(spark)


def run_samples(path: str, settings: Settings | None = None, zone: str | None = None,
                every: str = "10 seconds") -> None:
    """Error lines of the topic to stored samples, until the query stops or fails."""
    settings = settings or Settings.from_env()
    spark = build_session("error-samples")
    root = checkpoint_root(spark, settings.error_checkpoint_root or settings.checkpoint_root)
    start_error_samples(open_stream(spark, error_topic(settings)), settings, path, f"{root}/samples",
                        zone, processingTime=every)
    wait(spark)


def run_dead_letters(path: str, settings: Settings | None = None, every: str = "10 seconds") -> None:
    """Unreadable lines of both topics to text files, until a query stops or fails."""
    settings = settings or Settings.from_env()
    spark = build_session("dead-letters")
    root = checkpoint_root(spark, settings.checkpoint_root)
    for log_type, topic in ((ACCESS, access_topic), (ERROR, error_topic)):
        start_dead_letters(open_stream(spark, topic(settings)), log_type, f"{path.rstrip('/')}/{log_type}",
                           f"{root}/dead_letters", processingTime=every)
    wait(spark)


def wait(spark: SparkSession) -> None:
    """Return or raise as soon as any query ends, not only the first one started."""
    spark.streams.awaitAnyTermination()


def run_alerts(store: str, target: str, settings: Settings | None = None,
               every: str = "1 minute") -> None:
    """Alert states of a store's points, until a query stops or fails."""
    settings = settings or Settings.from_env()
    spark = build_session("alerts")
    checkpoints = f"{checkpoint_root(spark, settings.checkpoint_root)}/alerts"
    start_alerts(spark, store, target, checkpoints, beats=beats_of_clock(spark), processingTime=every)
    wait(spark)
