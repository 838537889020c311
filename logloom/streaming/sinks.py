"""Sinks of the streaming jobs. Rows leave from the executors, never by the driver."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from logloom.config import Settings
from logloom.operators.points import Measurement, clean_tags, to_lines, to_points
from logloom.sources.commits import CommitLog
from logloom.sources.metric_store import append_points, table_path

BatchWriter = Callable[[DataFrame, int], None]


def _points(batch: DataFrame, m: Measurement, env: str, time_source: str,
            stamp: int | None = None) -> DataFrame:
    """The points of a micro-batch; ``stamp`` (microseconds) is the time of its first attempt."""
    if time_source not in ("window_end", "processing_time"):
        raise ValueError(f"unknown time source: {time_source}")
    at = None
    if time_source == "processing_time":
        at = F.current_timestamp() if stamp is None else F.timestamp_micros(F.lit(stamp))
    points = to_points(batch, m, env, at)
    return clean_tags(points, [t for t in m.tags if t not in ("status", "ip")])


def store_writer(m: Measurement, root: str, env: str = "dev",
                 time_source: str = "window_end", files: int = 4,
                 generation: int = 0) -> BatchWriter:
    """Append each micro-batch to the metric table.

    With the stream's ``generation`` (its number in the table's commit log) a batch writes with the
    newest number published at its first attempt, so it wins over earlier backfills, and a
    replayed batch writes the same versions with the same times, so readers see each point once.
    Without one the batch number alone orders the versions, and a replay at processing time gets
    another time.
    """
    newest = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal newest
        if not generation:
            append_points(_points(batch, m, env, time_source), root, m, batch_id, files)
            return
        entry = CommitLog(batch.sparkSession, table_path(root, m)).attempt(generation, batch_id, newest)
        written = Observation()
        points = _points(batch, m, env, time_source, entry.stamp).observe(
            written, F.max(F.unix_micros(F.col("time").cast("timestamp"))).alias("newest"))
        append_points(points, root, m, batch_id, files, entry.number)
        newest = max(newest, entry.newest, written.get["newest"] or 0)

    return write


def line_writer(m: Measurement, path: str, env: str = "dev",
                time_source: str = "window_end") -> BatchWriter:
    """Line-protocol text files."""
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = to_lines(_points(batch, m, env, time_source), m)
        lines.write.mode("append").text(f"{path.rstrip('/')}/{m.name}")

    return write


def http_sender(url: str, org: str, bucket: str, token: str,
                timeout: float = 10.0) -> Callable[[bytes], None]:
    """A function that posts one block of lines to a line-protocol write endpoint."""
    query = urllib.parse.urlencode({"org": org, "bucket": bucket, "precision": "ns"})
    target = f"{url.rstrip('/')}/api/v2/write?{query}"

    def send(body: bytes) -> None:
        request = urllib.request.Request(
            target, data=body, headers={"Authorization": f"Token {token}"}, method="POST"
        )
        with urllib.request.urlopen(request, timeout=timeout):
            pass

    return send


def is_passing(error: Exception) -> bool:
    """Whether the same block may be taken later: busy or broken servers, lost connections."""
    if isinstance(error, urllib.error.HTTPError):
        return error.code == 429 or error.code >= 500
    return isinstance(error, OSError)


def patient(send: Callable[[bytes], None], tries: int = 5, pause: float = 0.5,
            longest: float = 30.0) -> Callable[[bytes], None]:
    """Send again after a passing failure, each time after twice the pause, ``tries`` times in all.

    A refused block fails at once, and the last failure fails the task, so Spark repeats the task
    or the micro-batch: no block is given up silently.
    """
    def send_until_taken(body: bytes) -> None:
        for attempt in range(1, tries + 1):
            try:
                return send(body)
            except Exception as error:
                if attempt == tries or not is_passing(error):
                    raise
                time.sleep(min(longest, pause * 2 ** (attempt - 1)))

    return send_until_taken


def blocks(lines: Iterable[str], size: int) -> Iterator[bytes]:
    rest = iter(lines)
    while block := list(islice(rest, size)):
        yield "\n".join(block).encode()


def remote_writer(m: Measurement, send: Callable[[bytes], None], env: str = "dev",
                  time_source: str = "window_end", block: int = 5_000,
                  attempts: str | None = None, generation: int = 1) -> BatchWriter:
    """Every task sends its own lines in blocks; a repeated block rewrites equal points.

    ``attempts`` is a folder beside the checkpoint that keeps the time of a micro-batch's first attempt,
    so that points at processing time are equal in a replay as well.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        def send_partition(rows) -> None:
            for body in blocks((row.line for row in rows), block):
                send(body)

        stamp = None
        if attempts:
            stamp = CommitLog(batch.sparkSession, attempts).attempt(generation, batch_id).stamp
        to_lines(_points(batch, m, env, time_source, stamp), m).foreachPartition(send_partition)

    return write


def remote_sink(settings: Settings, checkpoints: str, time_source: str = "window_end",
                send: Callable[[bytes], None] | None = None) -> Callable[[Measurement], BatchWriter]:
    """The writer of each measurement to the endpoint of the settings, or through another sender."""
    send = send or http_sender(settings.remote_url, settings.remote_org, settings.remote_bucket, settings.remote_token)
    careful = patient(send, settings.remote_tries)
    return lambda m: remote_writer(m, careful, settings.env, time_source, settings.remote_block,
                                   f"{checkpoints}/{m.name}_attempts")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """The stored samples: at most k rows of each window and key, each written once."""
    return spark.read.parquet(path).drop("date")


def keyed_messages(events: DataFrame) -> DataFrame:
    """Messages keyed by host, so that one server's lines stay in order."""
    return events.select(F.col("host").cast("string").alias("key"),
                         F.col("value").cast("string").alias("value"))


def to_topic(events: DataFrame, bootstrap: str, topic: str,
             checkpoint: str) -> DataStreamWriter:
    return (
        keyed_messages(events).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def to_rolling_text(events: DataFrame, path: str, checkpoint: str,
                    roll: str = "60 seconds") -> DataStreamWriter:
    """One set of newline-ended text files per log type and roll."""
    return (
        events.select("log_type", "value").writeStream.format("text")
        .partitionBy("log_type")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=roll)
    )


def to_console(json: DataFrame) -> DataStreamWriter:
    return json.writeStream.format("console").option("truncate", False).outputMode("append")
