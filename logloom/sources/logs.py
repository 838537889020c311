"""Raw log sources: topics and files, batch or streaming, with type and host tags."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.config import Settings

# Log types, and file names that mark them.
ACCESS, ERROR = "access", "error"


@dataclass(frozen=True)
class LogSource:
    """Where raw lines come from: ``kafka`` (a topic) or ``text`` (files under a path)."""

    kind: str
    location: str
    bootstrap: str = ""
    offsets: str = "latest"
    per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)


def access_topic(settings: Settings) -> LogSource:
    return LogSource("kafka", settings.access_topic, settings.kafka_bootstrap,
                     settings.access_offsets)


def error_topic(settings: Settings) -> LogSource:
    return LogSource("kafka", settings.error_topic, settings.kafka_bootstrap,
                     settings.error_offsets)


def kafka_options(source: LogSource) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": source.bootstrap,
        "subscribe": source.location,
        "startingOffsets": source.offsets,
        "failOnDataLoss": "false",
        **source.options,
    }
    if source.per_trigger:
        options["maxOffsetsPerTrigger"] = str(source.per_trigger)
    return options


def open_stream(spark: SparkSession, source: LogSource) -> DataFrame:
    """Unbounded lines: ``value``, plus ``host`` (message key, or from the file's path).

    A file stream takes each new file once; rolled log files are its unit, and the
    checkpoint remembers which were read.
    """
    if source.kind == "kafka":
        raw = spark.readStream.format("kafka").options(**kafka_options(source)).load()
        return raw.select(F.col("key").cast("string").alias("host"),
                          F.col("value").cast("string").alias("value"))
    if source.kind == "text":
        reader = spark.readStream.format("text").options(**source.options)
        if source.per_trigger:
            reader = reader.option("maxFilesPerTrigger", source.per_trigger)
        return with_origin(reader.load(source.location))
    raise ValueError(f"unknown source kind: {source.kind}")


def open_batch(spark: SparkSession, source: LogSource) -> DataFrame:
    """The same lines as a bounded DataFrame, for backfills."""
    if source.kind == "kafka":
        options = {**kafka_options(source), "startingOffsets": "earliest"}
        raw = spark.read.format("kafka").options(**options).load()
        return raw.select(F.col("key").cast("string").alias("host"),
                          F.col("value").cast("string").alias("value"))
    if source.kind == "text":
        reader = spark.read.format("text").options(**source.options)
        return with_origin(reader.load(source.location))
    raise ValueError(f"unknown source kind: {source.kind}")


def host_of(path: Column) -> Column:
    """The folder that holds the file; null where there is none."""
    return F.nullif(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1), F.lit(""))


def type_of(path: Column) -> Column:
    """``error`` for error-log file names, else ``access``."""
    return F.when(path.rlike(r"(^|/)error[^/]*$"), ERROR).otherwise(ACCESS)


def with_origin(lines: DataFrame) -> DataFrame:
    """Tag each line with the host folder and log type of its file."""
    path = F.col("_metadata.file_path")
    return lines.select(host_of(path).alias("host"), type_of(path).alias("log_type"), "value")


def route(events: DataFrame) -> dict[str, DataFrame]:
    """Events by log type; anything not marked as error goes to access."""
    target = routed_type(F.col("log_type"))
    return {
        ACCESS: events.where(target == ACCESS),
        ERROR: events.where(target == ERROR),
    }


def routed_type(log_type: Column) -> Column:
    return F.when(log_type == ERROR, ERROR).otherwise(ACCESS)


def override_host(rows: DataFrame, host: str = "host") -> DataFrame:
    """The envelope's host where there is one, else the host found in the record."""
    return rows.withColumn("hostname", F.coalesce(F.col(host), F.col("hostname"))).drop(host)
