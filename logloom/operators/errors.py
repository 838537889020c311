"""Error log: text lines to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.errors import (
    FIELD_NAMES,
    LINE_PATTERNS,
    field,
    line_part,
    line_timestamp,
    message_class,
    packed_fields,
    split_fields,
)
from logloom.functions.rows import parsed_once


def zoned(time: Column, zone: str | None) -> Column:
    """Line times carry no zone; with ``zone`` they are local to it."""
    return F.to_utc_timestamp(time, zone) if zone else time


def parse_error_lines(lines: DataFrame, line: str = "line",
                      keep: Sequence[str] = ()) -> DataFrame:
    """The four text parts of each line. ``keep`` carries envelope columns along."""
    parts = [line_part(F.col(line), name).alias(name) for name in LINE_PATTERNS]
    return lines.select(*keep, parsed_once(F.struct(*parts)))


def normalize_errors(parts: DataFrame, zone: str | None = None,
                     keep: Sequence[str] = ()) -> DataFrame:
    return parts.select(
        *keep,
        "hostname",
        zoned(line_timestamp(F.col("time")), zone).alias("event_time"),
        "level",
        "message",
    )


def classify_errors(errors: DataFrame) -> DataFrame:
    return errors.withColumn("message_class", message_class(F.col("message")))


def read_errors(lines: DataFrame, line: str = "line", zone: str | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    parts = parse_error_lines(lines, line, keep)
    return classify_errors(normalize_errors(parts, zone, keep))


def error_json(errors: DataFrame) -> DataFrame:
    """One JSON text per error row, for the row-level stream."""
    record = F.struct("hostname", "event_time", "level", "message", "message_class")
    return errors.select(F.to_json(record).alias("json"))


def split_error_lines(lines: DataFrame, line: str = "line",
                      zone: str | None = None) -> DataFrame:
    """The documented full split of a line, with ``event_time`` and numeric ``cid``."""
    parts = lines.select(F.col(line).alias("line"), split_fields(F.col(line)).alias("parts"))
    packed = parts.select("line", packed_fields(F.col("line"), F.col("parts")).alias("packed"))
    fields = [field(F.col("line"), F.col("packed"), n).alias(n) for n in FIELD_NAMES]
    return (
        packed.select("line", parsed_once(F.struct(*fields)))
        .withColumn("cid", F.col("cid").try_cast("bigint"))
        .withColumn("event_time", zoned(line_timestamp(F.col("time")), zone))
    )
