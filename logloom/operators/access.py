"""Access log: JSON lines to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.access import event_time, status_class
from logloom.functions.rows import parsed_once

# The access record.
ACCESS_FIELDS = {
    "time": "string",
    "ts": "double",
    "remote": "string",
    "hostname": "string",
    "method": "string",
    "path": "string",
    "status": "int",
    "bytes": "bigint",
    "rt": "double",
}
ACCESS_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in ACCESS_FIELDS.items())


def decode_access(raw: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to the record's columns; bad JSON is one all-null row.

    ``keep`` carries envelope columns along.
    """
    record = parsed_once(F.from_json(F.col(value).cast("string"), ACCESS_SCHEMA))
    return raw.select(*keep, record)


def normalize_access(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed access rows with event time and status class."""
    typed = {name: F.col(name).try_cast(kind) for name, kind in ACCESS_FIELDS.items()}
    return records.select(
        *keep,
        event_time(typed["time"], typed["ts"]).alias("event_time"),
        *[typed[c].alias(c) for c in ("hostname", "method", "path", "status")],
        status_class(typed["status"]).alias("status_class"),
        *[typed[c].alias(c) for c in ("remote", "bytes", "rt")],
    )


def read_access(raw: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    return normalize_access(decode_access(raw, value, keep), keep)


def undated(rows: DataFrame, time: str = "event_time") -> DataFrame:
    """Rows that no window can take: bad input ends up here, not in a metric."""
    return rows.where(F.col(time).isNull())
