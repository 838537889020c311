"""Expressions over access-log columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds outside years 1..9999 cannot be a timestamp.
MIN_EPOCH, MAX_EPOCH = -62135596800, 253402300799


def event_time(iso: Column, epoch: Column) -> Column:
    """ISO-8601 text if it parses, else epoch seconds cut to whole seconds.

    Neither branch raises under ANSI mode: bad input becomes null.
    """
    in_range = epoch.between(F.lit(MIN_EPOCH), F.lit(MAX_EPOCH))
    return F.coalesce(
        F.try_to_timestamp(iso),
        F.when(in_range, F.timestamp_seconds(epoch.cast("bigint"))),
    )


def status_class(status: Column) -> Column:
    """``2xx`` .. ``5xx``; everything else, null included, is ``other``."""
    hundreds = F.floor(status / 100).cast("string")
    return F.when(status.between(200, 599), F.concat(hundreds, F.lit("xx"))).otherwise("other")


def is_error(status: Column) -> Column:
    return status.between(400, 599)


def is_server_error(status: Column) -> Column:
    return status.between(500, 599)
