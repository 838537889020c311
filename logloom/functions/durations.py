"""Duration text ("10 seconds", "1 hour") as columns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def interval(duration: str) -> Column:
    return F.expr(f"INTERVAL {duration}")


def micros_in(duration: str) -> Column:
    """Length in microseconds; Spark folds it to a constant."""
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + interval(duration))


def seconds_in(duration: str) -> Column:
    """Length in seconds as a double."""
    return micros_in(duration) / F.lit(1e6)


def length(duration: str) -> timedelta:
    """Length as a Python value, for checks on the driver: one number and a unit up to weeks."""
    number, unit = duration.split()
    return timedelta(**{unit.rstrip("s") + "s": int(number)})
