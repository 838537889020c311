"""Line-protocol text of a point as one column expression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.tags import clean_tag


def escape_tag(text: Column) -> Column:
    """Backslash before comma, space and equals sign."""
    for mark in (",", " ", "="):
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def quote_field(text: Column) -> Column:
    """Double-quoted text with backslash and quote escaped."""
    for mark in ("\\", '"'):
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return F.concat(F.lit('"'), text, F.lit('"'))


def float_text(value: Column) -> Column:
    """Decimal text of a double: positional from 1e-4 up to 1e16, scientific beyond.

    Spark's own text is scientific outside [1e-3, 1e7); the decimal cast moves the point
    without changing a digit.
    """
    raw, size = value.cast("string"), F.abs(value)
    moved = raw.try_cast("decimal(38,21)").cast("string")
    positional = F.regexp_replace(moved, r"(\.\d+?)0+$", "$1")
    scientific = F.regexp_replace(raw, r"(?:\.0)?E(\d)", "e+$1")
    scientific = F.regexp_replace(scientific, r"(?:\.0)?E-", "e-")
    scientific = F.regexp_replace(scientific, r"e([+-])(\d)$", "e$10$2")
    return (
        F.when(~F.contains(raw, F.lit("E")), raw)
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(scientific)
    )


def is_written(value: Column, kind: T.DataType) -> Column:
    """Whether a field has a value that the protocol can carry."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return value.isNotNull()


def field_text(name: str, value: Column, kind: T.DataType) -> Column:
    """``name=value`` in the notation of the field's type; null leaves it out."""
    if isinstance(kind, T.BooleanType):
        text = F.when(value, "1i").when(~value, "0i")
    elif isinstance(kind, T.IntegralType):
        text = F.concat(value.cast("string"), F.lit("i"))
    elif isinstance(kind, T.FractionalType):
        text = F.when(is_written(value, kind), float_text(value.cast("double")))
    else:
        text = quote_field(value.cast("string"))
    return F.concat(F.lit(f"{name}="), text)


def series_key(tags: Sequence[str]) -> Column:
    """``tag=value`` pairs in the given order, blank tags left out."""
    pairs = [
        F.concat(F.lit(f"{tag}="), escape_tag(clean_tag(tag, F.col(tag)))) for tag in tags
    ]
    return F.concat_ws(",", *pairs)


def nanos(time: Column) -> Column:
    """Whole epoch seconds in nanoseconds."""
    return F.unix_seconds(time.cast("timestamp")) * F.lit(1_000_000_000)


def line(measurement: str, schema: T.StructType, tags: Sequence[str],
         fields: Sequence[str], time: str = "time") -> Column:
    """The point's line."""
    body = F.concat_ws(",", *[field_text(f, F.col(f), schema[f].dataType) for f in fields])
    return F.concat(
        F.lit(f"{measurement},"), series_key(tags), F.lit(" "), body, F.lit(" "),
        nanos(F.col(time)).cast("string"),
    )


def has_line(schema: T.StructType, fields: Sequence[str], time: str = "time") -> Column:
    """Whether a point can be written: it has a time and at least one field value."""
    written = [is_written(F.col(f), schema[f].dataType) for f in fields]
    return F.col(time).isNotNull() & reduce(lambda a, b: a | b, written)
