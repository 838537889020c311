"""Expressions over raw error-log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the error-log line format.
LINE_PATTERNS = {
    "time": r"^(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})",
    "level": r"\[(\w+)\]",
    "hostname": r'host: "([^"]+)"',
    "message": r"\d+#\d+: \*\d+ (.+?), host: .*",
}
LINE_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"

# Message classes in order of precedence.
MESSAGE_CLASSES = (
    ("connection_failed", r"connect\(\) failed"),
    ("timeout", r"timed out"),
    ("not_found", r"not found"),
)
OTHER_CLASS = "other"

# The documented full split, anchored at both ends.
FIELD_NAMES = (
    "time", "level", "cid", "message", "client",
    "server", "request", "upstream", "host", "referrer",
)
FIELD_PATTERN = (
    r"^(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) \[(\w+)\] \d+#\d+: \*(\d+) "
    r"(.*?)"
    r"(?:, client: ([^,]+))?"
    r"(?:, server: ([^,]*))?"
    r'(?:, request: "([^"]+)")?'
    r'(?:, upstream: "([^"]+)")?'
    r'(?:, host: "([^"]+)")?'
    r'(?:, referrer: "([^"]+)")?$'
)
_SEPARATOR = "\u0001"


def line_part(line: Column, name: str) -> Column:
    """One part of a line; empty string where the pattern is absent."""
    return F.regexp_extract(line, LINE_PATTERNS[name], 1)


def line_timestamp(text: Column) -> Column:
    """Zone-less line time, read in the session time zone; null if unreadable."""
    return F.try_to_timestamp(text, F.lit(LINE_TIME_FORMAT))


def message_class(message: Column) -> Column:
    """Name of the first class whose pattern occurs in the message."""
    hits = [F.when(message.rlike(pattern), F.lit(name)) for name, pattern in MESSAGE_CLASSES]
    return F.coalesce(*hits, F.lit(OTHER_CLASS))


def split_fields(line: Column) -> Column:
    """All ten fields of a line by one regex pass, as an array.

    The rewrite joins the groups by a control character and ``split`` takes them apart, so
    the pattern runs once a line rather than once a field. Other sizes than ten come from
    lines that do not match.
    """
    groups = _SEPARATOR.join(f"${i + 1}" for i in range(len(FIELD_NAMES)))
    return F.split(F.regexp_replace(line, FIELD_PATTERN, groups), _SEPARATOR, -1)


def packed_fields(line: Column, parts: Column) -> Column:
    """The array, or null for lines it cannot be trusted for: those that do not match or
    carry the control character themselves."""
    usable = (F.size(parts) == len(FIELD_NAMES)) & ~F.contains(line, F.lit(_SEPARATOR))
    return F.when(usable, parts)


def field(line: Column, packed: Column, name: str) -> Column:
    """One field: from the packed array; empty for lines that do not match; and by a regex
    of its own for the odd line that carries the control character."""
    i = FIELD_NAMES.index(name)
    return (
        F.when(packed.isNotNull(), packed[i])
        .when(~F.contains(line, F.lit(_SEPARATOR)), "")
        .otherwise(F.regexp_extract(line, FIELD_PATTERN, i + 1))
    )
