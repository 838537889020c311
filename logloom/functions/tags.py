"""Tag values: trimming and defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for a missing host name.
UNKNOWN_HOST = "unknown_host"


def clean_tag(name: str, value: Column) -> Column:
    """Trimmed text; blank is null, except that a blank host gets a name."""
    text = F.nullif(F.trim(value.cast("string")), F.lit(""))
    return F.coalesce(text, F.lit(UNKNOWN_HOST)) if name == "hostname" else text
