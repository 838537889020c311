"""Row-level helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_once(record: Column) -> Column:
    """The fields of a struct as columns, computed a single time per row.

    A plain projection would be copied into any filter pushed below it (a batch window
    adds one on the event time), and the text would be parsed again for each copy. Filters
    on generated columns stay above the generator.
    """
    return F.inline_outer(F.array(record))
