"""Exact quantiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _same(by: Sequence[str], prefix: str):
    pairs = [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in by]
    return reduce(lambda a, b: a & b, pairs, F.lit(True))


def _named(by: Sequence[str], prefix: str) -> list:
    return [F.col(c).alias(f"{prefix}{c}") for c in by]


def _inside(counted: DataFrame, place: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """The values of each group in the range that its place names, with the place's columns."""
    if place is None:
        nothing = F.lit(None).cast(counted.schema["v"].dataType)
        return counted.select("*", nothing.alias("lo"), nothing.alias("hi"),
                              F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("bigint").alias("rank"))
    within = (F.col("lo").isNull() | (F.col("v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("v") <= F.col("hi")))
    return counted.join(place, _same(by, "h_") & within).select(*by, "v", "n", "lo", "hi", "before", "rank")


def _holding_range(counted: DataFrame, place: DataFrame | None, by: Sequence[str], q: float,
                   bins: int, accuracy: int) -> DataFrame:
    """The range (lo, hi] of each group that holds the wanted rank, and the rows before it.

    The ranges' edges come from a sketch of the distinct values that are left, so ranges hold about
    equally many. Sketches may differ when they are computed again, so no row is told by
    the number of its range: a range is named by its values and the count of all rows up to
    ``lo``, which hold whatever edges another computation finds.
    """
    left = _inside(counted, place, by)
    marks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = left.groupBy(*by).agg(
        F.greatest(F.ceil(F.sum("n") * F.lit(q)), F.lit(1)).cast("bigint").alias("e_rank"),
        F.array_distinct(F.percentile_approx("v", marks, accuracy)).alias("e_edges"),
    ).select(*_named(by, "e_"), "e_rank", "e_edges")
    below = F.size(F.filter("e_edges", lambda e: e < F.col("v")))
    binned = left.join(edges, _same(by, "e_")).withColumn("bin", below)
    lower, upper = F.try_element_at("e_edges", F.col("bin")), F.try_element_at("e_edges", F.col("bin") + 1)
    totals = binned.groupBy(*by, "bin").agg(
        F.sum("n").alias("n"), F.first("before").alias("before"),
        F.coalesce(F.first("rank"), F.first("e_rank")).alias("rank"),
        F.greatest(F.first(F.when(F.col("bin") > 0, lower)), F.first("lo")).alias("lo"),
        F.least(F.first(upper), F.first("hi")).alias("hi"),
    )
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*by).orderBy("bin"))
    return (
        totals.withColumn("upto", upto)
        .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        .select(*_named(by, "h_"), "lo", "hi", (F.col("upto") - F.col("n")).alias("before"), "rank")
    )


def levels_needed(values: int, bound: int, bins: int, accuracy: int) -> int:
    """How often a group of so many distinct values must be cut until a range holds at most ``bound``.

    The sketch's ranks are off by at most 1 / accuracy of a group, so a bin between two of its edges
    holds at most (1 / bins + 2 / accuracy) of it, whatever the values are.
    """
    levels, share = 0, 1 / bins + 2 / accuracy
    while values > bound:
        values, levels = int(values * share) + 1, levels + 1
    return levels


def largest_group(rows: DataFrame, by: Sequence[str]) -> int:
    """Rows of the largest group."""
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def exact_quantile(rows: DataFrame, by: Sequence[str], value: str, q: float,
                   bound: int = 100_000, bins: int = 256, accuracy: int = 4_000,
                   largest: int | None = None) -> DataFrame:
    """The smallest value of each group with at least ``q`` of the group at or below it.

    No window sees more than ``bound`` rows of a group. One count of the largest group decides
    the plan: groups within the bound are ranked as they are, with one shuffle. Otherwise rows
    reduce to distinct values with their counts, map-side combined and spread by group and
    value, and as often as the largest group needs it, every group's values are cut into
    ``bins`` ranges of which only the one that holds the rank goes on. Null values do not count.
    ``largest`` is the number of rows of the largest group, or more, where the caller can tell it for less.
    """
    values = rows.select(*by, F.col(value).alias("v")).where(F.col("v").isNotNull())
    group = Window.partitionBy(*by)
    wanted = lambda n: F.greatest(F.ceil(n * F.lit(q)), F.lit(1)).cast("bigint")
    if largest is None:
        largest = largest_group(values, by)
    if largest <= bound:
        ranked = values.select(*by, "v", F.row_number().over(group.orderBy("v")).alias("place"),
                               wanted(F.count(F.lit(1)).over(group)).alias("rank"))
        return ranked.where(F.col("place") == F.col("rank")).select(*by, F.col("v").alias("quantile"))
    counted = values.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    place = None
    for _ in range(levels_needed(min(largest, largest_group(counted, by)), bound, bins, accuracy)):
        place = _holding_range(counted, place, by, q, bins, accuracy)
    left = _inside(counted, place, by)
    if place is None:
        left = left.withColumn("rank", wanted(F.sum("n").over(group)))
    upto = F.col("before") + F.sum("n").over(group.orderBy("v"))
    return (
        left.withColumn("upto", upto)
        .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        .select(*by, F.col("v").alias("quantile"))
    )
