"""Operators over metric points: ranges, downsampling, filling, ranking, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.durations import interval


def instant(points: DataFrame, value: str, time: str = "time") -> Column:
    """A literal instant of the same type as the time column."""
    return F.lit(value).cast(points.schema[time].dataType)


def in_range(points: DataFrame, start: str, stop: str, time: str = "time") -> DataFrame:
    """Points with start <= time < stop, pruned by date where the table has one."""
    lo, hi = instant(points, start, time), instant(points, stop, time)
    if "date" in points.columns:
        points = points.where(F.col("date").between(F.to_date(lo), F.to_date(hi)))
    return points.where((F.col(time) >= lo) & (F.col(time) < hi))


def since(points: DataFrame, now: str, lookback: str, time: str = "time") -> DataFrame:
    """The last ``lookback`` before an explicit ``now``."""
    hi = instant(points, now, time)
    lo = hi - interval(lookback)
    if "date" in points.columns:
        points = points.where(F.col("date").between(F.to_date(lo), F.to_date(hi)))
    return points.where((F.col(time) >= lo) & (F.col(time) < hi))


def raw_rows(rows: DataFrame, start: str, stop: str, window: str,
             time: str = "event_time") -> DataFrame:
    """Rows whose window of this length can end at or after ``start`` and before ``stop``.

    A range on points is a range on computed window ends, which no scan can use. This bound
    on the raw time goes before the rollup and reaches the scan.
    """
    lo, hi = instant(rows, start, time), instant(rows, stop, time)
    return rows.where((F.col(time) >= lo - interval(window)) & (F.col(time) < hi))


def downsample(points: DataFrame, every: str, by: Sequence[str], aggregate: Column,
               time: str = "time") -> DataFrame:
    """One aggregate per bucket and series; the bucket's end is the new time."""
    bucket = F.window(time, every).alias("bucket")
    out = points.groupBy(bucket, *by).agg(aggregate)
    return out.withColumn("time", F.col("bucket.end")).drop("bucket")


def fill_grid(cells: DataFrame, by: Sequence[str], at: str, value: str,
              first: Column, last: Column, every: str) -> DataFrame:
    """Every grid step from ``first`` to ``last`` for each series, null where it has no cell.

    Each cell also emits the steps up to its successor, so the grid needs no second read
    and no join. The window holds one row per cell of a series: at most the number of grid
    steps, however many points were summed into them. Two cells may share a step if one of
    them is a null seed.
    """
    order = Window.partitionBy(*by).orderBy(at, F.col(value).isNotNull())
    begin = F.when(F.lag(at).over(order).isNull(), first).otherwise(F.col(at))
    end = F.coalesce(F.lead(at).over(order) - interval(every), last)
    spans = cells.withColumns({"begin": begin, "end": end})
    steps = F.sequence("begin", "end", interval(every))
    unfolded = spans.where(F.col("begin") <= F.col("end")).withColumn("step", F.explode(steps))
    held = F.when(F.col("step") == F.col(at), F.col(value)).alias(value)
    kept = [c for c in cells.columns if c not in (at, value)]
    return unfolded.select(*kept, F.col("step").alias(at), held)


def zero_filled_sums(points: DataFrame, value: str, by: Sequence[str], every: str,
                     start: str, stop: str) -> DataFrame:
    """Bucket sums over the whole range, 0.0 where a series has no point."""
    lo, hi = instant(points, start), instant(points, stop)
    sums = (
        in_range(points, start, stop)
        .groupBy(F.window("time", every).alias("span"), *by)
        .agg(F.sum(F.col(value).cast("double")).alias("value"))
        .select(F.col("span.start").alias("bucket"), *by, "value")
        .withColumn("first", F.window(lo, every)["start"])
        .withColumn("last", F.window(hi - F.expr("INTERVAL 1 microsecond"), every)["start"])
    )
    filled = fill_grid(sums, by, "bucket", "value", F.col("first"), F.col("last"), every)
    return filled.select(
        F.least(F.col("bucket") + interval(every), hi).alias("time"), *by,
        F.coalesce("value", F.lit(0.0)).alias("value"),
    )


def top_k(rows: DataFrame, k: int, by: Sequence[Column | str]) -> DataFrame:
    """The first k rows: each task keeps k, only those meet."""
    return rows.orderBy(*by).limit(k)


def first_k_per_group(rows: DataFrame, k: int, group: Sequence[str],
                      by: Sequence[Column | str]) -> DataFrame:
    """The first k rows of each group.

    Spark cuts each group to k in every task before the shuffle (WindowGroupLimit),
    so a group that holds much of the data still sends k rows a task.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*by))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def with_share(rows: DataFrame, value: str, share: str = "share") -> DataFrame:
    """Percent of the column's total, for report rows.

    The rows are a report's groups, reduced before; one window over them spares a second
    run of the input that a separate total would cost.
    """
    total = F.sum(value).over(Window.partitionBy(F.lit(0)))
    return rows.withColumn(share, F.try_divide(F.col(value) * F.lit(100.0), total))


def totals(points: DataFrame, by: Sequence[str], name: str = "count",
           value: str = "count") -> DataFrame:
    return points.groupBy(*by).agg(F.sum(value).alias(name))
