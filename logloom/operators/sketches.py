"""Mergeable sketches as point fields: quantiles and distinct counts over any span without raw rows.

A point of the `sketches` table holds a KLL sketch of the response times and a HyperLogLog sketch of the
client addresses of one window and host. Points of many windows and hosts merge to sketches of all
their rows, with the error of one sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.config import DEFAULT_WATERMARK, DEFAULT_WINDOW
from logloom.operators.points import Measurement
from logloom.operators.rollups import rollup

SKETCHES = Measurement("sketches", ("env", "hostname"), ("count", "rt_sketch", "client_sketch"))
#: Size of the quantile sketch; its rank is off by less than RANK_ERROR with 99 % confidence
#: (2.296 / K ^ 0.9723, the library's published bound).
K, RANK_ERROR = 800, 0.0035
#: Size of the distinct-count sketch (2 ^ LOG_K cells); three standard errors of its estimate.
LOG_K, COUNT_ERROR = 12, 3 * 0.0163


def sketch_rollup(access: DataFrame, window: str = DEFAULT_WINDOW,
                  watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Requests and sketches per window and host, in batch and stream; sketches merge on the map side."""
    totals = rollup(access, window, ["hostname"], [
        F.count(F.lit(1)).alias("count"),
        F.kll_sketch_agg_double("rt", K).alias("rt_sketch"),
        F.hll_sketch_agg("remote", LOG_K).alias("client_sketch"),
    ], watermark)
    return totals.select("window_end", "hostname", "count", "rt_sketch", "client_sketch")


def _merged() -> list[Column]:
    return [F.sum("count").alias("count"), F.kll_merge_agg_double("rt_sketch", K).alias("rt_sketch"),
            F.hll_union_agg("client_sketch").alias("client_sketch")]


def merge(points: DataFrame, by: Sequence[str], every: str | None = None) -> DataFrame:
    """Points merged over ``by``, and over buckets of time (labelled by their end) with ``every``.

    A point's time is its window's end, so a bucket takes the windows that ended in it.
    """
    if every is None:
        return points.groupBy(*by).agg(*_merged())
    inside = points.withColumn("time", F.col("time") - F.expr("INTERVAL 1 MICROSECOND"))
    buckets = inside.groupBy(F.window("time", every)["end"].alias("time"), *by)
    return buckets.agg(*_merged())


def response_time(q: float, sketch: str = "rt_sketch") -> Column:
    """The estimated quantile of the response times of merged points."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(q)))


def clients(sketch: str = "client_sketch") -> Column:
    """The estimated number of different clients of merged points."""
    return F.hll_sketch_estimate(sketch)
