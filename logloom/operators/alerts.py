"""Alert rules over metric points: evaluate, threshold, hold."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.durations import interval, length, micros_in
from logloom.operators.points import stack
from logloom.operators.timeseries import fill_grid, instant

NORMAL, PENDING, FIRING, NO_DATA = "Normal", "Pending", "Firing", "NoData"


@dataclass(frozen=True)
class Clock:
    """Evaluation every ``every`` over the last ``lookback``.

    ``every`` and ``lookback`` are whole multiples of ``bucket``, so the buckets of a
    trend line up with the evaluations.
    """

    every: str = "5 minutes"
    lookback: str = "10 minutes"
    bucket: str = "5 minutes"

    def __post_init__(self) -> None:
        every, lookback, bucket = (length(d) for d in (self.every, self.lookback, self.bucket))
        if every % bucket or lookback % bucket or lookback < every:
            raise ValueError("every and lookback must be whole multiples of bucket, and lookback at least every")


@dataclass(frozen=True)
class Rule:
    name: str
    title: str
    signal: str
    threshold: float
    hold: str
    severity: str | None = None
    component: str | None = None
    host: str | None = None


# The deployed rules.
RULES = (
    Rule("any_host", "High anomaly score on any host", "host_max", 20, "5 minutes"),
    Rule("trend_web1", "Anomaly trend - Web1 (mean 5m) > 20", "trend", 20, "5 minutes",
         "critical", "web1", "web1"),
    Rule("trend_web2", "Anomaly trend - Web2 (mean 5m) > 20", "trend", 20, "5 minutes",
         "critical", "web2", "web2"),
    Rule("trend_web3", "Anomaly trend - Web3 (mean 5m) > 20", "trend", 20, "5 minutes",
         "critical", "web3", "web3"),
    Rule("max_score", "Max anomaly score (last 10m) > 20", "max", 20, "2 minutes",
         "critical", "anomaly-gauge"),
    Rule("top_error_path", "Top error path/host - error_count > 10", "top_error", 10,
         "5 minutes", "warning", "http-errors"),
    Rule("total_5xx", "HTTP 5xx errors (sum last 10m) > 10", "total_5xx", 10,
         "5 minutes", "warning", "http-5xx"),
)


def evaluations(clock: Clock, time: str = "time") -> Column:
    """The evaluations whose look-back covers a point.

    An overlapping window puts a point into each of its few evaluations, which spares
    a range join between points and evaluations.
    """
    return F.window(time, clock.lookback, clock.every).alias("w")


def anomaly_signals(anomaly: DataFrame, clock: Clock) -> DataFrame:
    """Three signals from one read of the anomaly points.

    ``trend``: mean score, per host and kind, of the newest bucket inside the look-back.
    ``host_max``: highest score per host. ``max``: highest score of all. Points are first
    reduced to buckets; the levels then come from those by grouping sets.
    """
    buckets = (
        anomaly.groupBy(F.window("time", clock.bucket).alias("b"), "hostname", "kind")
        .agg(F.avg("score").alias("mean"), F.max("score").alias("best"))
        .select(F.window_time("b").alias("time"), "hostname", "kind", "mean", "best")
    )
    sets = [["w", "hostname", "kind"], ["w", "hostname"], ["w"]]
    levels = (
        buckets.select(evaluations(clock), "*")
        .groupingSets(sets, "w", "hostname", "kind")
        .agg(F.max_by("mean", "time").alias("newest"), F.max("best").alias("best"),
             F.grouping_id().alias("level"))
    )
    per_kind, per_host = F.col("level") == 0, F.col("level") == 1
    return levels.select(
        F.when(per_kind, "trend").when(per_host, "host_max").otherwise("max").alias("signal"),
        F.when(per_kind, F.concat(F.col("hostname"), F.lit(" | "), F.col("kind")))
        .when(per_host, F.col("hostname")).otherwise("").alias("series"),
        F.col("hostname").alias("host"),
        F.col("w.end").alias("evaluated"),
        F.when(per_kind, F.col("newest")).otherwise(F.col("best")).alias("value"),
    )


def url_signals(urls: DataFrame, clock: Clock) -> DataFrame:
    """Two signals from one read of the URL points.

    ``top_error``: largest 4xx/5xx count of one host, path and status. ``total_5xx``: all
    5xx answers.
    """
    text = F.col("status").cast("string")
    keys = ("hostname", "path", "status")
    sums = (
        urls.where(text.rlike("^[45]")).groupBy(evaluations(clock), *keys)
        .agg(F.sum("count").alias("n"))
    )
    both = sums.groupBy("w").agg(
        F.max("n").cast("double").alias("top_error"),
        F.sum(F.when(text.rlike("^5"), F.col("n"))).cast("double").alias("total_5xx"),
    )
    named = [F.struct(F.lit(s).alias("signal"), F.col(s).alias("value"))
             for s in ("top_error", "total_5xx")]
    return (
        both.select(F.col("w.end").alias("evaluated"), F.inline(F.array(*named)))
        .where(F.col("value").isNotNull())
        .select("signal", F.lit("").alias("series"), F.lit(None).cast("string").alias("host"),
                "evaluated", "value")
    )


TABLE_SIGNALS: dict[str, Callable[[DataFrame, Clock], DataFrame]] = {
    "anomaly": anomaly_signals,
    "top_urls": url_signals,
}
SIGNAL_TABLE = {
    "trend": "anomaly", "host_max": "anomaly", "max": "anomaly",
    "top_error": "top_urls", "total_5xx": "top_urls",
}
SINGLE_SERIES = ("max", "top_error", "total_5xx")


def rule_structs(rules: Sequence[Rule]) -> Column:
    """The rules as a literal array, to be unfolded next to the values they watch."""
    return F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(float(r.threshold)).alias("threshold"),
            micros_in(r.hold).alias("hold_micros"),
            F.lit(r.signal).alias("watched"),
            F.lit(r.host).cast("string").alias("only"),
        )
        for r in rules
    ])


CELL = ("rule", "series", "threshold", "hold_micros", "evaluated", "value")


def signals(tables: Mapping[str, DataFrame], rules: Sequence[Rule], clock: Clock) -> DataFrame:
    """Value per rule, series and evaluation; one read of each table serves all rules."""
    used = dict.fromkeys(SIGNAL_TABLE[r.signal] for r in rules)
    values = stack([TABLE_SIGNALS[t](tables[t], clock) for t in used])
    watching = F.filter(
        rule_structs(rules),
        lambda r: (r["watched"] == F.col("signal"))
        & (r["only"].isNull() | (r["only"] == F.col("host"))),
    )
    return values.select("series", "evaluated", "value", F.inline(watching)).select(*CELL)


def breaches(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = RULES,
             clock: Clock = Clock()) -> DataFrame:
    """Evaluations whose value lies strictly above the rule's threshold."""
    cells = signals(tables, rules, clock)
    return cells.where(F.col("value") > F.col("threshold")).select(
        "rule", "series", "evaluated", "value"
    )


def alert_states(tables: Mapping[str, DataFrame], start: str, stop: str,
                 rules: Sequence[Rule] = RULES, clock: Clock = Clock()) -> DataFrame:
    """State of every series of every rule at every evaluation in (start, stop].

    An evaluation without points is a null value, which is ``NoData``. A rule that finds no
    series in the range reports it for the rule itself, as the empty series.
    """
    narrowed = {}
    for name, table in tables.items():
        reach = instant(table, start) - interval(clock.lookback)
        narrowed[name] = table.where(
            (F.col("time") >= reach) & (F.col("time") < instant(table, stop))
        )
    values = signals(narrowed, rules, clock)
    kind = values.schema["evaluated"].dataType
    lo, hi = F.lit(start).cast(kind), F.lit(stop).cast(kind)
    inside = values.where((F.col("evaluated") > lo) & (F.col("evaluated") <= hi))

    def bounded(rows: DataFrame) -> DataFrame:
        grid = rows.withColumn("first", F.window(lo, clock.every)["end"])
        return grid.withColumn("last", F.window(hi, clock.every)["start"])

    single = F.col("watched").isin(*SINGLE_SERIES)
    seeds = values.sparkSession.range(1).select(F.inline(rule_structs(rules)))
    # One-series rules always have their series; the others only if they find none.
    silent = seeds.where(~single).join(inside.select("rule").distinct(), "rule", "left_anti")
    seeds = bounded(seeds.where(single).unionByName(silent, allowMissingColumns=True)).select(
        "rule", F.lit("").alias("series"), "threshold", "hold_micros",
        F.col("first").alias("evaluated"), F.lit(None).cast("double").alias("value"),
        "first", "last",
    )
    cells = bounded(inside).unionByName(seeds)
    cells = fill_grid(cells, ["rule", "series"], "evaluated", "value",
                      F.col("first"), F.col("last"), clock.every)
    return held(cells).select(
        "rule", *[label(rules, a).alias(a) for a in ("title", "severity", "component")],
        "series", "evaluated", "value", "state",
    )


def label(rules: Sequence[Rule], attribute: str) -> Column:
    pairs = [F.lit(x).cast("string") for r in rules for x in (r.name, getattr(r, attribute))]
    return F.create_map(*pairs)[F.col("rule")]


def held(cells: DataFrame) -> DataFrame:
    """Pending from the first breach; firing once the breach has lasted the hold.

    The window runs over the evaluations of one series: as many rows as the range has
    evaluations, whatever the number of points.
    """
    order = Window.partitionBy("rule", "series").orderBy("evaluated")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    breach = F.coalesce(F.col("value") > F.col("threshold"), F.lit(False))
    before = F.coalesce(F.lag("breach").over(order), F.lit(False))
    began = F.when(F.col("breach") & ~before, F.unix_micros(F.col("evaluated").cast("timestamp")))
    lasted = F.unix_micros(F.col("evaluated").cast("timestamp")) - F.col("since")
    state = (
        F.when(F.col("value").isNull(), NO_DATA)
        .when(~F.col("breach"), NORMAL)
        .when(lasted >= F.col("hold_micros"), FIRING)
        .otherwise(PENDING)
    )
    return (
        cells.withColumn("breach", breach)
        .withColumn("began", began)
        .withColumn("since", F.last("began", ignorenulls=True).over(so_far))
        .withColumn("state", state)
    )
