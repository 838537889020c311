from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.operators import timeseries as ts
from logloom.operators import quantiles
from logloom.operators.quantiles import exact_quantile
from logloom.plans import reports
from tests.conftest import rows

DAY = datetime(2025, 1, 1)


def points(spark, values):
    """(minute, host, value) triples."""
    return spark.createDataFrame(
        [(DAY + timedelta(minutes=m), h, v) for m, h, v in values],
        "time timestamp, host string, count double")


def test_range_is_half_open(spark):
    frame = points(spark, [(0, "a", 1.0), (10, "a", 2.0), (20, "a", 3.0)])
    got = ts.in_range(frame, "2025-01-01 00:00:00", "2025-01-01 00:20:00")
    assert sorted(r["count"] for r in got.collect()) == [1.0, 2.0]
    last = ts.since(frame, "2025-01-01 00:20:00", "10 minutes")
    assert [r["count"] for r in last.collect()] == [2.0]


def test_range_reaches_the_scan(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = ts.in_range(frame, "2024-01-02", "2024-01-03", "ts")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in text


def test_downsample_labels_bucket_ends_and_omits_empty(spark):
    frame = points(spark, [(0, "a", 1.0), (4, "a", 3.0), (10, "a", 5.0)])
    got = rows(ts.downsample(frame, "5 minutes", ["host"], F.avg("count").alias("v")))
    assert [(r["time"], r["v"]) for r in got] == [
        (DAY + timedelta(minutes=5), 2.0), (DAY + timedelta(minutes=15), 5.0)]


def test_zero_fill_covers_the_range(spark):
    frame = points(spark, [(7, "a", 1.0), (8, "a", 2.0), (16, None, 4.0), (99, "c", 1.0)])
    got = ts.zero_filled_sums(frame, "count", ["host"], "5 minutes", "2025-01-01 00:00:00",
                              "2025-01-01 00:20:00")
    table = {(r.host, r.time.minute): r.value for r in got.collect()}
    assert table == {
        ("a", 5): 0.0, ("a", 10): 3.0, ("a", 15): 0.0, ("a", 20): 0.0,
        (None, 5): 0.0, (None, 10): 0.0, (None, 15): 0.0, (None, 20): 4.0,
    }


def test_zero_fill_clips_the_last_bucket(spark):
    frame = points(spark, [(3, "a", 1.0)])
    got = ts.zero_filled_sums(frame, "count", ["host"], "5 minutes", "2025-01-01 00:02:00",
                              "2025-01-01 00:12:00")
    assert sorted((r.time.minute, r.value) for r in got.collect()) == [
        (5, 1.0), (10, 0.0), (12, 0.0)]


def test_first_k_per_group_is_cut_before_the_shuffle(spark):
    frame = points(spark, [(m, h, float(m)) for m in range(50) for h in "ab"])
    top = ts.first_k_per_group(frame, 2, ["host"], [F.desc("count")])
    assert sorted((r.host, r["count"]) for r in top.collect()) == [
        ("a", 48.0), ("a", 49.0), ("b", 48.0), ("b", 49.0)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_top_k_and_share(spark):
    frame = points(spark, [(0, "a", 1.0), (0, "b", 3.0), (0, "c", 3.0)])
    assert [r.host for r in ts.top_k(frame, 2, [F.desc("count"), "host"]).collect()] == ["b", "c"]
    shares = {r.host: r.share for r in ts.with_share(frame, "count").collect()}
    assert shares["a"] == pytest.approx(100 / 7) and sum(shares.values()) == pytest.approx(100)


@pytest.mark.parametrize("q", [0.05, 0.95, 1.0])
@pytest.mark.parametrize("bound, bins", [(60, 3), (300, 64), (3_000, 64), (100_000, 256)])
def test_quantile_against_sorting(spark, q, bound, bins):
    rng = random.Random(7)
    data = [("hot", round(rng.expovariate(1.0), 3)) for _ in range(6_000)]
    data += [(f"k{i % 40}", float(rng.randrange(50))) for i in range(2_000)]
    data += [(None, 1.0), (None, 2.0), ("one", 5.0), ("null", None), ("hot", None)]
    frame = spark.createDataFrame(data, "k string, v double").repartition(6)
    got = {r.k: r.quantile for r in exact_quantile(frame, ["k"], "v", q, bound, bins, 50).collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert got == {k: sorted(v)[max(math.ceil(q * len(v)), 1) - 1] for k, v in groups.items()}


def test_quantile_windows_are_bounded(spark):
    """A million different values in one group beside small groups: no window over the bound."""
    bound, bins, accuracy = 2_000, 256, 4_000
    values = spark.range(1_000_000).select(
        F.lit("hot").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10**15)) / 1e3).alias("v"))
    small = spark.range(3_000).select(F.concat(F.lit("s"), F.col("id") % 30).alias("k"), F.col("id").cast("double").alias("v"))
    frame = values.unionByName(small)
    assert [quantiles.levels_needed(n, bound, bins, accuracy) for n in (2_000, 2_001, 10**6, 10**9)] == [0, 1, 2, 3]
    counted = frame.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    place = None
    for _ in range(2):
        place = quantiles._holding_range(counted, place, ["k"], 0.95, bins, accuracy)
    assert 0 < quantiles.largest_group(quantiles._inside(counted, place, ["k"]), ["k"]) <= bound
    got = {r.k: r.quantile for r in exact_quantile(frame, ["k"], "v", 0.95, bound).collect()}
    expected = frame.groupBy("k").agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY v)").alias("v"))
    assert got == {r.k: r.v for r in expected.collect()} and len(got) == 31


def test_labels_with_a_missing_part_are_null(spark):
    frame = points(spark, [(0, None, 1.0)])
    assert frame.select(reports.label("host", "count")).first()[0] is None


def test_max_score_takes_the_first_time(spark):
    frame = points(spark, [(9, "a", 2.0), (3, "a", 2.0), (1, "a", 1.0)]).withColumnsRenamed(
        {"host": "hostname", "count": "score"})
    row = reports.max_score_by_host(frame).first()
    assert (row.score, row.time) == (2.0, DAY + timedelta(minutes=3))
    assert reports.max_score(frame).first().score == 2.0


def test_quantile_shuffles_no_raw_rows(spark):
    frame = spark.range(40_000).select(F.lit("hot").alias("k"), (F.col("id") % 100).cast("double").alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = exact_quantile(frame, ["k"], "v", 0.95, bound=20)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert [r.quantile for r in got.collect()] == [94.0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Every exchange above the scan carries counted values, bounds or totals.
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "Exchange" in line:
            assert "HashAggregate" in lines[at + 1] or "AQEShuffleRead" in lines[at + 1] or (
                "Range" not in lines[at + 1] and "Filter" not in lines[at + 1]), lines[at + 1]
    assert "BroadcastExchange" not in plan
