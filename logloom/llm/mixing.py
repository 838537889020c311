"""Mixing sources to target weights: Pfair scheduling with earliest deadlines first.

Each source's documents, in a hash order, form blocks. With weight w, block i of a source may
start at slot floor(i / w) and must be placed before slot ceil((i + 1) / w); in each slot the
released block with the earliest deadline goes next. After any number of slots of a phase a
source is less than one block away from its target. Weights are taken as they are, as exact
fractions, so nothing adds up over a long table and a rare source is not raised.

The state of the schedule is the next block of each source. The driver walks the slots of all
blocks once and keeps the state at evenly spaced slots, at most STATES of them and one a
phase; tasks schedule from one state to the next, and documents find their block's slot by a
join. When a source runs out, the others go on with their weights scaled up, in a new phase. No
document is dropped or repeated. Ranks in a source that holds most rows are found in slices.

Edge cases: rows with a null source form a source of their own; repeated rows and null ids are
placed like others; a single source keeps its hash order; extra columns are kept, but the result's
`slot` and `position` replace input columns of these names; texts of any length pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

#: Documents of a block.
BLOCK = 8
#: Slots from one kept state to the next at least, and about the most states kept.
PERIOD, STATES = 1000, 4096


def exact_weights(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportions of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*[x.denominator for x in exact.values()])
    return {s: int(x * unit) for s, x in exact.items()}


def turns(weights: dict[str, int], start: int = 0, first: dict[str, int] | None = None) -> Iterator[tuple[int, str, int]]:
    """(slot, source, block) from the start slot on, when the next block of each source is `first`."""
    total = sum(weights.values())
    waiting = [(i * total // weights[s], s, i) for s, i in sorted((first or dict.fromkeys(weights, 0)).items())]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    t = start
    while True:
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // weights[s]), s, i))
        _, s, i = heapq.heappop(ready)
        yield t, s, i
        heapq.heappush(waiting, ((i + 1) * total // weights[s], s, i + 1))
        t += 1


def phases(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD):
    """[(weights, first slot, blocks placed before)] and [(phase, slot in it, slots, next block of each source)]."""
    plan, states = [], []
    every = max(period, -(-sum(blocks.values()) // STATES))
    done, base = {s: 0 for s in blocks}, 0
    while left := {s: n - done[s] for s, n in blocks.items() if n > done[s]}:
        # Sources without a weight share what is left when the others have run out.
        if not any(weights[s] > 0 for s in left):
            weights = {**weights, **dict.fromkeys(left, 1)}
        left = {s: n for s, n in left.items() if weights[s] > 0}
        share = exact_weights({s: weights[s] for s in left})
        plan.append((share, base, {s: done[s] for s in left}))
        following, last = dict.fromkeys(left, 0), 0
        for t, s, i in turns(share):
            if t % every == 0:
                states.append([len(plan) - 1, t, every, dict(following)])
            following[s], last = i + 1, t + 1
            if i + 1 == left[s]:
                break
        states[-1][2] = last - states[-1][1]
        for s in left:
            done[s] += following[s]
        base += last
    return plan, states


def scheduled(spark: SparkSession, blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> DataFrame:
    """(_source, _at, slot): the slot of every block, from the kept states."""
    plan, states = phases(blocks, weights, period)

    def run(batches):
        for batch in batches:
            for k in batch.column("k").to_pylist():
                phase, start, n, following = states[k]
                share, base, before = plan[phase]
                rows = [x for x, _ in zip(turns(share, start, following), range(n))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for _, s, _ in rows], pa.string()), pa.array([before[s] + i for _, s, i in rows], pa.int64()),
                     pa.array([base + t for t, _, _ in rows], pa.int64())], ["_source", "_at", "slot"])

    return spark.range(len(states)).select(F.col("id").alias("k")).mapInArrow(run, "_source string, _at long, slot long")


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """docs(doc_id, source, ...) with slot and position; order by position to read the mix.

    Without weights, a source weighs the square root of its number of documents. With them, the key
    None is the weight of rows without a source; sources that are left out or weigh 0 come, with
    equal weights, when the others have run out, since no document is dropped. Sources and
    their weights are a small table by nature: one entry a source reaches the driver.
    """
    if weights is not None and any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("slot", "position")]).alias("_row"),
        F.coalesce(F.concat(F.lit("s:"), F.col("source")), F.lit("null")).alias("_source"),
        F.xxhash64("doc_id").alias("_order"), F.col("doc_id").alias("_id"),
    )
    ship_package(docs.sparkSession)
    counts = {r[0]: r[1] for r in keyed.groupBy("_source").count().collect()}
    if weights is None:
        wanted = {s: n ** 0.5 for s, n in counts.items()}
    else:
        wanted = {s: weights.get(None if s == "null" else s[2:], 0) for s in counts}
    steps = scheduled(docs.sparkSession, {s: -(-n // block) for s, n in counts.items()}, wanted, period)
    placed = common.ranked(keyed, ["_source"], ["_order", "_id"], "_rank").select(
        "_row", "_source", "_rank", F.floor(F.col("_rank") / block).alias("_at"))
    found = placed.join(steps, ["_source", "_at"])
    return found.select("_row.*", "slot", (F.col("slot") * block + F.col("_rank") % block).alias("position"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return mix(docs)
