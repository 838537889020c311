"""Helpers that several operators share: shared-folder tables, ranks, word hashes, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text whose words are hashed at once; a longer document is hashed alone.
CHUNK_BYTES = 1 << 20
#: The white space that ends a word: space and the characters 9 to 13.
WORD_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

#: Files whose first places are broadcast at most; of more, they are joined.
BROADCAST_FILES = 1 << 16

_own_folder: list[str] = []


# ---------------------------------------------------------------------------------------
# Tables in the shared folder


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of our own only where none is set (local tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="logloom-llm-"))
    return _own_folder[0]


def cut(frame: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder: lost executors cost no recomputation."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def in_written_order(frame: DataFrame, name: str) -> DataFrame:
    """Add `name`: 0, 1, 2, ... in the order in which a table's rows were written.

    Writers number their files, and a row has an index in its file; only the number of rows of
    each file reaches the driver. Rows that come from no file count in the order of their tasks.
    """
    try:
        at = frame.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    except AnalysisException:
        return frame.withColumn(name, F.monotonically_increasing_id())
    counts = {r[0]: r[1] for r in at.groupBy("_file").count().collect()}
    begins, n = [], 0
    for path in sorted(counts, key=_written):
        begins.append((path, n))
        n += counts[path]
    begin = frame.sparkSession.createDataFrame(begins, "_file string, _begin long")
    if len(begins) <= BROADCAST_FILES:
        begin = F.broadcast(begin)
    return at.join(begin, "_file").withColumn(name, F.col("_begin") + F.col("_index")).drop("_file", "_index", "_begin")


def _written(path: str) -> tuple:
    """Task number and file number of a path such as .../part-00012-...-c003.snappy.parquet."""
    file = path.rsplit("/", 1)[-1]
    task, part = re.match(r"part-(\d+)", file), re.search(r"-c(\d+)(?=\.|$)", file)
    return int(task[1]) if task else -1, int(part[1]) if part else -1, path


def with_columns_of(frame: DataFrame, needed: list[str]) -> DataFrame:
    """Only the needed columns, so that extra ones never clash with those an operator adds."""
    return frame.select(*[F.col(f"`{name}`") for name in needed])


# ---------------------------------------------------------------------------------------
# Ranks within a key, without sorting a key in one task


def ranked(frame: DataFrame, keys: list[str], order: list[str], name: str, parts: int = 32,
           slices: Column | None = None) -> DataFrame:
    """Add `name`: 0, 1, 2, ... within each key.

    A key's rows are spread over `parts` slices, ranked inside each slice, and shifted by the
    rows in the slices before, so a key that holds a third of all rows is no single task.
    The slice totals reduce on the map side to (key, slice) and are joined back.
    Slices come from a hash of the order, so ranks follow it inside a slice only; `slices`, a
    number that never falls along the order, makes them follow it throughout.
    """
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(parts)).cast("int")
    sliced = frame.withColumn("_slice", spread if slices is None else slices)
    totals = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(*keys, "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = sliced.withColumn("_local", F.row_number().over(inside) - F.lit(1))
    return (
        local.join(shifts, [*keys, "_slice"])
        .withColumn(name, (F.col("_local") + F.col("_shift")).cast("long"))
        .drop("_slice", "_local", "_shift")
    )


# ---------------------------------------------------------------------------------------
# Hashes of words and word sequences, a whole batch of texts at a time


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Rolling:
    """Hash of any slice of a sequence from one prefix sum, modulo 2^64."""

    def __init__(self, seed: int):
        self.base = (seed * 2 + 0x5851F42D4C957F2D) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.base, np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.inverse, np.uint64)], dtype=np.uint64)

    def slices(self, values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return _mixed((sums[hi] - sums[lo]) * self.down[lo] + (hi - lo).astype(np.uint64))


#: Bytes of a word that have a table of their own; a later byte uses the table of its place in the next block.
_PLACES = 64
_TABLES = np.random.default_rng(20240501).integers(0, 1 << 64, (_PLACES, 256), dtype=np.uint64).ravel()
_rollings = [_Rolling(1013), _Rolling(77003)]
_is_space = np.zeros(256, bool)
_is_space[list(WORD_SPACE)] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def hash_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and where each text's words begin (one entry more).

    A null text has no words. `lower` turns A-Z into a-z first.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if texts.null_count or last == first:
        texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, last = int(offsets[0]), int(offsets[-1])
    if last == first:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
    edges = offsets - first
    if lower:
        data = _lower[data]
    word = ~_is_space[data]
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    opens[inner] = word[inner]
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    closes[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return _tabulated(data[word], ends - starts), np.searchsorted(starts, edges)


def _tabulated(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each word from one random number for each (place, byte), words side by side in data.

    A sum of random numbers has no pattern that words of some form could share, as the
    powers of one base have; a place beyond the tables mixes its block's number in.
    """
    if not len(lengths):
        return np.empty(0, np.uint64)
    begins = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(begins, lengths)
    far = np.flatnonzero(place >= _PLACES)
    block = place[far] // _PLACES
    place[far] %= _PLACES
    values = _TABLES[place * 256 + data]
    values[far] = _mixed(values[far] + block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _mixed(np.add.reduceat(values, begins) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_runs(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, second: bool = False) -> np.ndarray:
    """Hash of words[lo:hi] for each pair; `second` gives an independent one."""
    return _rollings[1 if second else 0].slices(words, lo, hi)


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about CHUNK_BYTES of text, at least one row each."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(sizes, done + CHUNK_BYTES, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ---------------------------------------------------------------------------------------
# Connected components


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node.

    Alternating stars: each node's neighbours are hung on the smallest of them, first the
    larger ones, then the smaller ones, until every node hangs on its component's smallest.
    Rounds grow with the logarithm of the longest path. Each round is written to the shared
    folder, so its lineage stays short and lost executors cost one round.
    """
    edges = cut(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    last = state(edges)
    while last[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        )
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        edges = cut(small)
        now = state(edges)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
