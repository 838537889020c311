"""Best-fit packing by linear grouping.

Token pieces go into sequences of `capacity` tokens:

1. Only the number of pieces of each length reaches the driver (at most `capacity` numbers).
2. Large lengths, longest first, fall into `GROUPS` groups of equal cardinality, and each
   group counts as its longest length. Configurations (multisets of these few sizes that fit)
   are optimised one after the other: the largest size left, filled up best by the others,
   used as often as the counts allow.
3. The actual pieces take their group's places by rank; a sequence's real slack is larger.
4. Small pieces, longest first, go to the sequence with the least slack that holds them. The
   plan moves whole classes of equal slack, so it has a bounded number of entries whatever
   the number of pieces; Spark looks every piece up by its rank.

With an order column (one number a row, such as the places of a mix), pieces of equal length and
sequences of equal slack are taken in that order, and sequences are numbered by the place of the piece that
begins them. Without one, both follow hashes of the ids.

Edge cases: a null text is empty (one token, the end mark); rows that repeat a doc_id are packed
one by one; a null doc_id stays null; extra columns are ignored; an empty table packs to an
empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

CAPACITY = 2048
#: Groups of equal cardinality among the large pieces.
GROUPS = 64
#: A piece is large if it is longer than this part of the capacity.
LARGE = 1 / 8
#: Word encodings that a Python worker keeps, and the longest word kept.
CACHE, CACHED_CHARS = 250_000, 48
#: Fixed value: the pattern that splits a text before the merges of a byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict = {}
_space_run = re.compile(r"\s |^ | $| \s")
_single_space = re.compile(r"(?<=\S) (?=\S)")


class _Encoder:
    """Token ids of texts as little-endian bytes, for a byte-level BPE vocabulary.

    A single space between two other characters always begins a token of the vocabulary's
    splitting pattern, so the parts of a text between such spaces encode on their own, and
    frequent parts come from a cache. Unknown parts use the same vocabulary as ranks, which
    takes a fraction of the time; parts with a special token go to the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = {x.content for x in self.tokenizer.get_added_tokens_decoder().values()}
        self.specials = [x for x in specials if x]
        byte_of = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(byte_of[c] for c in token): i
                 for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in specials}
        self.ranks = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _plain(self, part: str) -> bytes:
        if any(x in part for x in self.specials):
            return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
        return array("I", self.ranks.encode_ordinary(part)).tobytes()

    def _cached(self, part: str) -> bytes:
        ids = self.known.get(part)
        if ids is None:
            ids = self._plain(part)
            if len(part) <= CACHED_CHARS:
                self.known[part] = ids
        return ids

    def _part(self, part: str) -> bytes:
        word = part.rstrip(".,;:!?")
        if word[1:].isalpha():  # letters and marks are never one token
            ids = self._cached(word) + self._cached(part[len(word):]) if word != part else self._plain(part)
        else:
            ids = self._plain(part)
        if len(part) <= CACHED_CHARS:
            self.known[part] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self.known) > CACHE:
            self.known.clear()
        parts = (_single_space.split(text) if _space_run.search(text) else text.split(" "))
        known = self.known
        out = [self._plain(parts[0])]  # no space before it
        for part in parts[1:]:
            part = " " + part
            ids = known.get(part)
            out.append(self._part(part) if ids is None else ids)
        return b"".join(out)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _encoder(path: str) -> _Encoder:
    if path not in _loaded:
        _loaded[path] = _Encoder(path)
    return _loaded[path]


def _tokenizer_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Slices of the order, for ranks among equal lengths and for the numbers of all sequences.
SLICES, SEQUENCE_SLICES = 32, 256


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, order: str | None = None) -> DataFrame:
    """Each document's ids and the end mark 0, cut into pieces; only the first may be shorter.

    The pieces keep the document's number in the order column.
    """
    def run(batches):
        encoder = _encoder(_tokenizer_path(tokenizer))
        for batch in batches:
            for part in common.text_slices(batch):
                docs_, pieces, starts, lengths, sums, rows = [], [], [], [], [], []
                for row, (doc, text) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())):
                    ids = encoder.encode(text) + b"\0\0\0\0"
                    n = len(ids) // 4
                    short = n % capacity or capacity
                    begins = [0, *range(min(n, short), n, capacity)]
                    for i, (a, b) in enumerate(zip(begins, [*begins[1:], n])):
                        docs_.append(doc)
                        pieces.append(i)
                        starts.append(a)
                        lengths.append(b - a)
                        sums.append(zlib.crc32(ids[4 * a : 4 * b]))
                        rows.append(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
                     *[part.column(c).take(pa.array(rows, pa.int64())) for c in numbers]],
                    ["doc_id", "piece", "start", "length", "ids_crc32", *numbers])

    numbers = ["_order"] if order else []
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(f"`{order}`").cast("long").alias(c) for c in numbers]
    ).mapInArrow(run, PIECE + "".join(f", {c} long" for c in numbers))


# ---------------------------------------------------------------------------------------
# Plans: plain numbers, from counts of lengths


def _best_fill(sizes: list[int], left: list[int], room: int) -> dict[int, int]:
    """Pieces (index into sizes -> number) whose total is largest within the room."""
    use = np.full(room + 1, -1, np.int64)  # last size added to reach a total
    reach = np.zeros(room + 1, bool)
    reach[0] = True
    steps: list[tuple[int, np.ndarray]] = []
    for i, size in enumerate(sizes):
        for _ in range(min(left[i], room // size)):
            fresh = np.zeros_like(reach)
            fresh[size:] = reach[: room + 1 - size]
            fresh &= ~reach
            if not fresh.any():
                break
            steps.append((i, fresh))
            reach |= fresh
        if reach[room]:
            break
    total = int(np.flatnonzero(reach)[-1])
    chosen: dict[int, int] = {}
    for i, fresh in reversed(steps):
        if total and fresh[total]:
            chosen[i] = chosen.get(i, 0) + 1
            total -= sizes[i]
    return chosen


def plan_large(counts: dict[int, int], capacity: int, groups: int = GROUPS):
    """(rank of each length's first piece, group size, places, sequences).

    places: group -> (first index, one past the last, first sequence, slot).
    """
    lengths = sorted(counts, reverse=True)
    firsts, n = {}, 0
    for x in lengths:
        firsts[x] = n
        n += counts[x]
    size = -(-n // groups) if n else 1
    ranks = [firsts[x] for x in lengths]
    sizes, left = [], []
    for g in range(-(-n // size)):
        sizes.append(lengths[int(np.searchsorted(ranks, g * size, "right")) - 1])
        left.append(min(size, n - g * size))
    used, places, sequences = [0] * len(sizes), {g: [] for g in range(len(sizes))}, 0
    for g in range(len(sizes)):
        while left[g]:
            left[g] -= 1
            chosen = _best_fill(sizes[g:], left[g:], capacity - sizes[g])
            left[g] += 1
            config = {g: 1}
            for i, k in chosen.items():
                config[g + i] = config.get(g + i, 0) + k
            times = min(left[i] // k for i, k in config.items())
            slot = 0
            for i, k in sorted(config.items()):
                for _ in range(k):
                    places[i].append((used[i], used[i] + times, sequences, slot))
                    used[i] += times
                    slot += 1
                left[i] -= k * times
            sequences += times
    return firsts, size, places, sequences


def plan_small(counts: dict[int, int], slacks: dict[int, int], capacity: int):
    """Best fit, longest first: length -> (first rank, one past the last, slack class or -1, first in it, offset); new sequences.

    Class -1 numbers the new sequences.
    """
    classes: dict[int, list[tuple[int, int, int]]] = {s: [(s, 0, n)] for s, n in slacks.items() if n and s}
    order = sorted(classes)
    plan: dict[int, list[tuple[int, int, int, int, int]]] = {}
    opened = 0

    def add(slack: int, part: tuple[int, int, int]) -> None:
        if slack not in classes:
            order.insert(bisect_left(order, slack), slack)
            classes[slack] = []
        classes[slack].append(part)

    for length in sorted(counts, reverse=True):
        rest, done, moves = counts[length], 0, []
        while rest:
            at = bisect_left(order, length)
            if at == len(order):
                more = -(-rest // (capacity // length))
                add(capacity, (-1, opened, opened + more))
                opened += more
                continue
            slack = order[at]
            origin, a, b = classes[slack].pop()
            n = min(rest, b - a)
            moves.append((done, done + n, origin, a, capacity - slack))
            if b - a > n:
                classes[slack].append((origin, a + n, b))
            elif not classes[slack]:
                del classes[slack]
                order.pop(at)
            if slack > length:
                add(slack - length, (origin, a, a + n))
            done += n
            rest -= n
        plan[length] = moves
    return plan, opened


# ---------------------------------------------------------------------------------------
# Every piece looks its place up


def _large_places(firsts, size, places, base):
    def run(batches):
        begins = {g: np.array([p[0] for p in x]) for g, x in places.items()}
        for batch in batches:
            sequence, slot = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                at = firsts[length] + rank
                group, index = divmod(at, size)
                first, _, start, place = places[group][int(np.searchsorted(begins[group], index, "right")) - 1]
                sequence.append(base + start + index - first)
                slot.append(place)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence, pa.int64()), pa.array(slot, pa.int32())],
                                             [*batch.schema.names, "sequence_id", "slot"])
    return run


def _small_places(plan):
    def run(batches):
        begins = {x: np.array([p[0] for p in moves]) for x, moves in plan.items()}
        for batch in batches:
            origin, index, offset = [], [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                first, _, slack, a, fill = plan[length][int(np.searchsorted(begins[length], rank, "right")) - 1]
                origin.append(slack)
                index.append(a + rank - first)
                offset.append(fill)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(origin, pa.int64()), pa.array(index, pa.int64()), pa.array(offset, pa.int64())],
                [*batch.schema.names, "slack", "index", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, order: str | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces(doc_id, piece, start, length, ids_crc32)."""
    numbers, by, slices = [], [], dict.fromkeys((SLICES, SEQUENCE_SLICES))
    if order:
        numbers, by = ["_order"], ["_order"]
        pieces = pieces.withColumnRenamed(order, "_order")
        least, most = pieces.agg(F.min("_order"), F.max("_order")).first()
        share = (F.col("_order") - F.lit(least or 0)) / F.lit((most or 0) - (least or 0) + 1)
        slices = {n: F.coalesce(F.least(F.floor(share * n), F.lit(n - 1)), F.lit(0)).cast("int") for n in slices}
    held = common.cut(common.ranked(pieces, ["length"], [*by, "doc_id", "piece", "ids_crc32"], "rank", SLICES, slices[SLICES]))
    counts = {r[0]: r[1] for r in held.groupBy("length").count().collect()}
    if not counts:
        kept = [c for c in pieces.columns if c not in numbers]
        return held.select(*kept, F.col("rank").alias("sequence_id"), F.col("rank").alias("offset"))
    limit = int(capacity * LARGE)
    whole = counts.get(capacity, 0)
    firsts, size, places, sequences = plan_large(
        {x: n for x, n in counts.items() if limit < x < capacity}, capacity)
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, rank long" + "".join(f", {c} long" for c in numbers)
    held = held.select("doc_id", "piece", "start", "length", "ids_crc32", "rank", *numbers)
    large = common.cut(
        held.where((F.col("length") > limit) & (F.col("length") < capacity))
        .mapInArrow(_large_places(firsts, size, places, whole), f"{fields}, sequence_id long, slot int")
    )
    filled = large.groupBy("sequence_id").agg(
        (F.lit(capacity) - F.sum("length")).alias("slack"), *[F.min_by(c, "slot").alias(c) for c in numbers])
    bins = common.cut(common.ranked(filled, ["slack"], [*by, "sequence_id"], "index", SLICES, slices[SLICES]).drop(*numbers))
    slacks = {r[0]: r[1] for r in bins.groupBy("slack").count().collect()}
    plan, _ = plan_small({x: n for x, n in counts.items() if x <= limit}, slacks, capacity)
    small = (
        held.where(F.col("length") <= limit)
        .mapInArrow(_small_places(plan), f"{fields}, slack long, index long, offset long")
    )
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *numbers]
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    packed = (
        held.where(F.col("length") == capacity)
        .withColumn("sequence_id", F.col("rank")).withColumn("offset", F.lit(0).cast("long")).select(*out)
        .unionByName(large.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long"))).select(*out))
        .unionByName(small.where("slack >= 0").join(bins, ["slack", "index"]).select(*out))
        .unionByName(small.where("slack < 0").withColumn("sequence_id", F.col("index") + F.lit(whole + sequences)).select(*out))
    )


    if not order:
        return packed
    packed = common.cut(packed)
    heads = packed.where("offset = 0").select("sequence_id", "_order", "piece")
    numbered = common.ranked(heads, [], ["_order", "piece", "sequence_id"], "_number", SEQUENCE_SLICES, slices[SEQUENCE_SLICES])
    return (
        packed.join(numbered.select("sequence_id", "_number"), "sequence_id")
        .withColumn("sequence_id", F.col("_number")).select(*[c for c in out if c not in numbers])
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, order: str | None = None) -> DataFrame:
    """Token pieces of docs(doc_id, text, ...) in sequences; `order` names a column with one number a row."""
    # Ranking reads the pieces twice; the texts are tokenized once.
    return pack(common.cut(token_pieces(docs, capacity, tokenizer, order)), capacity, order and "_order")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
