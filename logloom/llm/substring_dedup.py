"""Substring dedup: a sparse De Bruijn graph of token k-mers, compacted by Spark joins.

A window is `window` consecutive words. Every word covered by a window whose words also start
in a document with a smaller id is removed; windows are judged on the input.

1. Anchors: of the k-mers in each window the one with the smallest hash is an anchor, so
   equal windows choose the same one. Anchors are the graph's nodes: about 2 of every
   (window - k + 2) words. A k-mer found in two documents is a repeated node.
2. Edges: the words from one anchor to the last window that starts before the next anchor. An
   edge that also lies in a smaller document is a nonbranching repeated path as a whole: all
   its windows are settled by one row (the edge's hash and smallest document), whatever the
   number of copies.
3. Coordinates: windows that no edge settled and whose anchor is repeated are read again
   from their source text and compared one by one, by 128-bit hash. They are the first copy
   of each repeated path and the ends of repeats, where contexts branch. The smallest
   document of a window never has it settled by an edge, so nothing is missed.

Rows of a k-mer, edge or window are reduced before the shuffle (smallest and largest
document), and only repeated ones are joined back, where adaptive execution splits skew.

Edge cases: null or blank texts have no words; texts shorter than a window stay whole; rows
that repeat a doc_id are one document of several texts (equal windows among them are no
repeat, their words all come from their own row); rows with a null doc_id stay whole; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

#: Words of a k-mer.
KMER = 12


def _minimizers(words: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(k-mer hashes, for each window the place of its smallest k-mer, the leftmost of equals)."""
    at = np.arange(len(words) - k + 1)
    kmers = common.hash_runs(words, at, at + k)
    place_bits = np.uint64(max(1, int(len(kmers)).bit_length()))
    keep = ~((np.uint64(1) << place_bits) - np.uint64(1))
    least = (kmers & keep) | at.astype(np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        rest = width - span
        least = np.minimum(least[:-rest], least[rest:])
    return kmers, (least & ~keep).astype(np.int64)


def _edges(chosen: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last window start of each edge of a document."""
    anchors = np.unique(chosen)
    opens = np.unique(np.r_[0, anchors[anchors < starts]])
    return opens, np.r_[opens[1:], starts]


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """Places of the first of equal hashes: what a text repeats in itself is one row."""
    return np.sort(np.unique(hashes, return_index=True)[1])


def _all_equal(hashes: np.ndarray, places) -> np.ndarray:
    """Whether each hash equals one of those at the places."""
    return np.isin(hashes, hashes[np.asarray(places, np.int64)])


def _settled(words: np.ndarray, opens: np.ndarray, closes: np.ndarray, window: int, settled) -> np.ndarray:
    edges = common.hash_runs(words, opens, closes - 1 + window)
    return _all_equal(edges, np.searchsorted(opens, np.asarray(settled, np.int64)))


def _documents(batch: pa.RecordBatch):
    """(row, its word hashes) of every text."""
    for part in common.text_slices(batch):
        hashes, first = common.hash_words(part.column("text"))
        for i in range(part.num_rows):
            yield part.slice(i, 1), hashes[first[i] : first[i + 1]]


_FACTS = "kind byte, h1 long, h2 long, doc_id long, row long, place int"


def _graph(window: int, k: int):
    """Anchors (kind 0, place = anchor) and edges (kind 1, place = first window start) of every text."""
    def run(batches):
        for batch in batches:
            out = []
            for row, words in _documents(batch):
                starts = len(words) - window + 1
                if starts < 1:
                    continue
                kmers, chosen = _minimizers(words, k, window - k + 1)
                anchors = np.unique(chosen)
                opens, closes = _edges(chosen, starts)
                ends = closes - 1 + window
                anchors = anchors[_distinct(kmers[anchors])]
                edges = common.hash_runs(words, opens, ends)
                first = _distinct(edges)
                opens, ends = opens[first], ends[first]
                one = np.r_[kmers[anchors], edges[first]]
                two = np.r_[np.zeros(len(anchors), np.uint64), common.hash_runs(words, opens, ends, True)]
                n = len(one)
                out.append((np.r_[np.zeros(len(anchors), np.int8), np.ones(len(opens), np.int8)], one, two,
                            np.full(n, row.column("doc_id")[0].as_py(), np.int64),
                            np.full(n, row.column("row")[0].as_py(), np.int64),
                            np.r_[anchors, opens].astype(np.int32)))
            if out:
                kind, one, two, doc, at, place = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.array(common.signed(one)), pa.array(common.signed(two)),
                     pa.array(doc), pa.array(at), pa.array(place)],
                    ["kind", "h1", "h2", "doc_id", "row", "place"])
    return run


def _open_windows(window: int, k: int):
    """Windows that no edge settled and whose anchor is repeated, with their 128-bit hash."""
    def run(batches):
        for batch in batches:
            out = []
            for row, words in _documents(batch):
                starts = len(words) - window + 1
                repeated = row.column("repeated")[0].as_py()
                if starts < 1 or not repeated:
                    continue
                kmers, chosen = _minimizers(words, k, window - k + 1)
                opens, closes = _edges(chosen, starts)
                done = np.repeat(_settled(words, opens, closes, window, row.column("settled")[0].as_py() or []), closes - opens)
                at = np.flatnonzero(_all_equal(kmers, repeated)[chosen] & ~done)
                hashes = common.hash_runs(words, at, at + window)
                first = _distinct(hashes)
                at, n = at[first], len(first)
                out.append((hashes[first], common.hash_runs(words, at, at + window, True),
                            np.full(n, row.column("doc_id")[0].as_py(), np.int64),
                            np.full(n, row.column("row")[0].as_py(), np.int64), at.astype(np.int32)))
            if out:
                one, two, doc, at, place = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(one), 2, np.int8)), pa.array(common.signed(one)), pa.array(common.signed(two)),
                     pa.array(doc), pa.array(at), pa.array(place)],
                    ["kind", "h1", "h2", "doc_id", "row", "place"])
    return run


def _removed(window: int, k: int):
    """Each row's text without the words that its settled edges and single windows cover."""
    def run(batches):
        for batch in batches:
            for part in common.text_slices(batch):
                hashes, first = common.hash_words(part.column("text"))
                total, gone, kept = [], [], []
                for i in range(part.num_rows):
                    text = part.column("text")[i].as_py()
                    settled = part.column("settled")[i].as_py()
                    single = part.column("single")[i].as_py()
                    words = (text or "").encode().split()
                    n = len(words)
                    drop = np.zeros(n + 1, np.int32)
                    if n >= window and (settled or single):
                        own = hashes[first[i] : first[i + 1]]
                        if settled:
                            _, chosen = _minimizers(own, k, window - k + 1)
                            opens, closes = _edges(chosen, n - window + 1)
                            hit = _settled(own, opens, closes, window, settled)
                            np.add.at(drop, opens[hit], 1)
                            np.add.at(drop, closes[hit] - 1 + window, -1)
                        if single:
                            starts = np.arange(n - window + 1)
                            at = np.flatnonzero(_all_equal(common.hash_runs(own, starts, starts + window), single))
                            np.add.at(drop, at, 1)
                            np.add.at(drop, at + window, -1)
                        covered = np.cumsum(drop[:-1]) > 0
                        words = [w for w, c in zip(words, covered) if not c]
                    total.append(n)
                    gone.append(n - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def _in_smaller(facts: DataFrame) -> DataFrame:
    """Facts whose hash also lies in a document with a smaller id."""
    first = facts.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    return facts.join(first.where("least < most").select("h1", "h2", "least"), ["h1", "h2"]).where("doc_id > least")


def remove_repeats(docs: DataFrame, window: int = 50, k: int = KMER) -> DataFrame:
    """docs(doc_id, text) as (doc_id, n_words, n_removed, kept_text), one row per row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The row hash tells texts apart that share a doc_id.
    rows = docs.withColumn("row", F.xxhash64("text"))
    facts = common.cut(rows.where("doc_id is not null").mapInArrow(_graph(window, k), _FACTS))
    edges = facts.where("kind = 1")
    settled = _in_smaller(edges).groupBy("doc_id", "row").agg(F.collect_set("place").alias("settled"))
    kmers = facts.where("kind = 0")
    shared = kmers.groupBy("h1").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    repeated = (
        kmers.join(shared.where("least < most").select("h1"), "h1")
        .groupBy("doc_id", "row").agg(F.collect_set("place").alias("repeated"))
    )
    marks = common.cut(repeated.join(settled, ["doc_id", "row"], "left"))
    sources = rows.where("doc_id is not null").join(marks, ["doc_id", "row"])
    windows = common.cut(sources.mapInArrow(_open_windows(window, k), _FACTS))
    single = _in_smaller(windows).groupBy("doc_id", "row").agg(F.collect_set("place").alias("single"))
    found = marks.select("doc_id", "row", "settled").join(single, ["doc_id", "row"], "left").where("settled is not null or single is not null")
    judged = rows.join(found, ["doc_id", "row"], "left")
    return judged.mapInArrow(_removed(window, k), "doc_id long, n_words long, n_removed long, kept_text string")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


#: The same rows by hashing every window of every document: fit for small tables only.
SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
first AS (SELECT h, min(doc_id) AS least FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
hit AS (
  SELECT DISTINCT doc_id, j FROM (
    SELECT win.doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN first USING (h) WHERE win.doc_id > least)),
gone AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
kept AS (
  SELECT p.doc_id, string_agg(x, ' ' ORDER BY j) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM words) p ANTI JOIN hit h ON p.doc_id = h.doc_id AND p.j = h.j
  GROUP BY p.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
