"""N-gram Jaccard join: token-combination prefixes, exact verification, link components.

A document's tokens are its distinct word shingles. Two documents link when
100 * intersection >= percent * union. The join finds every link between different texts:

1. Documents with equal token sets collapse to the one with the smallest id.
2. Token frequencies are counted in cells (hash prefixes) over all documents and kept as one
   bitmap of frequent cells, whose size is a parameter. Tokens are ordered rare ones first.
3. A linked document misses at most `t` of a document's `n` tokens, t = n * (100 - percent) / 100.
   The first t + 1 rare tokens are indexed one by one. A document with fewer rare tokens
   extends its prefix into the frequent ones, which fall into subclasses by hash; in each,
   all pairs of the prefix are indexed. With p tokens in a subclass, p - 1 of them must be
   missing before no pair is shared, so the prefix grows until rare + sum(p - 1) >= t + 1.
   The subclasses depend on the size tier; a document indexes each tier of a possible partner.
4. Buckets of rare tokens are smaller than the frequency limit, so their pairs are listed
   (length and position filters first) and verified on the whole sets.
5. Buckets of frequent pairs can be huge groups of near copies. Stars over the buckets give
   candidate groups; a group is cut into blocks, each pair of blocks is compared exactly in
   one task by counting common tokens, and only links that connect leave the task, with the
   number of rows that each document links with.

The bitmap steers cost only: any classes give the same links.

Edge cases: null or blank texts have no tokens and link with nothing; rows with a null
doc_id are returned with a null component and no links; rows that repeat a doc_id are judged one
by one under that id, and where such an id stands for several token sets their links are
counted together; texts of any length are read whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

#: Documents that may share a token before it counts as frequent.
FREQUENT = 16
#: Documents in a block of a group of near copies.
BLOCK = 256
#: Largest frequency bitmap, as a power of two of cells (64 MB).
MOST_BITS = 29
#: Rows of a partition's tokens whose cells are sorted at once.
CELLS_AT_ONCE = 1 << 22


def _sets(texts: pa.Array, words: int, lower: bool) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    hashes, first = common.hash_words(texts, lower)
    counts = np.diff(first)
    grams = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), grams)
    begins = np.r_[0, np.cumsum(grams)]
    lo = first[text] + np.arange(len(text)) - begins[text]
    found = common.hash_runs(hashes, lo, lo + np.minimum(words, counts[text]))
    for i in range(len(counts)):
        yield np.unique(found[begins[i] : begins[i + 1]])


def _set_keys(words: int, lower: bool):
    def run(batches):
        for batch in batches:
            for part in common.text_slices(batch):
                n, one, two = [], [], []
                for tokens in _sets(part.column("text"), words, lower):
                    n.append(len(tokens))
                    one.append(np.sum(common._mixed(tokens), dtype=np.uint64))
                    two.append(np.sum(common._mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()),
                     pa.array(common.signed(np.array(one, np.uint64))),
                     pa.array(common.signed(np.array(two, np.uint64)))],
                    ["doc_id", "n_shingles", "key1", "key2"])
    return run


# ---------------------------------------------------------------------------------------
# Frequent cells


def _cell_runs(words: int, lower: bool, bits: int, parts: int):
    def flush(cells):
        pack = zstandard.ZstdCompressor(level=1)
        cells = np.sort(np.concatenate(cells))
        borders = np.searchsorted(cells, (np.arange(parts + 1, dtype=np.uint64) << np.uint64(bits)) // np.uint64(parts))
        runs = [pack.compress(np.diff(cells[a:b], prepend=np.uint64(0)).astype(np.uint32).tobytes())
                for a, b in zip(borders[:-1], borders[1:]) if b > a]
        filled = [i for i in range(parts) if borders[i + 1] > borders[i]]
        return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(runs, pa.binary())], ["part", "run"])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            for part in common.text_slices(batch):
                for tokens in _sets(part.column("text"), words, lower):
                    if len(tokens):
                        held.append(tokens >> np.uint64(64 - bits))
                        count += len(tokens)
                if count >= CELLS_AT_ONCE:
                    yield flush(held)
                    held, count = [], 0
        if held:
            yield flush(held)
    return run


def _frequent_part(bits: int, parts: int, limit: int):
    width = (1 << bits) // parts

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        counts = np.zeros(width, np.uint32)
        for blob in frame["run"]:
            cells = np.cumsum(np.frombuffer(unpack.decompress(blob), np.uint32), dtype=np.uint64)
            cells, n = np.unique(cells, return_counts=True)
            counts[(cells - np.uint64(key[0] * width)).astype(np.int64)] += n.astype(np.uint32)
        return pd.DataFrame({"part": [key[0]], "bitmap": [np.packbits(counts >= limit).tobytes()]})
    return run


def frequent_cells(texts: DataFrame, total: int, words: int, lower: bool) -> tuple[np.ndarray, int, int]:
    """(bitmap, bits, limit): cells that at least `limit` documents' tokens fall into.

    The cells follow the number of tokens up to 2^MOST_BITS, so the bitmap that every task
    reads is at most 64 MB; beyond, the limit rises with the cells' mean load.
    """
    bits = int(np.clip(int(total).bit_length(), 16, MOST_BITS))
    parts = 1 << max(4, bits - 21)
    limit = int(FREQUENT + 4 * (total >> bits))
    rows = (
        texts.select("text").mapInArrow(_cell_runs(words, lower, bits, parts), "part int, run binary")
        .groupBy("part").applyInPandas(_frequent_part(bits, parts, limit), "part int, bitmap binary")
        .collect()
    )
    bitmap = np.zeros((1 << bits) >> 3, np.uint8)
    width = len(bitmap) // parts
    for row in rows:
        bitmap[row.part * width : (row.part + 1) * width] = np.frombuffer(row.bitmap, np.uint8)
    return bitmap, bits, limit


# ---------------------------------------------------------------------------------------
# Signatures


def _rare_first(tokens: np.ndarray, bitmap: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    cells = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    frequent = (bitmap[cells >> 3] >> (7 - (cells & 7))) & 1 == 1
    return tokens[~frequent], tokens[frequent]


def _missing(n: int, percent: int) -> int:
    """Most tokens of a set of n that a linked set can lack."""
    return n * (100 - percent) // 100


def _tiers(n: int, percent: int) -> set[int]:
    return {max(1, size).bit_length() for size in (-(-n * percent // 100), n, n * 100 // percent)}


def _combinations(rare: int, frequent: np.ndarray, n: int, percent: int) -> np.ndarray:
    """Signatures of the pairs of frequent tokens in the extended prefix, for every tier."""
    need = _missing(n, percent) + 1 - rare
    found = []
    for tier in _tiers(n, percent):
        classes = max(1, (1 << tier) >> 6)
        kind = (common._mixed(frequent) % np.uint64(classes)).astype(np.int64)
        _, opens = np.unique(kind, return_index=True)
        repeats = np.ones(len(frequent), np.int64)
        repeats[opens] = 0
        enough = int(np.searchsorted(np.cumsum(repeats), need)) + 1
        taken, kind = frequent[:enough], kind[:enough]
        order = np.argsort(kind, kind="stable")
        taken, kind = taken[order], kind[order]
        for gap in range(1, len(taken)):
            same = kind[gap:] == kind[:-gap]
            if not same.any():
                break
            a, b = taken[:-gap][same], taken[gap:][same]
            found.append(common._mixed(np.minimum(a, b) * np.uint64(31) + common._mixed(np.maximum(a, b)) + np.uint64(tier)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _signatures(words: int, lower: bool, percent: int, bits: int, shared, combined: bool):
    def run(batches):
        bitmap = shared.value
        for batch in batches:
            for part in common.text_slices(batch):
                ids = part.column("doc_id").to_pylist()
                signs, docs, sizes, places = [], [], [], []
                for doc, tokens in zip(ids, _sets(part.column("text"), words, lower)):
                    n = len(tokens)
                    if not n:
                        continue
                    rare, frequent = _rare_first(tokens, bitmap, bits)
                    need = _missing(n, percent) + 1
                    if combined:
                        signs.append(_combinations(len(rare), frequent, n, percent) if len(rare) < need else rare[:0])
                    else:
                        signs.append(rare[:need])
                    docs.append(np.full(len(signs[-1]), doc, np.int64))
                    sizes.append(np.full(len(signs[-1]), n, np.int32))
                    places.append(np.arange(len(signs[-1]), dtype=np.int32))
                if signs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(common.signed(np.concatenate(signs))), pa.array(np.concatenate(docs)),
                         pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))],
                        ["sign", "doc_id", "n", "place"])
    return run


def _bucket_pairs(percent: int):
    """Pairs inside buckets; rows come sorted by signature. A bucket has fewer rows than the limit."""
    def pairs(sign, doc, n, place):
        for gap in range(1, len(sign)):
            same = sign[gap:] == sign[:-gap]
            if not same.any():
                return
            a, b = np.flatnonzero(same), np.flatnonzero(same) + gap
            small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            most = np.minimum(n[a] - place[a], n[b] - place[b])
            fits = (doc[a] != doc[b]) & (100 * small >= percent * large) & ((100 + percent) * most >= percent * (small + large))
            if fits.any():
                one, two = doc[a[fits]], doc[b[fits]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if not len(held[0]):
                continue
            whole = int(np.searchsorted(held[0], held[0][-1]))  # the last bucket may go on
            yield from pairs(*[x[:whole] for x in held])
            held = [x[whole:] for x in held]
        if held is not None:
            yield from pairs(*held)
    return run


# ---------------------------------------------------------------------------------------
# Verification


def _verified(words: int, lower: bool, percent: int):
    def run(batches):
        last_id, last = None, None
        for batch in batches:
            sides = {}
            for side in ("text_a", "text_b"):
                sides[side] = []
                for part in common.text_slices(batch.select([side]), side):
                    sides[side] += list(_sets(part.column(side), words, lower))
            keep = []
            for x, y in zip(sides["text_a"], sides["text_b"]):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b", "rows_a", "rows_b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _block_links(words: int, lower: bool, percent: int):
    """Links between two blocks (or in one) of a group: (a, b) of a spanning forest of them, and
    for each document (a, null, n) with the rows that all its links lead to."""
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["block", "doc_id"])
        sets = []
        for part in common.text_slices(pa.RecordBatch.from_pandas(frame[["text"]], preserve_index=False)):
            sets += list(_sets(part.column("text"), words, lower))
        ids, block, rows = (frame[c].to_numpy() for c in ("doc_id", "block", "rows"))
        sizes = np.array([len(x) for x in sets])
        tokens = np.unique(np.concatenate(sets), return_inverse=True)[1]
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        posted = owner[order]
        opens = np.r_[0, np.cumsum(np.bincount(tokens))]
        root = np.arange(len(sets))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        links, ends = [], np.r_[0, np.cumsum(sizes)]
        reached = np.zeros(len(sets), np.int64)
        for i in np.flatnonzero(block == key[1]):
            own = tokens[ends[i] : ends[i + 1]]
            lo, n = opens[own], opens[own + 1] - opens[own]
            at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            both = np.bincount(posted[at], minlength=len(sets))
            linked = 100 * both >= percent * (sizes[i] + sizes - both)
            linked &= (both > 0) & ((block == key[2]) if key[1] != key[2] else (np.arange(len(sets)) > i))
            partners = np.flatnonzero(linked)
            reached[i] += rows[partners].sum()
            reached[partners] += rows[i]
            for j in partners:
                a, b = find(i), find(j)
                if a != b:
                    root[b] = a
                    links.append((ids[i], ids[j], None))
        links += [(ids[i], None, reached[i]) for i in np.flatnonzero(reached)]
        return pd.DataFrame(links, columns=["a", "b", "n"]).astype("Int64")
    return run


# ---------------------------------------------------------------------------------------
# The operator


def links(texts: DataFrame, total: int, words: int, percent: int, lower: bool) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect all linked documents of (doc_id, text, rows), and (doc_id, n) with
    the rows that each document's links lead to. `total` is the texts' token count."""
    spark: SparkSession = texts.sparkSession
    bitmap, bits, _ = frequent_cells(texts, total, words, lower)
    shared = spark.sparkContext.broadcast(bitmap)
    schema = "sign long, doc_id long, n int, place int"

    single = texts.mapInArrow(_signatures(words, lower, percent, bits, shared, False), schema)
    pairs = common.cut(
        single.repartition("sign").sortWithinPartitions("sign")
        .mapInArrow(_bucket_pairs(percent), "a long, b long").distinct()
    )
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"), F.col("rows").alias(f"rows_{x}"))
    verified = common.cut(
        pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "rows_a", "rows_b", "text_a", "text_b")
        .mapInArrow(_verified(words, lower, percent), "a long, b long, rows_a long, rows_b long")
    )

    combined = common.cut(
        texts.mapInArrow(_signatures(words, lower, percent, bits, shared, True), schema).select("sign", "doc_id")
    )
    leaders = combined.groupBy("sign").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("other"))
    stars = (
        combined.join(leaders.where("leader < other").select("sign", "leader"), "sign")
        .select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    )
    groups = common.components(stars).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "grp")
    blocked = (
        common.ranked(groups, ["grp"], ["doc_id"], "rank", 8)
        .select("doc_id", "grp", F.floor(F.col("rank") / BLOCK).cast("int").alias("block"))
    )
    sizes = groups.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    units = (
        blocked.join(sizes, "grp").join(texts, "doc_id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("grp", F.least("block", "other").alias("u"), F.greatest("block", "other").alias("v"),
                "block", "doc_id", "text", "rows")
    )
    inside = common.cut(
        units.groupBy("grp", "u", "v").applyInPandas(_unit(words, lower, percent), "a long, b long, n long"))
    # A group counts all links between its own documents; other links lead out of a group.
    member = lambda x: groups.select(F.col("doc_id").alias(x), F.col("grp").alias(f"grp_{x}"))
    outside = (
        verified.join(member("a"), "a", "left").join(member("b"), "b", "left")
        .where("grp_a is null or grp_b is null or grp_a <> grp_b")
    )
    ends = F.array(F.struct(F.col("a").alias("doc_id"), F.col("rows_b").alias("n")),
                   F.struct(F.col("b").alias("doc_id"), F.col("rows_a").alias("n")))
    counts = (
        outside.select(F.explode(ends).alias("e")).select("e.*")
        .unionByName(inside.where("b is null").select(F.col("a").alias("doc_id"), "n"))
        .groupBy("doc_id").agg(F.sum("n").alias("n"))
    )
    return verified.select("a", "b").unionByName(inside.where("b is not null").select("a", "b")), counts


def _unit(words: int, lower: bool, percent: int):
    compare = _block_links(words, lower, percent)

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        return compare((key[0], key[1], key[2]), frame)
    return run


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90, lower: bool = True) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_shingles, component_id, representative, n_links.

    component_id is the smallest doc_id reachable by links, representative the smallest
    doc_id with an equal token set, n_links the number of other rows that the row links with.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = common.cut(docs.mapInArrow(_set_keys(words, lower), "doc_id long, n_shingles long, key1 long, key2 long"))
    key = ["n_shingles", "key1", "key2"]
    reps = keyed.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(
        F.min("doc_id").alias("representative"), F.count(F.lit(1)).alias("rows"))
    total = reps.agg(F.sum("n_shingles")).first()[0] or 0
    classes = reps.groupBy(F.col("representative").alias("doc_id")).agg(F.sum("rows").alias("rows"))
    texts = common.cut(docs.join(classes, "doc_id"))
    connected, counts = links(texts, total, words, percent, lower)
    found = common.components(connected)
    labelled = (
        reps.join(found, F.col("representative") == F.col("node"), "left")
        .join(counts.withColumnRenamed("doc_id", "counted"), F.col("representative") == F.col("counted"), "left")
        .select(*key, "representative", F.coalesce("component", "representative").alias("component_id"),
                (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    )
    known = F.col("doc_id").isNotNull()
    return (
        keyed.join(labelled, key, "left")
        .select("doc_id", "n_shingles",
                F.when(known, F.coalesce("component_id", "doc_id")).alias("component_id"),
                F.when(known, F.coalesce("representative", "doc_id")).alias("representative"),
                F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"))
    )


def one_of_each(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns.

    Rows that repeat such a document's id and text are one row; rows with a null id stay.
    """
    names = docs.columns
    found = jaccard_components(docs, words, percent)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    ids = F.col("doc_id").cast("long")
    named = docs.join(kept, ids == kept["_kept"], "leftsemi").dropDuplicates(["doc_id", "text"])
    return named.select(*names).unionByName(docs.where(ids.isNull()).select(*names))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Equal sets are one class; classes that share a shingle are compared, and links closed by recursion.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END) AS s
  FROM words),
class AS (SELECT s, len(s) AS n, min(doc_id) AS c, count(*) AS copies FROM sets WHERE len(s) > 0 GROUP BY s),
token AS (SELECT c, n, unnest(s) AS t FROM class),
pair AS (
  SELECT a.c AS a, b.c AS b, a.n + b.n AS total, count(*) AS shared
  FROM token a JOIN token b ON a.t = b.t AND a.c <> b.c AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL),
link AS (SELECT a, b FROM pair WHERE 100 * shared >= 90 * (total - shared)),
reach AS (SELECT c, c AS d FROM class UNION SELECT reach.c, link.b FROM reach JOIN link ON link.a = reach.d),
component AS (SELECT c, min(d) AS least FROM reach GROUP BY c),
partner AS (SELECT link.a AS c, sum(copies) AS n FROM link JOIN class ON class.c = link.b GROUP BY link.a)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(least, doc_id) AS component_id, coalesce(class.c, doc_id) AS representative,
  (coalesce(partner.n, 0) + coalesce(copies, 1) - 1)::BIGINT AS n_links
FROM sets LEFT JOIN class USING (s) LEFT JOIN component USING (c) LEFT JOIN partner USING (c)
"""
