"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon (words and word beginnings that mark toxic texts),
how near its hits stand to a second person, capitals, punctuation, and obfuscated words.

The lexicon, the trees and the calibration are learned from at most `LABELLED` labelled rows,
those first in a hash order, none of them held out. The lexicon is counted by Spark; the
trees see only that bounded table of features. Every document is then scored where it lies.
Labels, language, source and id are no inputs of a score; a row's id only tells whether its
label may be learned from.

Edge cases: null and empty texts have zero features and get a score like any other; repeated
rows are scored one by one; null ids are not held out and carry no label; labels with a null
or for missing documents are not used; with no label of one of the two kinds every score
is the share of toxic labels (0 without labels); extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from logloom.llm import common
from logloom.session import ship_package

#: Labelled rows that are learned from, at most.
LABELLED = 12_000
#: Lexicon entries, at most; an entry marks this many toxic rows at least.
ENTRIES, LEAST_ROWS = 3000, 5
#: Lengths of the word beginnings that are counted besides whole words.
STEMS = (4, 5, 6)
#: Log-odds from which an entry is a weak or a strong mark.
WEAK, STRONG = 1.5, 3.0
#: Words around a second person.
NEAR = 5
TREES, DEPTH, RATE, BINS, LEAF, FOLDS = 80, 3, 0.15, 32, 10, 4

#: Words for a second person in the corpus languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros".split()
)
#: Signs that stand for letters.
LEET = str.maketrans("013457@$!", "oieastasi")
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

FEATURES = 16


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ---------------------------------------------------------------------------------------
# Lexicon


def _forms(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def _plain(word: str) -> str:
    return "".join(c for c in word.translate(LEET) if c.isalpha())


def _mark_counts(batches):
    for batch in batches:
        for part in common.text_slices(batch):
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                words = {w.strip(EDGES) for w in set((text or "").lower().split())}
                counts[toxic].update({f for w in words if w and w.isalpha() for f in _forms(w)})
            marks = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.string()), pa.array([counts[1][m] for m in marks], pa.int64()),
                 pa.array([counts[0][m] for m in marks], pa.int64())],
                ["mark", "toxic", "clean"])


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log-odds of the marks of toxic rows in sample(text, toxic); at most ENTRIES, strongest first."""
    totals = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    found = (
        sample.select("text", "toxic").mapInArrow(_mark_counts, "mark string, toxic long, clean long")
        .groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= LEAST_ROWS).withColumn("odds", odds).where(F.col("odds") >= WEAK)
        .orderBy((F.col("odds") * F.col("toxic")).desc(), "mark").limit(ENTRIES).collect()
    )
    return {r["mark"]: r["odds"] for r in found}


# ---------------------------------------------------------------------------------------
# Features


_KIND = np.zeros(256, np.int64)  # 0 other, 1 capital, 2 exclamation, 3 question, 4 punctuation, 5 sign, 6 digit
_KIND[65:91] = 1
_KIND[ord("!")] = 2
_KIND[ord("?")] = 3
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 4
_KIND[[ord(c) for c in "*#@$%&_~^|<>/\\+=[]{}`"]] = 5
_KIND[48:58] = 6


class _Words:
    """What a word tells: 0 or (strength, second person, obfuscated, hit only in plain form)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.known = lexicon, {}

    def strength(self, word: str) -> float:
        return max((self.lexicon.get(f, 0.0) for f in _forms(word)), default=0.0)

    def look(self, raw: str):
        word = raw.strip(EDGES)
        odds = self.strength(word) if word else 0.0
        inner = not word.isalpha() and any(c.isalpha() for c in word) and any(not c.isalpha() for c in word)
        plain = self.strength(_plain(word)) if inner and not odds else 0.0
        found = (max(odds, plain), word in SECOND_PERSON, inner, plain >= STRONG)
        found = found if any(found) else 0
        if len(self.known) > 400_000:
            self.known.clear()
        self.known[raw] = found
        return found


def _features(text: str, signs: np.ndarray, doubled: int, look: _Words) -> list[float]:
    words = text.lower().split()
    n, known = len(words), look.known
    hits, persons, weak, inner, plain = [], [], 0, 0, 0
    distinct, weight = set(), 0.0
    for i, w in enumerate(words):
        seen = known.get(w)
        if seen is None:
            seen = look.look(w)
        if seen:
            odds, person, mixed, only_plain = seen
            if odds >= STRONG:
                hits.append(i)
                distinct.add(w.strip(EDGES))
                weight += odds
            elif odds >= WEAK:
                weak += 1
            if person:
                persons.append(i)
            inner += mixed
            plain += only_plain
    near = 0
    if hits and persons:
        where = np.array(persons)
        at = np.searchsorted(where, hits)
        left = np.abs(np.array(hits) - where[np.maximum(at - 1, 0)])
        right = np.abs(np.array(hits) - where[np.minimum(at, len(where) - 1)])
        near = int((np.minimum(left, right) <= NEAR).sum())
    size, per = max(1, len(text)), max(1, n)
    return [len(hits) / per, weak / per, math.log1p(len(hits)), math.log1p(len(distinct)), math.log1p(weak),
            weight / max(1, len(hits)), len(persons) / per, near / per, signs[1] / size, doubled / size,
            signs[2] / size, signs[3] / size, (signs[4] + signs[5]) / size, inner / per, math.log1p(plain), math.log1p(n)]


def _feature_lists(texts: pa.Array, look: _Words) -> list[list[float]]:
    rows = []
    for text in texts.to_pylist():
        text = text or ""
        kinds = _KIND[np.frombuffer(text.encode(), np.uint8)]
        capital = kinds == 1
        rows.append(_features(text, np.bincount(kinds, minlength=7), int((capital[1:] & capital[:-1]).sum()), look))
    return rows


def _feature_rows(lexicon: dict[str, float]):
    def run(batches):
        look = _Words(lexicon)
        for batch in batches:
            for part in common.text_slices(batch):
                rows = _feature_lists(part.column("text"), look)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic"), pa.array(rows, pa.list_(pa.float64()))],
                    ["doc_id", "toxic", "features"])
    return run


# ---------------------------------------------------------------------------------------
# Trees and calibration, on the bounded table


class Trees:
    """Logistic gradient boosting on binned features; trees are complete, of DEPTH levels."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
        self.start = math.log(share / (1 - share))
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self._binned(x)
        margin, self.trees = np.full(len(y), self.start), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            grown = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(grown)
            margin += grown[2][self._leaf(binned, grown)]

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], 1)

    def _grow(self, binned, slope, bend):
        nodes = (1 << DEPTH) - 1
        feature, place = np.zeros(nodes, int), np.full(nodes, BINS)
        at, rows = np.zeros(len(binned), int), np.arange(len(binned))
        for level in range(DEPTH):
            first, wide = (1 << level) - 1, 1 << level
            best = np.full(wide, 1e-6)
            for f in range(binned.shape[1]):
                key = (at - first) * (BINS + 1) + binned[:, f]
                shape = (wide, BINS + 1)
                g = np.bincount(key, slope, wide * (BINS + 1)).reshape(shape).cumsum(1)
                h = np.bincount(key, bend, wide * (BINS + 1)).reshape(shape).cumsum(1)
                n = np.bincount(key, minlength=wide * (BINS + 1)).reshape(shape).cumsum(1)
                all_g, all_h, all_n = g[:, -1:], h[:, -1:], n[:, -1:]
                gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                gain[(n < LEAF) | (all_n - n < LEAF)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(wide), top] > best
                best[better] = gain[np.arange(wide), top][better]
                feature[first : first + wide][better] = f
                place[first : first + wide][better] = top[better]
            at = 2 * at + 1 + (binned[rows, feature[at]] > place[at])
        leaf = at - nodes
        g, h = np.bincount(leaf, slope, nodes + 1), np.bincount(leaf, bend, nodes + 1)
        return feature, place, RATE * g / (h + 1)

    @staticmethod
    def _leaf(binned, tree):
        feature, place, _ = tree
        at, rows = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(DEPTH):
            at = 2 * at + 1 + (binned[rows, feature[at]] > place[at])
        return at - len(feature)

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.start + sum(t[2][self._leaf(binned, t)] for t in self.trees)


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators as points to interpolate: block means at block centres."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, sum of margins
    for m, v in zip(margin[order], y[order]):
        blocks.append([v, 1, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


class Model:
    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.trees, self.constant = None, float(y.mean()) if len(y) else 0.0
        if 0 < y.sum() < len(y):
            # Each row's margin for the calibration comes from trees that did not see the row.
            fold, margin = np.arange(len(y)) % FOLDS, np.zeros(len(y))
            for k in range(FOLDS):
                if (fold == k).any() and (fold != k).any():
                    margin[fold == k] = Trees(x[fold != k], y[fold != k]).margin(x[fold == k])
            self.trees = Trees(x, y)
            self.at, self.share = isotonic(margin, y)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.full(len(x), self.constant)
        margin = self.trees.margin(x)
        # The raw margin breaks ties inside a calibrated block.
        return np.clip(0.999 * np.interp(margin, self.at, self.share) + 0.001 / (1 + np.exp(-margin)), 0, 1)


class Fitted:
    """A lexicon and a model: all that scoring needs."""

    def __init__(self, lexicon: dict[str, float], model: Model):
        self.lexicon, self.model = lexicon, model


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Fitted:
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    )
    known = common.cut(known)  # at most `labelled` rows: small enough to broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = common.cut(texts.join(F.broadcast(known), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))
    lexicon = learn_lexicon(sample)
    rows = sample.mapInArrow(_feature_rows(lexicon), "doc_id long, toxic int, features array<double>").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["features"]))
    x = np.array([r["features"] for r in rows], float).reshape(-1, FEATURES)
    return Fitted(lexicon, Model(x, np.array([r["toxic"] for r in rows], float)))


def _score_rows(shared):
    def run(batches):
        fitted = shared.value
        look = _Words(fitted.lexicon)
        for batch in batches:
            for part in common.text_slices(batch):
                x = np.array(_feature_lists(part.column("text"), look), float).reshape(-1, FEATURES)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(fitted.model.score(x))], [*part.schema.names, "_score"])
    return run


def scored(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """(_row, _score): every row of docs as a struct, and its score."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))
    schema = StructType([*rows.schema.fields, StructField("_score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    return rows.mapInArrow(_score_rows(shared), schema).select("_row", "_score")


def score_toxicity(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """docs(doc_id, text) and labels(doc_id, toxic) as (doc_id, held_out, score, predicted)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, labelled))
    found = rows.mapInArrow(_score_rows(shared), "doc_id long, text string, _score double")
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns."""
    return scored(docs, fit(docs, labels, labelled)).where("_score < 0.5").select("_row.*")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
